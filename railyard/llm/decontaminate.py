"""Benchmark decontamination by template windows (operator 5).

A text becomes its template: numbers, names and units of measure are replaced by
typed placeholders, everything else is lower-cased and freed of punctuation.
Windows of template words are joined by hash with those of the benchmark, so a
question asked again with other numbers or names still matches. What stood in
the placeholders must then fit. Windows that repeat the item's own values, in any case,
count on their own. Of the other windows of one occurrence of an item, those count in
which each value of the item stands for the value it most often stands for in that
occurrence; and only if they are at least half of them, and not a lone one
where the item has more.

Clean texts are not shuffled: a Bloom filter over the benchmark's probes is looked up
where the texts are, and only the texts that pass it go on.

What a name is cannot be told from one text, so each text has three templates:
without names, with the capitalised words inside sentences as names, and with
all capitalised words as names. A window may match in any of them; without
names neither case nor layout matters.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import materialise

#: Units of measure recognised after a number.
UNITS = ("%", "°c", "°f", "c", "cm", "days", "dollars", "eur", "euros", "f", "ft", "g", "h", "hours", "hz", "inches", "kg",
         "km", "kmh", "kw", "l", "lb", "lbs", "m", "mg", "miles", "min", "minutes", "ml", "mm", "months", "mph", "ms",
         "pounds", "s", "seconds", "t", "usd", "v", "w", "weeks", "yards", "years", "$", "€", "£")
#: Marks written in place of, and in front of, slot values: control characters that count as no white space.
NAME, NUMBER, UNIT, MARK = "\x01", "\x02", "\x03", "\x04"
#: What stands between words: ASCII white space and punctuation, inside a character class.
BETWEEN = r"\x20\x09-\x0D.,;:!?\"'()\[\]{}<>«»“”‘’„¿¡…"
#: Template words of a probe; see matches().
PROBE = 5


def marked(text) -> F.Column:
    """The text's words, joined by single spaces, each name inside a sentence with a mark in front.

    Such a name is a capitalised word that follows, over any white space, a word
    which ends in a lower-case letter, a digit, a comma, a semicolon or a colon.
    """
    text = F.coalesce(text, F.lit(""))
    marks = f"[{NAME}{NUMBER}{UNIT}{MARK}]"
    clean = F.when(text.rlike(marks), F.regexp_replace(text, marks, "")).otherwise(text)
    names = F.regexp_replace(clean, r"([\p{Ll}\p{Nd},;:])[\x20\x09-\x0D]+(?=\p{Lu})", "$1 " + MARK)
    return F.regexp_replace(names, f"[{BETWEEN}]+", " ")


def _split(text) -> F.Column:
    return F.array_remove(F.split(text, " "), "")


def words(marked_text) -> F.Column:
    """The lower-cased words of a marked text."""
    return _split(F.lower(F.replace(marked_text, F.lit(MARK), F.lit(""))))


def templates(marked_text) -> list[F.Column]:
    """The three templates, each with one template word for each of the text's words().

    The first has no names, so equal words() always have an equal first template.
    """
    return [_typed(F.replace(marked_text, F.lit(MARK), F.lit(""))),
            _typed(F.regexp_replace(marked_text, MARK + "[^ ]*", NAME)),
            _typed(F.regexp_replace(marked_text, r"(?<![^ ])" + MARK + r"?\p{Lu}[^ ]*", NAME))]


def _typed(t) -> F.Column:
    """Template words of a text in which names are replaced."""
    # digits are rare: texts without one skip both passes
    unit = "|".join(u.replace("$", r"\$") for u in sorted(UNITS, key=len, reverse=True))
    numbers = F.regexp_replace(t, r"[^ \p{Nd}]*\p{Nd}[^ ]*", NUMBER)
    units = F.regexp_replace(numbers, f"(?i)(?<={NUMBER} )(?:{unit})(?![^ ])", UNIT)
    return _split(F.lower(F.when(t.rlike(r"\p{Nd}"), units).otherwise(t)))


def _window_hashes(tokens: str, size: int, stride: int = 1) -> F.Column:
    """Hashes of the windows of `size` words at every `stride`-th place; empty for shorter texts."""
    return F.when(F.size(tokens) >= size, F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (size - 1), F.lit(stride)),
        lambda i: F.xxhash64(F.slice(tokens, i, size)))).otherwise(F.array().cast("array<bigint>"))


def _literals(window: F.Column) -> F.Column:
    return F.size(F.filter(window, lambda w: ~w.isin(NAME, NUMBER, UNIT)))


def _all_templates(table: DataFrame, *key: str) -> DataFrame:
    """Per row and template: `key`, the words `raw`, the template `t`, whether it is the `first`."""
    m = table.select(*key, marked(F.col("text")).alias("m"))
    each = F.array(*[F.struct(F.lit(i == 0).alias("first"), t.alias("t")) for i, t in enumerate(templates(F.col("m")))])
    return m.select(*key, words(F.col("m")).alias("raw"), F.explode(each).alias("x")).select(*key, "raw", "x.first", "x.t")


def _enough(window: F.Column) -> F.Column:
    return 2 * _literals(window) >= F.size(window)


#: Shares of the documents with one text, so that very many copies are no one task's.
SHARES = 16


def _place(h, n_words: int) -> tuple[F.Column, F.Column]:
    """Of a hash: its word in a filter of `n_words` 64-bit words, and three bits of that word."""
    one = F.lit(1).cast("long")
    bit = lambda n: F.call_function("shiftleft", one, F.shiftrightunsigned(h, n).bitwiseAND(F.lit(63)).cast("int"))
    return F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(n_words - 1)).cast("int"), bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12))


def _filter_words(keys: DataFrame, n_keys: int) -> tuple[F.Column, int]:
    """A Bloom filter of column h of `keys` as an array of words (a scalar subquery), and their number.

    Two to four words a key, so a hash that is no key passes with probability of about 5e-5.
    """
    n_words = max(1024, 1 << (2 * n_keys - 1).bit_length())
    word, bits = _place(F.col("h"), n_words)
    set_ = keys.groupBy(word.cast("long").alias("w")).agg(F.bit_or(bits).alias("v"))
    all_ = keys.sparkSession.range(n_words).select(F.col("id").alias("w")).join(set_, "w", "left").select("w", F.coalesce("v", F.lit(0)).cast("long").alias("v"))
    words_ = materialise(all_, "benchmark-filter", n_words)
    return words_.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "v"))), lambda s: s.v)).scalar(), n_words


def _passes(hashes, words_, n_words: int) -> F.Column:
    """Whether one of the hashes may be a key. The filter is referred to once, so it is never copied into a row."""
    def test(h):
        word, bits = _place(h, n_words)
        return F.bitwise_not(F.get(words_, word)).bitwiseAND(bits) == 0
    return F.exists(hashes, test)


def _digest(text) -> F.Column:
    return F.unhex(F.sha2(text, 256))


class _Benchmark:
    """The written windows of the benchmark, and the probes by which texts that may hold one are told.

    Any k words in a row hold a run of `probe` words that starts at a multiple of
    k - probe + 1. So a document without a probe of the benchmark at these places has no
    window of it either.
    """

    def __init__(self, benchmark: DataFrame, window: int, min_words: int, max_broadcast: int):
        items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        items = _all_templates(items, "item_id").where(F.size("t") >= min_words)
        size = F.least(F.size("t"), F.lit(window))
        self.items = materialise(items, "benchmark-templates")
        grams = (self.items.select("*", size.alias("k"))
                 .select("*", F.explode(F.sequence(F.lit(1), F.size("t") - F.col("k") + 1)).alias("at"))
                 .select("item_id", "k", "at", "first", F.slice("t", F.col("at"), F.col("k")).alias("w"), F.slice("raw", F.col("at"), F.col("k")).alias("v")))
        # with too few words the words themselves are searched, found by probes of the first template
        grams = materialise(grams.where(F.col("first") | _enough(F.col("w"))), "benchmark-windows")
        shown = F.when(_enough(F.col("w")), F.col("w")).otherwise(F.col("v"))
        self.wanted = materialise(grams.select("item_id", "k", "at", F.xxhash64(shown).alias("h"), shown.alias("shown"), "w", "v").distinct(), "benchmark-keys")
        self.lengths = sorted(r.k for r in grams.select("k").distinct().collect())  # at most `window` - `min_words` + 1 numbers
        self.windows = self.items.groupBy(F.col("item_id").alias("i")).agg(F.max(F.size("t") - size + 1).alias("of"))
        if not self.lengths:
            return
        self.keys = self.wanted.select("k", "h").distinct()
        self.small = self.keys.count() <= max_broadcast
        self.probe = min(PROBE, self.lengths[0])
        self.stride = self.lengths[0] - self.probe + 1
        self.probes = materialise(grams.select(F.explode(_window_hashes("w", self.probe)).alias("h")).distinct(), "benchmark-probes")
        n = self.probes.count()
        self.filter = _filter_words(self.probes, n) if n <= max_broadcast else None

    def probed(self, texts: DataFrame) -> DataFrame:
        """`texts` with the hashes of their probes in an array `p`, and a column `at`; a null text has none.

        A filter on `p` must also refer to `at`: it then stays above the templates, which
        would otherwise be computed anew within it, for each window.
        """
        t = texts.select("*", marked(F.col("text")).alias("m"))
        t = t.select(*texts.columns, *[x.alias(f"t{i}") for i, x in enumerate(templates(F.col("m")))], F.monotonically_increasing_id().alias("at"))
        return t.select(*texts.columns, "at", F.concat(*[_window_hashes(f"t{i}", self.probe, self.stride) for i in range(3)]).alias("p"))

    def suspect(self) -> F.Column:
        """Of rows with probes `p` and the words of the `filter`: whether the text may hold a window."""
        return _passes(F.col("p"), F.col("filter"), self.filter[1])

    def flagged(self, texts: DataFrame) -> DataFrame:
        """`texts` with a column `hit`: whether the text has a probe of the benchmark, or may have one."""
        p = self.probed(texts)
        if self.filter is not None:
            return p.select("*", self.filter[0].alias("filter")).select(*texts.columns, self.suspect().alias("hit"))
        # a benchmark too large for a filter: its probes are joined, texts by their digests
        hits = (p.select(_digest(F.col("text")).alias("digest"), F.explode("p").alias("h"))
                .join(self.probes, "h", "left_semi").select("digest").distinct().withColumn("found", F.lit(True)))
        return (texts.withColumn("digest", _digest(F.col("text"))).join(hits, "digest", "left")
                .select(*texts.columns, F.coalesce("found", F.lit(False)).alias("hit")))

    def found(self, texts: DataFrame) -> DataFrame:
        """Items found in written `texts` (a column text): digest, item_id, n_windows, share, n_slots."""
        # few documents: words and values of all their windows
        sus = texts.where("text is not null").select(_digest(F.col("text")).alias("digest"), "text").dropDuplicates(["digest"])
        sus = _all_templates(sus, "digest")
        at = None
        for k in self.lengths:
            some = (sus.where(F.size("t") >= k)
                    .select("digest", F.lit(k).alias("k"), "raw", "t", F.explode(F.sequence(F.lit(0), F.size("t") - k)).alias("p"))
                    .select("digest", "k", "p", F.slice("t", F.col("p") + 1, k).alias("dw"), F.slice("raw", F.col("p") + 1, k).alias("dv"))
                    .withColumn("ds", F.when(_enough(F.col("dw")), F.col("dw")).otherwise(F.col("dv"))).drop("dw")
                    .withColumn("h", F.xxhash64("ds"))
                    .join((F.broadcast(self.keys) if self.small else self.keys).where(F.col("k") == k).select("h"), "h", "left_semi"))
            at = some if at is None else at.unionByName(some)
        same = F.col("v") == F.col("dv")
        both = at.join(self.wanted, ["k", "h"]).where(F.col("ds") == F.col("shown"))
        slots = F.filter(F.zip_with(F.arrays_zip("w", "v"), F.col("dv"),
                                    lambda x, d: F.struct(x.w.alias("kind"), x.v.alias("item"), d.alias("doc"))),
                         lambda s: s.kind.isin(NAME, NUMBER, UNIT))
        # one occurrence: the windows of an item at one distance from their place in the document
        hit = both.select("digest", "item_id", (F.col("p") - F.col("at")).alias("shift"), "at", same.alias("same"), F.array_distinct(slots).alias("slots"))
        # a window may match in several templates: with the item's values in one, it has them in all
        hit = materialise(hit.distinct(), "hits")
        where = ["digest", "item_id", "shift"]
        own = hit.where("same").groupBy(*where, "at").agg(F.max(F.size("slots")).alias("n_slots"))
        other = hit.where("not same").select(*where, "at", "slots")
        each = other.select(*where, "at", F.explode("slots").alias("s")).select(*where, "at", "s.kind", "s.item", "s.doc").distinct()
        votes = each.groupBy(*where, "kind", "item", "doc").agg(F.count(F.lit(1)).alias("n"))
        chosen = votes.groupBy(*where, "kind", "item").agg(F.max_by("doc", F.struct("n", "doc")).alias("chosen"))
        conflict = each.join(chosen, [*where, "kind", "item"]).where(F.col("doc") != F.col("chosen")).select(*where, "at").distinct().withColumn("bad", F.lit(True))
        other = other.groupBy(*where, "at").agg(F.max(F.size("slots")).alias("n_slots")).join(conflict, [*where, "at"], "left")
        fits = F.col("bad").isNull()
        per = (own.select(*where, F.lit(True).alias("own"), F.lit(False).alias("bad"), "n_slots")
               .unionByName(other.select(*where, F.lit(False).alias("own"), (~fits).alias("bad"), "n_slots"))
               .groupBy(*where).agg(F.count_if("own").alias("n_own"), F.count_if(~F.col("own") & ~F.col("bad")).alias("n_fit"),
                                    F.count_if(~F.col("own")).alias("n_other"), F.max(F.when(~F.col("bad"), F.col("n_slots"))).alias("n_slots")))
        per = per.join(self.windows, F.col("item_id").eqNullSafe(F.col("i")))
        counted = (2 * F.col("n_fit") >= F.col("n_other")) & (F.col("n_own") + F.col("n_fit") >= F.least(F.lit(2), F.col("of")))
        n = F.col("n_own") + F.when(counted, F.col("n_fit")).otherwise(0)
        return (per.withColumn("n", n).where("n > 0").groupBy("digest", "item_id")
                .agg(F.max("n").alias("n_windows"), F.max(F.least(F.lit(1.0), F.col("n") / F.col("of"))).alias("share"),
                     F.max(F.coalesce("n_slots", F.lit(0))).cast("bigint").alias("n_slots")))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_words: int = 5, max_broadcast: int = 200_000) -> DataFrame:
    """Contaminated documents: one row per doc_id and item_id with a consistent match.

    Columns: doc_id, item_id, and of the best occurrence of the item: n_windows
    (windows counted), share (of the item's windows), n_slots (slot values compared in one window).

    Windows have `window` words of one of the templates(), at least half of which
    must be words, not placeholders; a window with more placeholders counts with
    its words in place. An item with fewer words than `window` is one
    window as a whole; below `min_words` words it is too short to tell a passage and
    never matches. An item is found in a document if a window counts.

    Defined cases: null and empty texts match nothing; null ids are ids like any
    other (one null group). Each text of an id is searched on its own. Other
    columns are ignored; an empty benchmark or table gives an empty result.
    """
    bench = _Benchmark(benchmark, window, min_words, max_broadcast)
    if not bench.lengths:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, n_windows bigint, share double, n_slots bigint")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    if bench.filter is not None:
        p = bench.probed(texts).select("*", bench.filter[0].alias("filter"))
        texts = p.where(bench.suspect() & (F.col("at") >= 0)).select("doc_id", "text")
    else:
        texts = bench.flagged(texts).where("hit").select("doc_id", "text")
    texts = materialise(texts, "suspect-texts")
    found = bench.found(texts).withColumn("share_no", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    ids = texts.select("doc_id", _digest(F.col("text")).alias("digest")).distinct().withColumn(
        "share_no", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).cast("int"))
    return (ids.join(found, ["digest", "share_no"]).groupBy("doc_id", "item_id")
            .agg(*[F.max(c).alias(c) for c in ("n_windows", "share", "n_slots")]))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_words: int = 5, max_broadcast: int = 200_000) -> DataFrame:
    """The rows of `docs` in which no benchmark item is found, with their columns unchanged.

    The decision is about the text: rows with null ids, repeated ids or repeated rows
    stay or go by their own texts. Columns may have any names; text is the one searched.
    """
    bench = _Benchmark(benchmark, window, min_words, max_broadcast)
    if not bench.lengths:
        return docs
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    # written once with the flag: texts that have no probe are done
    rows = materialise(bench.flagged(rows).select("row", F.coalesce("hit", F.lit(False)).alias("hit")), "flagged")
    suspects = rows.where("hit").select("row", F.col("row.text").cast("string").alias("text"))
    bad = materialise(bench.found(suspects).select("digest").distinct(), "leaks")
    kept = suspects.withColumn("digest", _digest(F.col("text"))).join(bad, "digest", "left_anti")
    return rows.where("not hit").select("row.*").unionByName(kept.select("row.*"))
