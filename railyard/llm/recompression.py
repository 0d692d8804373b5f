r"""Removal of repeated word windows by recompression (operator 4).

The words of a text are renamed in rounds, each of which shortens the text:

* runs, at first: a maximal run of equal words becomes one symbol, named by the word
  and the run's length;
* pairs, in every round: each symbol is a left or a right one by a bit of its name and the
  round; a left symbol followed by a right one becomes one symbol, named by both.

Names are 64-bit hashes of what they stand for, so all tasks give equal things
equal names without exchanging them. Every decision depends on a few neighbours
only; the stretch of words that decided it is carried along. A boundary between
two symbols whose stretch lies within a window is found in every other place where
the same window stands: equal substrings have equal interior symbols.

From the last round's boundaries each window of `window` words picks the one with
the smallest name among those decided within it: its anchor. The anchor is named by the
words of its stretch. (A window without such a boundary, as inside a long run, is
its own anchor.) Only names that occur twice in the corpus can belong to a
repeated window. For these alone the windows themselves are named, by 128-bit
hashes of all their words, grouped, and the first place of each is found; words
covered by a window that also starts earlier are removed.

Documents with exactly the same words are one from the start: of these, all but the
first are covered wholly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import materialise
from railyard.llm.minhash_bbit import WordHash, _mix

ROUNDS = 3
#: Bits of an anchor's name, and hexadecimal digits of a document's digest, that are sent between tasks.
#: Two that share them only have some more windows named in full.
NAME_BITS, ROW_DIGITS = 40, 10
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64((1 << 64) - 1)
#: Beyond the text: what was decided by its beginning or end is not decided within a window.
_OUT = 1 << 40
#: Words handled at once, several documents together; a longer text is one group of its own.
GROUP = 200_000


def _pair(a, b):
    return _mix(_mix(a * _GOLD + np.uint64(1)) + b)


def parse(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS):
    """Symbols after all rounds: first word, and first and last word of the deciding stretch of each.

    `names` are the words' hashes, `doc` a number for each word that changes
    from document to document (nothing is joined across).
    """
    n = len(names)
    sym, start, own = names.copy(), np.arange(n), doc
    # runs, decided by the words next to them
    first = np.flatnonzero(np.concatenate(([True], (sym[1:] != sym[:-1]) | (own[1:] != own[:-1])))) if n else start
    length = np.diff(np.append(first, n))
    sym = np.where(length > 1, _pair(sym[first], length.astype(np.uint64)), sym[first])
    start, own = first, own[first]
    edge = own[1:] != own[:-1]
    lo = np.where(np.concatenate((n > 0 and [True] or [], edge)), -_OUT, first - 1)
    hi = np.where(np.concatenate((edge, n > 0 and [True] or [])), _OUT, first + length)
    for r in range(rounds):
        # pairs
        left = (_mix(sym + np.uint64((r + 1) * int(_GOLD) & int(_TOP))) & np.uint64(1)).astype(bool)
        join = np.zeros(len(sym), bool)  # with the next one
        join[:-1] = left[:-1] & ~left[1:] & (own[1:] == own[:-1])
        second = np.zeros(len(sym), bool)
        second[1:] = join[:-1]
        # one that stays alone was decided by the neighbour it might have joined
        lo, hi = _widened(lo, hi, own, ~left & ~second, left & ~join)
        k = np.flatnonzero(join)
        lo[k], hi[k] = np.minimum(lo[k], lo[k + 1]), np.maximum(hi[k], hi[k + 1])
        sym[k] = _pair(sym[k], sym[k + 1])
        keep = ~second
        sym, start, own, lo, hi = sym[keep], start[keep], own[keep], lo[keep], hi[keep]
    return sym, start, own, lo, hi


def _widened(lo, hi, own, by_left, by_right):
    """Stretches of the symbols, widened by those of the left or right neighbour where that one decided."""
    m = len(own)
    if not m:
        return lo, hi
    edge = own[1:] != own[:-1]
    no_left, no_right = np.concatenate(([True], edge)), np.concatenate((edge, [True]))
    before_lo, before_hi = np.concatenate(([0], lo[:-1])), np.concatenate(([0], hi[:-1]))
    after_lo, after_hi = np.concatenate((lo[1:], [0])), np.concatenate((hi[1:], [0]))
    lo2 = np.where(by_left, np.where(no_left, -_OUT, np.minimum(lo, before_lo)), lo)
    hi2 = np.where(by_left & ~no_left, np.maximum(hi, before_hi), hi)
    hi2 = np.where(by_right, np.where(no_right, _OUT, np.maximum(hi2, after_hi)), hi2)
    lo2 = np.where(by_right & ~no_right, np.minimum(lo2, after_lo), lo2)
    return lo2, hi2


class Prefix:
    """Hashes of any stretch of words from prefix sums of a polynomial in two multipliers (128 bits)."""

    BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

    def __init__(self, names: np.ndarray):
        n = len(names)
        self.sums, self.inverse = [], []
        for k, b in enumerate(self.BASES):
            power = _powers(b, n + 1)
            value = _mix(names + np.uint64(k) * _GOLD)
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * power[:n], dtype=np.uint64))))
            self.inverse.append(_powers(pow(b, -1, 1 << 64), n + 1))

    def hash(self, a: np.ndarray, z: np.ndarray, k: int) -> np.ndarray:
        """Of the words a to z (excluded)."""
        s = self.sums[k]
        return _mix(_mix((s[z] - s[a]) * self.inverse[k][a]) + (z - a).astype(np.uint64))


_POWER: dict = {}


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWER.get(base)
    if got is None or len(got) < n:
        size = max(n, GROUP + 1)
        got = np.full(size, np.uint64(base), np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        if size <= 4 * GROUP:
            _POWER[base] = got
    return got[:n]


def anchors(names: np.ndarray, doc: np.ndarray, window: int):
    """For every window of words (given by its first word): whether it is one, and the name of its anchor.

    Returns (valid, name, prefix hashes): the first two are arrays over the words.
    """
    n = len(names)
    ends = np.searchsorted(doc, doc, side="right") if n else np.empty(0, int)
    valid = np.arange(n) + window <= ends
    pre = Prefix(names)
    _, start, own, lo, hi = parse(names, doc)
    best = np.full(n, _TOP)
    if len(start) > 1:
        # the boundary before symbol i: decided by that symbol and the one before
        same = own[1:] == own[:-1]
        l, h = np.minimum(lo[1:], lo[:-1])[same], np.maximum(hi[1:], hi[:-1])[same]
        at = start[1:][same]
        ok = h - l < window
        l, h, at = l[ok], h[ok], at[ok]
        # named by the words of its stretch and its place in it
        key = _mix(pre.hash(l, h + 1, 0) + (at - l).astype(np.uint64))
        for shift in range(window):
            use = (h < l - shift + window) & (l >= shift)
            np.minimum.at(best, l[use] - shift, key[use])
    name = best
    i = np.flatnonzero(valid & (best == _TOP))
    name[i] = _mix(pre.hash(i, i + window, 0) ^ np.uint64(0x1234567))
    return valid, name, pre


def _groups(texts: list, words: WordHash):
    """Texts taken together: (their numbers, word lists, names, document numbers)."""
    took, lists, names, size = [], [], [], 0
    for k, t in enumerate(texts):
        w = (t or b"").split()
        took.append(k), lists.append(w)
        names.append(np.fromiter(map(words.__getitem__, w), np.uint64, len(w)))
        size += len(w)
        if size >= GROUP:
            yield took, lists, names
            took, lists, names, size = [], [], [], 0
    if took:
        yield took, lists, names


def _flat(names):
    doc = np.repeat(np.arange(len(names)), [len(x) for x in names])
    return np.concatenate(names) if names else np.empty(0, np.uint64), doc


def _digest(words: list) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _own_repeats(h: np.ndarray) -> np.ndarray:
    """Which of a document's windows also start earlier in it, by their hashes."""
    again = np.ones(len(h), bool)
    again[np.unique(h, return_index=True)[1]] = False
    return again


def _short(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - NAME_BITS)).view(np.int64)


def _first_pass(window: int):
    """Per document: digest, names of its windows' anchors, and those of windows it holds twice."""
    def run(batches):
        words = WordHash()
        for rb in batches:
            texts = rb.column("text").cast(pa.binary()).to_pylist()
            n, sha, keys, twice = ([None] * len(texts) for _ in range(4))
            for took, lists, names in _groups(texts, words):
                flat, doc = _flat(names)
                valid, name, pre = anchors(flat, doc, window)
                cut = np.cumsum([0, *map(len, names)])
                for j, k in enumerate(took):
                    i = np.flatnonzero(valid[cut[j]:cut[j + 1]]) + cut[j]
                    n[k], sha[k] = len(lists[j]), _digest(lists[j])
                    keys[k] = np.unique(_short(name[i]))
                    twice[k] = np.unique(_short(name[i[_own_repeats(pre.hash(i, i + window, 0))]]))
            lists_ = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), rb.column("unnamed"), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                                              pa.array(keys, lists_), pa.array(twice, lists_)],
                                             ["doc_id", "unnamed", "n_words", "sha", "keys", "twice"])
    return run


def _packed(batches):
    """Texts compressed, as they are dealt to the tasks that look at them again."""
    pack = zstandard.ZstdCompressor(level=3)
    for rb in batches:
        texts = rb.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array([pack.compress(t or b"") for t in texts], pa.binary())], ["doc_id", "packed"])


def _second_pass(window: int):
    """Per document, the windows whose anchor's name may repeat: hashes of all their words, and first words.

    Of windows that a document holds several times only the first is listed by
    hash; the places of the later ones are in `again`, as they surely go.
    """
    def run(batches):
        words, seen, unpack = WordHash(), set(), zstandard.ZstdDecompressor()
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        for rb in batches:
            texts = [unpack.decompress(t) for t in rb.column("packed").to_pylist()]
            first, sha, listed = (rb.column(c).to_pylist() for c in ("first", "sha", "keys"))
            for took, lists, names in _groups(texts, words):
                flat, doc = _flat(names)
                valid, name, pre = anchors(flat, doc, window)
                cut = np.cumsum([0, *map(len, names)])
                rows: list = []
                for j, k in enumerate(took):
                    if sha[k] in seen or _digest(lists[j]) != sha[k]:
                        continue
                    seen.add(sha[k])
                    i = np.flatnonzero(valid[cut[j]:cut[j + 1]]) + cut[j]
                    i = i[np.isin(_short(name[i]), np.array(listed[k], np.int64))]
                    h1 = pre.hash(i, i + window, 0)
                    later = _own_repeats(h1)
                    at = (i - cut[j]).astype(np.int32)
                    rows.append((first[k], int(sha[k][:ROW_DIGITS], 16), h1[~later].view(np.int64), pre.hash(i[~later], i[~later] + window, 1).view(np.int64),
                                 at[~later], at[later]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), longs, longs, ints, ints))],
                    ["first", "row", "h1", "h2", "at", "again"])
    return run


def _third_pass(window: int):
    """Documents without the words that the windows at the listed places cover."""
    def run(batches):
        seen, unpack = set(), zstandard.ZstdDecompressor()
        for rb in batches:
            rows = []
            for row, at, t in zip(rb.column("row").to_pylist(), rb.column("at").to_pylist(), rb.column("packed").to_pylist()):
                w = unpack.decompress(t).split()
                sha = _digest(w)
                if sha in seen or int(sha[:ROW_DIGITS], 16) != row:
                    continue
                seen.add(sha)
                edge = np.zeros(len(w) + 1, np.int64)
                i = np.array(at, np.int64)
                np.add.at(edge, i, 1)
                np.add.at(edge, i + window, -1)
                kept = [x for x, covered in zip(w, np.cumsum(edge)[:-1].tolist()) if not covered]
                rows.append((sha, len(w) - len(kept), _digest(kept), b" ".join(kept).decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))],
                ["sha", "n_removed", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256, kept.

    Words are runs of characters other than the six ASCII white-space ones. A
    word goes if a window of `window` words covers it whose word sequence also
    starts earlier: in a smaller doc_id, or before it in the same document.
    Windows are judged on the input. ``kept`` is the text of the kept words joined
    by one space where anything was removed (else null: the text stays), the
    digest that of the kept words in any case.

    Defined cases: null and empty texts have no words. Rows that repeat an id with
    the same words are one document; with other words they are not earlier than each
    other. Null ids come last, beside the largest possible id: neither is earlier than
    the other. Other columns are ignored; an empty table gives an empty result.
    """
    last = (1 << 63) - 1
    given = F.col(id_col).cast("long")
    base = docs.select(F.coalesce(given, F.lit(last)).alias("doc_id"), given.isNull().alias("unnamed"), F.col(text_col).cast("string").alias("text"))
    seen = materialise(base.mapInArrow(_first_pass(window), "doc_id bigint, unnamed boolean, n_words bigint, sha string, keys array<bigint>, twice array<bigint>"), "parsed")
    # Documents of the same words: the first of them stands for all.
    some = seen.where(F.col("n_words") >= window)
    firsts = some.groupBy("sha").agg(F.min("doc_id").alias("first"))
    lists = some.groupBy("sha").agg(F.any_value("keys").alias("keys"), F.any_value("twice").alias("twice"))
    short = F.conv(F.substring("sha", 1, ROW_DIGITS), 16, 10).cast("bigint")
    lists = lists.select(short.alias("row"), "keys", "twice")
    each = lists.select("row", F.explode("keys").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    found = each.join(often, "key").select("row", "key").unionByName(lists.select("row", F.explode("twice").alias("key")))
    keys = materialise(found.groupBy("row").agg(F.collect_set("key").alias("keys")), "repeated-names")

    chosen = firsts.withColumn("row", short).join(keys, "row").select("first", "sha", "keys")
    texts = base.select("doc_id", "text").mapInArrow(_packed, "doc_id bigint, packed binary")
    windows = materialise(texts.join(chosen, F.col("doc_id") == F.col("first")).select("first", "sha", "keys", "packed")
                          .mapInArrow(_second_pass(window), "first bigint, row bigint, h1 array<bigint>, h2 array<bigint>, at array<int>, again array<int>"), "windows")
    named = windows.select("first", "row", F.explode(F.arrays_zip("h1", "h2", "at")).alias("w")).select("first", "row", "w.h1", "w.h2", "w.at")
    earliest = named.groupBy("h1", "h2").agg(F.min("first").alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    gone = (named.join(earliest, ["h1", "h2"]).where("first > f").select("first", "row", "at")
            .unionByName(windows.select("first", "row", F.explode("again").alias("at"))))
    gone = gone.groupBy("first", "row").agg(F.collect_list("at").alias("at"))
    cut = (texts.join(gone, F.col("doc_id") == F.col("first")).select("row", "at", "packed")
           .mapInArrow(_third_pass(window), "sha string, n_removed bigint, kept_sha256 string, kept string"))
    # rows that repeat a document may lie in several tasks of the third pass
    cut = cut.dropDuplicates(["sha"])

    empty = hashlib.sha256(b"").hexdigest()
    copy = F.col("doc_id") > F.col("first")  # a later copy of a whole document
    return (seen.select("doc_id", "unnamed", "n_words", "sha").join(firsts, "sha", "left").join(cut, "sha", "left")
            .select(F.when(~F.col("unnamed"), F.col("doc_id")).alias("doc_id"), "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
                    F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
                    F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")))
