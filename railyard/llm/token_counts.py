"""Exact token counts of whole texts, huge ones in overlapping chunks (operator 3).

A text longer than `chunk` + `overlap` characters is cut into chunks that overlap by
`overlap` characters, each encoded on its own with offsets, in parallel. Shorter texts
are encoded whole, their repeated segments once (segments.py). Two
neighbours are spliced at a boundary proven stable:

* The pre-tokenizer cuts a text from left to right into pieces, and tokens never
  cross pieces. Where a piece starts at p, what follows depends on the text from
  p on alone. So if p is a piece start for the left chunk (whose cuts up to p are
  those of the whole text) and also for the right chunk, both agree from p on.
* A chunk's own ends can mislead it: the first characters may be the rest of a
  longer piece or special token, the last ones may continue beyond it. Starts
  within `guard` characters of an inner end are not used, and the right chunk
  must have a further complete piece after p.

Where two neighbours have no common start in the overlap, that document is cut
again with a four times wider overlap and chunk, until it splices or is encoded
whole. Counts are therefore those of the whole text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import materialise
from railyard.llm.segments import SegmentEncoder, kept, slices, tokenizer

#: No special token of the supported files is longer, and a piece's extent is
#: decided by at most this many characters beyond its end.
GUARD = 64
#: Characters of the parts that leave a cut at once.
YIELD = 8_000_000


def _tokenizer(path: str):
    """The library's encoder for a vocabulary file, once per Python worker."""
    return kept(("tokenizer", path), lambda: tokenizer(path))


def piece_starts(path: str, text: str) -> tuple[list[int], list[int]]:
    """Character starts of the pieces of `text` and the number of tokens before each.

    Offsets of byte-level tokens are those of whole characters, so the first
    token of a piece starts exactly where the piece does.
    """
    e = _tokenizer(path).encode(text, add_special_tokens=False)
    starts, before, last = [], [], -1
    for k, (w, (a, _)) in enumerate(zip(e.word_ids, e.offsets)):
        if w != last:
            starts.append(a), before.append(k)
            last = w
    return starts, [*before, len(e.ids)]


def _whole_counter(path: str):
    """Token counts of whole texts."""
    def run(batches):
        enc = kept(("segments", path), lambda: SegmentEncoder(path))
        for rb in batches:
            for at, texts in slices(rb.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [rb.column(0).slice(at, len(texts)), rb.column(1).slice(at, len(texts)), pa.array(enc.counts(texts), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])
    return run


def _part_counter(path: str):
    """Per part of a text: its tokens, and the piece starts in its overlaps with the tokens before each."""
    def run(batches):
        ints, lists = pa.int64(), pa.list_(pa.int64())
        for rb in batches:
            rows: list = []
            for row, part, parts, over, start, text in zip(*(rb.column(c) for c in range(6))):
                part, parts, over, start, text = (x.as_py() for x in (part, parts, over, start, text))
                at, before = piece_starts(path, text)
                size, left, right = len(text), [], []
                if part > 0:
                    left = [j for j, p in enumerate(at) if GUARD <= p <= over - GUARD]
                if part < parts - 1:
                    right = [j for j, p in enumerate(at[:-1]) if size - over + GUARD <= p <= size - GUARD]
                rows.append((row.as_py(), part, parts, before[-1], [start + at[j] for j in left], [before[j] for j in left],
                             [start + at[j] for j in right], [before[j] for j in right]))
            kinds = (pa.string(), pa.int32(), pa.int32(), ints, lists, lists, lists, lists)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)],
                                             ["row", "part", "parts", "n", "left", "left_n", "right", "right_n"])
    return run


def _cutter(chunk: int, overlap: int):
    """Parts of texts: a part starts `chunk` characters after the one before and reaches `overlap` into the next.

    Each text is sliced once; a part travels without the text beside it.
    """
    def batch(rows):
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)],
                                          ["row", "part", "parts", "overlap", "start", "piece"])

    def run(batches):
        rows, held = [], 0
        for rb in batches:
            for row, text in zip(rb.column("row"), rb.column("text")):
                row, text = row.as_py(), text.as_py()
                parts = 1 if len(text) <= chunk + overlap else -(-(len(text) - overlap) // chunk)
                for k in range(parts):
                    rows.append((row, k, parts, overlap, k * chunk, text[k * chunk:(k + 1) * chunk + overlap] if parts > 1 else text))
                    held += len(rows[-1][-1])
                    if held >= YIELD:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)
    return run


def _spliced(counted: DataFrame) -> DataFrame:
    """Per row: n_tokens, or null where two neighbours had no common start."""
    w = Window.partitionBy("row").orderBy("part")
    ahead = F.lead("left").over(w)
    j = counted.withColumn("common", F.when(F.col("part") < F.col("parts") - 1, F.array_intersect("right", ahead)))
    # the first common start ends this part's share; the next part goes on from there
    j = j.withColumn("at", F.try_element_at("common", F.lit(1)))
    j = j.withColumn("from_", F.lag("at").over(w))
    upto = F.when(F.col("part") == F.col("parts") - 1, F.col("n")).otherwise(
        F.try_element_at("right_n", F.array_position("right", F.col("at")).cast("int")))
    since = F.when(F.col("part") == 0, 0).otherwise(
        F.try_element_at("left_n", F.array_position("left", F.col("from_")).cast("int")))
    j = j.select("row", (upto - since).alias("share"))
    return j.groupBy("row").agg(F.when(F.count("share") == F.count(F.lit(1)), F.sum("share")).alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, limit: int = 1024, chunk: int = 24576, overlap: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `path` is a vocabulary file: .json for the tokenizers library, .model for
    sentencepiece (whose pieces carry no offsets by word: never cut into
    chunks). Neither begin, end nor other added tokens are counted; special strings
    inside texts are treated as the library does by default.

    Defined cases: a null text counts as empty (0 bytes, 0 tokens). Repeated
    rows and repeated or null ids each get their row. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    out = "doc_id bigint, n_bytes bigint, n_tokens bigint"
    over_limit = (F.col("n_tokens") > limit).alias("over_limit")
    if path.endswith(".model"):
        return base.mapInArrow(_whole_counter(path), out).select("*", over_limit)
    small = F.char_length("text") <= chunk + overlap
    done = base.where(small).mapInArrow(_whole_counter(path), out)

    # Long texts are known by their digest; equal parts of equal texts are encoded once.
    huge = base.where(~small).withColumn("row", F.sha2("text", 256))
    todo, counts = huge.select("row", "text"), None
    while True:
        parts = todo.mapInArrow(_cutter(chunk, overlap), "row string, part int, parts int, overlap int, start bigint, piece string")
        parts = parts.dropDuplicates(["row", "part"])  # deals the parts of one text to many tasks as well
        counted = parts.mapInArrow(_part_counter(path), "row string, part int, parts int, n bigint, left array<bigint>, left_n array<bigint>, right array<bigint>, right_n array<bigint>")
        got = materialise(_spliced(counted), "token-counts")
        good = got.where("n_tokens is not null")
        counts = good if counts is None else counts.unionByName(good)
        failed = got.where("n_tokens is null").select("row")
        if not failed.limit(1).count():
            break
        todo = huge.select("row", "text").join(failed, "row", "left_semi")
        chunk, overlap = chunk * 4, overlap * 4
    long_ = huge.select("doc_id", "n_bytes", "row").join(counts, "row").select("doc_id", "n_bytes", "n_tokens")
    return done.unionByName(long_).select("*", over_limit)
