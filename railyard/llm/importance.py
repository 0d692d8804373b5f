r"""Resampling towards a target distribution by hashed word features (operator 11).

Words come from the tokenizers library's pre-tokenisation, without any training: a Split
by a regular expression over the text with A-Z in lower case, which gives words with
their offsets. A feature is a run of one to `n` consecutive words, told by the offsets of
its first and last one; its bucket is the CRC-32 of its words, joined by one space.

The histogram of a document's buckets is kept (few numbers a document); those of all
documents and of all target texts are sums of them. A bucket's gain is the
logarithm of its share of the target's features over its share of the documents', with one
feature more in each bucket. A document's weight is the sum of its features' gains, and its
score the weight plus Gumbel noise from a hash of its id: the highest scores are a draw
without replacement, with probabilities in proportion to exp(weight / 1000).
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import materialise
from railyard.llm.segments import kept

#: Words: runs of digits, a-z and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Characters of a text split at once, and buckets of features remembered.
STEP, REMEMBERED = 1_000_000, 1_000_000
BUCKETS = 10_000


class Bucket(dict):
    """feature -> unsigned CRC-32 of its UTF-8 bytes modulo `n`, remembered; emptied when it has grown large."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature):
        if len(self) > REMEMBERED:
            self.clear()
        b = self[feature] = zlib.crc32(feature.encode()) % self.n
        return b


def splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def lowered(text: str) -> str:
    """A-Z in lower case, nothing else."""
    return text.encode().lower().decode()  # bytes.lower touches ASCII only


def words(split, text: str, step: int = STEP):
    """Words of a text with their offsets in it, in lists; a long text is cut between words."""
    text, at = lowered(text), 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + step) if len(text) - at > step else None
        end = cut.start() if cut else len(text)
        found = split.pre_tokenize_str(text[at:end])
        yield [(w, (a + at, z + at)) for w, (a, z) in found] if at else found
        at = end


def windows(found: list, size: int) -> list[tuple[str, tuple[int, int]]]:
    """Features of `size` consecutive words: joined by one space, with the offsets of the whole run."""
    if size == 1:
        return found
    return [(" ".join([w for w, _ in found[i:i + size]]), (found[i][1][0], found[i + size - 1][1][1]))
            for i in range(len(found) - size + 1)]


def histogram(split, text: str, bucket: Bucket, n: int, step: int = STEP) -> tuple[int, np.ndarray]:
    """Number of words of a text, and the buckets of its features."""
    count, out, tail = 0, [], []
    for found in words(split, text, step):
        count += len(found)
        for size in range(1, n + 1):
            # runs that began in the part before: its last size - 1 words go in front
            some = windows(tail[len(tail) - min(len(tail), size - 1):] + found if size > 1 else found, size)
            out += [bucket[f] for f, _ in some]
        tail = (tail + found)[-(n - 1):] if n > 1 else []
    return count, np.array(out, np.int64)


def _features(n: int, n_buckets: int):
    def run(batches):
        split, bucket = kept(("words", n_buckets), lambda: (splitter(), Bucket(n_buckets)))
        ints, lists = pa.int64(), pa.list_(pa.int32())
        for rb in batches:
            n_words, n_features, kinds, times = [], [], [], []
            for t in rb.column("text"):
                count, found = histogram(split, t.as_py() or "", bucket, n)
                k, c = np.unique(found, return_counts=True)
                n_words.append(count), n_features.append(len(found)), kinds.append(k.astype(np.int32)), times.append(c.astype(np.int32))
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array(n_words, ints), pa.array(n_features, ints),
                                              pa.array(kinds, lists), pa.array(times, lists)],
                                             ["doc_id", "n_words", "n_features", "buckets", "times"])
    return run


def features(texts: DataFrame, n: int = 1, n_buckets: int = BUCKETS, id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_features, and the histogram of its buckets (buckets, times). Nulls have no words."""
    number = F.lit(None) if id_col is None else F.col(id_col)
    src = texts.select(number.cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_features(n, n_buckets), "doc_id bigint, n_words bigint, n_features bigint, buckets array<int>, times array<int>")


def _sums(n_buckets: int):
    def run(batches):
        total = np.zeros(n_buckets, np.int64)
        for rb in batches:
            np.add.at(total, rb.column("buckets").flatten().to_numpy(), rb.column("times").flatten().to_numpy())
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])
    return run


def totals(featured: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket: `n_buckets` numbers, whatever the number of rows."""
    per_task = featured.select("buckets", "times").mapInArrow(_sums(n_buckets), "bucket bigint, n bigint")
    out = np.zeros(n_buckets, np.int64)
    for r in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + K) / ((s + 1)(T + K)))) of each of the K buckets, in doubles."""
    k = len(source)
    s_all, t_all = float(source.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigher(gain: np.ndarray):
    def run(batches):
        for rb in batches:
            buckets, times = rb.column("buckets"), rb.column("times")
            at = buckets.offsets.to_numpy().astype(np.int64)
            each = gain[buckets.flatten().to_numpy()] * times.flatten().to_numpy()
            weight = np.diff(np.concatenate(([0], np.cumsum(each)))[at - at[0]])
            yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weight, pa.int64())],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return run


def gumbel(doc_id, seed: int) -> F.Column:
    """floor(-1000 ln(-ln(u))) of a number between 0 and 1 from the sha256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, n: int = 1, n_buckets: int = BUCKETS,
             seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_features, weight, score, rank.

    Of the N rows with at least `min_words` words the floor(`percent` * N / 100) with the
    highest scores are drawn and ranked 1, 2, ..., ties to the smaller doc_id; rank is null
    for all others. `target` needs a column `text_col`.

    Defined cases: null and empty texts have no features and weight 0. A null id draws its
    noise as the text "null" and comes after all others in ties; rows that repeat an id
    each take part. Other columns are ignored. Without documents the result is empty; without
    target texts all buckets count alike in the target.
    """
    spark = docs.sparkSession
    rows = materialise(features(docs, n, n_buckets, id_col, text_col), "features")
    gain = gains(totals(rows, n_buckets), totals(features(target, n, n_buckets, None, text_col), n_buckets))
    weighed = rows.mapInArrow(_weigher(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id())
    scored = materialise(scored, "scores")
    able = F.col("n_words") >= min_words
    # All rows that take part in one order, dealt by ranges of it; `row` divides rows that repeat one
    # document. An id counts the rows of each range, so a rank is that plus the rows of earlier ranges.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    ordered = (scored.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("at", F.monotonically_increasing_id()))
    ordered = materialise(ordered, "ordered-scores")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before, total = [], 0
    for r in sorted(ordered.groupBy(part.alias("part")).count().collect(), key=lambda r: r.part):  # one number for each task
        before.append((r.part, total))
        total += r["count"]
    of_part = F.broadcast(spark.createDataFrame(before, "part bigint, before bigint"))
    rank = F.col("before") + within + 1
    drawn = (ordered.withColumn("part", part).join(of_part, "part")
             .select("doc_id", "n_features", "weight", "score", F.when(rank <= total * percent // 100, rank).alias("rank")))
    rest = scored.where(~able).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)
