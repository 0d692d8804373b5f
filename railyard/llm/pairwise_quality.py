"""Quality scores learned from preference pairs (operator 2).

Bradley-Terry ranking: of a document labelled good and one labelled bad, the
good one should win, with probability sigmoid(w . (f_good - f_bad)). The weights
minimise the logistic loss of the feature differences of drawn pairs. A
document's strength is w . f, and documents are accepted above a quantile of the
strengths of the labelled rows; the quantile is the one that separates their
labels best. The score is a logistic of the distance to that cut, placed so that
a score of ``accept`` falls on it.

Only features of the whole text enter: no id, source, language or label.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from railyard.llm.common import held_out

FEATURES = (
    "symbol_chars", "upper_chars", "digit_chars", "space_chars", "sentence_ends", "symbol_words", "shout_words",
    "digit_words", "bar_words", "mean_word", "short_words", "long_words", "distinct_words", "distinct_log",
    "repeat_next", "top_word", "longest_run", "distinct_lines", "log_words", "empty",
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"!\"#$%&*+/<=>@[\\]^_`{|}~")] = True
_CLASS = {"upper": np.arange(65, 91), "digit": np.arange(48, 58), "space": np.array([9, 10, 11, 12, 13, 32])}


def text_features(text: bytes | None) -> np.ndarray:
    """The features of one whole text, each within about 0 to 1 except the logarithms."""
    out = np.zeros(len(FEATURES))
    words = (text or b"").split()
    if not words:
        out[-1] = 1.0
        return out
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars, n = len(text), len(words)
    count: dict = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    kinds = list(count.items())
    c = np.fromiter((k for _, k in kinds), np.float64, len(kinds))
    length = np.fromiter((len(w) for w, _ in kinds), np.float64, len(kinds))
    share = lambda test: sum(k for w, k in kinds if test(w)) / n
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, n - 1)
    breaks = np.flatnonzero(~same)
    run = np.diff(np.concatenate(([-1], breaks, [n - 1]))).max()
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[:] = (
        hist[_SYMBOL].sum() / chars, hist[_CLASS["upper"]].sum() / chars, hist[_CLASS["digit"]].sum() / chars,
        hist[_CLASS["space"]].sum() / chars, (hist[46] + hist[33] + hist[63]) / n,
        share(lambda w: _SYMBOL[w[-1]] or _SYMBOL[w[0]]), share(lambda w: len(w) > 2 and w.isupper()),
        share(lambda w: w[:1].isdigit() or w[-1:].isdigit()), count.get(b"|", 0) / n,
        min(1.0, (length * c).sum() / n / 20), c[length <= 2].sum() / n, c[length > 15].sum() / n,
        len(kinds) / n, math.log1p(len(kinds)) / math.log1p(n), same.sum() / n, c.max() / n, min(1.0, run / 20),
        len(set(lines)) / len(lines), math.log1p(n) / 10, 0.0)
    return out


@dataclass(frozen=True)
class PairwiseModel:
    mean: tuple
    scale: tuple
    weights: tuple
    cut: float
    steep: float
    accept: float

    def score(self, f: np.ndarray) -> np.ndarray:
        z = np.clip((f - np.array(self.mean)) / np.array(self.scale), -8, 8) @ np.array(self.weights)
        t = np.clip(self.steep * (z - self.cut) + math.log(self.accept / (1 - self.accept)), -36, 36)
        return 1 / (1 + np.exp(-t))


def fit(f: np.ndarray, label: np.ndarray, accept: float = 0.7, n_pairs: int = 40_000, ridge: float = 1e-3,
        seed: int = 7) -> PairwiseModel:
    """Model from features and labels. With one label only (or no rows) every document scores alike:
    accepted if that label is 1 or there is none, else rejected."""
    good, bad = f[label == 1], f[label == 0]
    d = f.shape[1]
    if not len(good) or not len(bad):
        only_bad = len(bad) > 0
        return PairwiseModel((0.0,) * d, (1.0,) * d, (0.0,) * d, 1.0 if only_bad else -1.0, 1.0, accept)
    mean, scale = f.mean(0), f.std(0)
    scale = np.where(scale > 1e-6, scale, 1.0)
    z = np.clip((f - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    i = rng.choice(np.flatnonzero(label == 1), n_pairs)
    j = rng.choice(np.flatnonzero(label == 0), n_pairs)
    x = z[i] - z[j]
    w = np.zeros(d)
    for _ in range(30):  # Newton steps on the mean logistic loss of the pairs
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = -(x * (1 - p)[:, None]).mean(0) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / n_pairs + ridge * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    strength = z @ w
    order = np.argsort(strength, kind="stable")
    s, y = strength[order], label[order]
    # rejected below rank k: the share of bad rows caught less the share of good rows lost
    gain = np.concatenate(([0.0], np.cumsum(np.where(y == 0, 1 / len(bad), -1 / len(good)))))
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    k = int(best[len(best) // 2])
    cut = s[0] - 1.0 if k == 0 else s[-1] + 1.0 if k == len(s) else (s[k - 1] + s[k]) / 2
    gap = max(1e-3, float(np.median(strength[label == 1]) - cut), float(cut - np.median(strength[label == 0])))
    return PairwiseModel(tuple(mean), tuple(scale), tuple(w), float(cut), 4.0 / gap, accept)


def _featurise(batches):
    for rb in batches:
        f = [text_features(t) for t in rb.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([rb.column("quality"), pa.array(f, pa.list_(pa.float64()))], ["quality", "f"])


def train(docs: DataFrame, labels: DataFrame, max_per_label: int = 5000, accept: float = 0.7) -> PairwiseModel:
    """Learn from at most `max_per_label` labelled rows of each label: those with the smallest
    id hashes among the rows that are not held out. A document labelled both ways is left out."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
           .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
           .where("quality = most").drop("most").withColumn("h", F.xxhash64("doc_id")))
    picked = None
    for q in (0, 1):
        some = lab.where(F.col("quality") == q).orderBy("h", "doc_id").limit(max_per_label)
        picked = some if picked is None else picked.unionByName(some)
    # at most 2 * max_per_label rows of two numbers: safe to broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(picked.drop("h")), "doc_id")
    # of several texts of an id the smallest is learned: as many rows as ids, whatever the partitioning
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("quality", "text")
    got = rows.mapInArrow(_featurise, "quality int, f array<double>").collect()
    if not got:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0, int), accept)
    got.sort(key=lambda r: (r.quality, r.f))
    return fit(np.array([r.f for r in got]), np.array([r.quality for r in got]), accept)


def _scorer(model: PairwiseModel):
    def run(batches):
        for rb in batches:
            f = [text_features(t) for t in rb.column(rb.num_columns - 1).cast(pa.binary()).to_pylist()]
            s = model.score(np.array(f).reshape(len(f), len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(s, pa.float64())],
                                             [*rb.schema.names[:-1], "score"])
    return run


def score_documents(docs: DataFrame, model: PairwiseModel) -> DataFrame:
    """One row per row of `docs`: `row` (all its columns, as one struct) and score, 0 to 1.

    Null, empty and white-space texts get the score of the empty text. Repeated rows each
    get a row. Columns may have any names.
    """
    src = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(_scorer(model), StructType([src.schema["row"], StructField("score", DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, accept: float = 0.7, max_per_label: int = 5000) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 if score >= accept)."""
    model = train(docs, labels, max_per_label, accept)
    out = score_documents(docs.select("doc_id", "text"), model).select("row.doc_id", "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= accept).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, accept: float = 0.7, max_per_label: int = 5000) -> DataFrame:
    """The rows of `docs` whose score reaches `accept`, with their columns (of any names) unchanged."""
    scored = score_documents(docs, train(docs, labels, max_per_label, accept))
    return scored.where(F.col("score") >= accept).select("row.*")
