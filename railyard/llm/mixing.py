"""Mixing sources to target weights by Poisson replication (operator 7).

Each source s with n_s rows and weight w_s is to make up the share w_s / sum(w)
of the mixture, so its rows repeat t_s = w_s / sum(w) * total / n_s times on
average. Every row draws its own number of copies: a number in [0, 1) from a
seeded hash of its id and text, through the inverted Poisson distribution of mean t_s.
The draw needs no order and no coordination, and is the same on every run.

Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import materialise

#: Longest run of probabilities that a source's distribution may need, as a function of its mean.
REACH = "cast(ceil(t + 12 * sqrt(t) + 40) as int)"


def uniform(*parts) -> F.Column:
    """A number in [0, 1) from the md5 of the parts: 52 bits, exact in a double."""
    text = F.concat_ws(":", *[p if isinstance(p, F.Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _cumulative(mean: str) -> F.Column:
    """Poisson distribution function at 0, 1, ..., as an array, summed in logarithms."""
    term = lambda s, k: s.lp + F.when(k > 0, F.log(F.col(mean)) - F.log(k.cast("double"))).otherwise(0.0)
    start = F.struct((-F.col(mean)).alias("lp"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("all"))

    def step(s, k):
        lp = term(s, k)
        total = s["sum"] + F.exp(lp)
        return F.struct(lp.alias("lp"), total.alias("sum"), F.concat(s["all"], F.array(total)).alias("all"))

    return F.aggregate(F.sequence(F.lit(0), F.expr(REACH)), start, step, lambda s: s["all"])


def rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """Per source: source, n, weight, t (mean repetitions) and the distribution.

    Without `weights` all sources weigh the same. With them, sources not named
    weigh nothing and get no copies; a null source is named by None. Negative,
    non-finite or all-zero weights are refused. `epochs` scales the mixture's
    size, 1 keeping the number of rows.
    """
    if weights is not None and (any(not (w >= 0 and math.isfinite(w)) for w in weights.values()) or sum(weights.values()) <= 0):
        raise ValueError("weights must be finite, not negative, and not all zero")
    per = docs.groupBy(F.col("source").cast("string").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("s").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    per = materialise(per.withColumn("weight", weight), "source-counts")
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("sum")).first()
    if not total.sum:
        return per.where("false").withColumn("t", F.lit(0.0)).withColumn("cdf", F.array().cast("array<double>"))
    t = F.col("weight") / F.lit(float(total.sum)) * F.lit(float(total.total) * epochs) / F.col("n")
    return per.withColumn("t", t).where("t > 0").withColumn("cdf", _cumulative("t"))


def _drawn(docs: DataFrame, weights: dict[str, float] | None, epochs: float, seed: int, max_broadcast: int) -> DataFrame:
    """Shuffled copies: row (all columns of `docs`, as one struct), copy, place."""
    per = materialise(rates(docs, weights, epochs).select("s", "cdf"), "source-rates")
    # the sources' table is small in practice; its size is checked before it is broadcast
    some = F.broadcast(per) if per.limit(max_broadcast + 1).count() <= max_broadcast else per
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    if "text" in docs.columns:
        key = F.concat(key, F.lit(":"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), key.alias("key"))
    joined = rows.join(some, F.col("source").eqNullSafe(F.col("s"))).withColumn("u", uniform(seed, F.col("key")))
    # copies: how many of 0, 1, ... have a distribution function at or below the drawn number
    copies = joined.select("row", "key", F.size(F.filter("cdf", lambda c: c <= F.col("u"))).alias("n")).where("n > 0")
    copies = copies.select("row", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    placed = copies.select("row", "copy", uniform(seed, "place", F.col("key"), F.col("copy").cast("string")).alias("place"))
    # a place is a random number: dealt by its hash, and in its order within a task, rows lie at random;
    # dealing by ranges would draw everything twice to find the ranges
    return placed.repartition("place").sortWithinPartitions("place", "copy")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: int = 42,
        max_broadcast: int = 10_000) -> DataFrame:
    """The rows of `docs` repeated to the target weights and shuffled globally.

    Columns of `docs`, of any names, then ``__copy`` (1, 2, ...) and ``__place`` (0 to 1),
    with more underscores in front where `docs` has such columns. Rows are drawn by
    doc_id and text (by doc_id where there is no text): each null-id row with a text of its
    own has its own draw, and rows alike in id, text and source share their number of
    copies. Rows with a null source form a source of their own. An empty table gives an
    empty result.
    """
    free = {}
    for c in ("copy", "place"):
        free[c] = f"__{c}"
        while free[c] in docs.columns:
            free[c] = "_" + free[c]
    out = _drawn(docs, weights, epochs, seed, max_broadcast)
    return out.select("row.*", *[F.col(c).alias(n) for c, n in free.items()])


def mixture(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: int = 42,
            max_broadcast: int = 10_000) -> DataFrame:
    """mix() with the columns of `docs` only."""
    return _drawn(docs, weights, epochs, seed, max_broadcast).select("row.*")
