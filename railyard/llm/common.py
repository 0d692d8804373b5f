"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.session import delete_path, new_work_dir

#: ASCII white space, the word separators of every word operator here. The
#: same six characters ``bytes.split()`` splits on.
SPACE = r"[\x20\x09-\x0D]+"


def held_out(doc_id) -> F.Column:
    """True for the rows no classifier may learn from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Tables written by materialise() in this driver process, until they are taken away.
_SCRATCH: list[str] = []


def scratch() -> int:
    """A mark for remove_scratch(): the tables written up to now."""
    return len(_SCRATCH)


def remove_scratch(spark: SparkSession, since: int) -> None:
    """Delete the tables written after the mark but the newest: for a result that was itself written last."""
    for path in _SCRATCH[since:-1]:
        delete_path(spark, path)
    del _SCRATCH[since:-1]


def name(column: str) -> F.Column:
    """A column by its name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def materialise(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write `df` to a fresh table in the shared folder and read it back.

    Cuts the lineage and survives lost executors: every executor reads the
    table, no machine-local copy is involved. `rows`, if known, keeps a small
    result from being written as very many small files.
    """
    spark = df.sparkSession
    path = new_work_dir(spark, f"llm-{label}")
    _SCRATCH.append(path)
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, rows // 250_000))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, label: str = "components", rounds: int | None = None) -> DataFrame:
    """Connected components of undirected `edges` (columns a, b of any orderable type).

    Returns ``node, component`` for every node that is not the smallest of its
    component; the smallest node names the component. Alternates the large-star
    and small-star steps until the edge set is one star per component. Each
    step is a min-aggregation (combined map-side) and an equi-join back, so a
    component holding a third of all nodes needs no task that sees all of it:
    the joins are plain shuffle joins, which the adaptive skew split divides.
    Self-loops, repeated edges and null ends are ignored.

    With `rounds` it stops early: nodes with the same name are then connected,
    but a component may still have several names.
    """
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    e = materialise(e, label)
    state, done = _fingerprint(e), 0
    while state[0] and (rounds is None or done < rounds):
        low = e.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "u")
        large = e.join(low, F.col("lo") == F.col("u"), "left").select("hi", F.coalesce("m", "lo").alias("lo"))
        low = large.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "u")
        both = large.join(low, F.col("hi") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
                              F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x"))
        e = materialise(both.select("x.hi", "x.lo").where("hi <> lo").distinct(), label, state[0])
        before, state, done = state, _fingerprint(e), done + 1
        if before == state:
            break
    out = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return out if rounds is None else out.groupBy("node").agg(F.min("component").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and an order-free hash of them: equal when a round changed nothing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")),
                           F.bit_xor(F.hash("lo", "hi"))).first())
