"""Corpus pipeline: from documents to sharded training documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of documents.

1. quality: documents the pairwise quality classifier rejects go. It learns from
   the labelled documents of the whole corpus that are not held out.
2. near_duplicates: of each group of near-duplicate documents (five-word
   shingles, similarity 0.8 or more) one row stays, the one with the smallest id.
3. decontaminate: documents in which a benchmark item is found go.
4. mix: sources are repeated to equal weights (Poisson replication), shuffled.
5. shard: every row gets its slot and shard.

Every stage needs the columns doc_id, text and source and hands on all columns, whatever
their names (the last one replaces slot and shard). A null or empty text is scored as the
empty text, is no one's near duplicate and holds no benchmark item. Rows are judged one by
one: null ids, repeated ids and repeated rows are rows like others, and of rows with
the same text near_duplicates keeps one, whatever their ids. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import decontaminate, minhash_bbit, mixing, pairwise_quality, sharding
from railyard.llm.common import materialise, remove_scratch, scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pairwise_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the smallest id (null ids last), of rows with this id any one.

    Each row gets a number of its own as the rows are written, so that rows are told apart
    whatever their ids are.
    """
    rows = materialise(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "numbered")
    found = minhash_bbit.near_duplicates(rows.select("number", F.col("row.text").alias("text")), id_col="number", shingle=5, percent=80)
    lost = materialise(found.where("not kept").select(F.col("doc_id").alias("number"), F.col("component_id").alias("group")), "grouped")
    members = lost.unionByName(lost.select(F.col("group").alias("number"), "group").distinct())
    ids = rows.select("number", F.col("row.doc_id").cast("long").alias("doc_id")).join(members, "number")
    first = ids.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "number")).getField("number").alias("stays"))
    drop = materialise(members.join(first, "group").where("number <> stays").select("number"), "dropped")
    return rows.join(drop, "number", "left_anti").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs, sharding.default_shards())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shard", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again.

    What a stage wrote on its way, and its input, go once its output is written.
    """
    docs, mark = table(spark, sf_dir, "documents"), scratch()
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove_scratch(spark, mark)
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier is learned, the near-duplicate search is iterative: no SQL gives these rows.
ORACLE_SQL = None
