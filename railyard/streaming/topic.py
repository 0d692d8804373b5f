"""The departures topic: Kafka options, and a file stand-in with the same shape.

The Kafka connector jar is not on this image's classpath, so tests and the
registered queries use a Parquet directory of (key, value, timestamp)
records; `read_topic` / `write_topic` pick Kafka when options name brokers.
The transforms downstream are identical either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.schemas import TOPIC_RECORD

TOPIC = "station-departures"
# Fixed value: partition count of the departures topic.
TOPIC_PARTITIONS = 10


def kafka_source_options(bootstrap: str, topic: str = TOPIC, starting: str = "earliest",
                         max_offsets_per_trigger: int | None = None,
                         min_partitions: int | None = None) -> dict:
    """Subscribe options. Start at `earliest` with kept checkpoints, so a
    restart resumes where it stopped (Q11); tolerate offsets lost to retention.

    Records are keyed by station, so a busy station fills one topic
    partition; `minPartitions` splits large partitions across several tasks.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_sink_options(bootstrap: str, topic: str = TOPIC) -> dict:
    """Producer settings of the poller (acks=all, 3 retries, 100 ms linger,
    1000-byte batches), as Kafka sink options."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "100",
        "kafka.batch.size": "1000",
    }


def read_topic(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
               streaming: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Topic records as a stream (live) or a batch (replay)."""
    if kafka:
        reader = spark.readStream if streaming else spark.read
        return reader.format("kafka").options(**kafka).load().select("key", "value", "timestamp")
    if streaming:
        r = spark.readStream.schema(TOPIC_RECORD)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.parquet(path)
    return spark.read.schema(TOPIC_RECORD).parquet(path)


def replay(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
           start=None, end=None) -> DataFrame:
    """Retained records between two record times, as a batch.

    For Kafka, pass `startingOffsets` / `endingOffsets` (or timestamps) in the
    options; for the file stand-in the bounds filter the record timestamp.
    """
    df = read_topic(spark, path, kafka, streaming=False)
    if start is not None:
        df = df.filter(F.col("timestamp") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("timestamp") < F.lit(end))
    return df


def write_topic(records: DataFrame, path: str | None = None, kafka: dict | None = None) -> None:
    """S4 (batch form): append records to the topic.

    On a broker the producer's partitioner routes records by key (station).
    The file stand-in keeps the writer's partitioning: routing ten station
    keys into ten files measured slower here (hash collisions leave files
    empty and cores idle) and did not reduce the per-group sketch cost.
    """
    if kafka:
        records.select(F.col("key"), F.col("value")).write.format("kafka").options(**kafka).save()
    else:
        records.write.mode("append").parquet(path)
