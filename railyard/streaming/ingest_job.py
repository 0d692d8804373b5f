"""Streaming ingest (entry A): responses -> flatten / validate -> topic.

Two queries over one stream of API responses (JSON files, S3):

- valid departures of polled stations are encoded (P7) and appended to the
  topic (S4); with the file stand-in this is Spark's file sink, whose
  metadata log makes the output exactly-once across retries and restarts,
  and the downstream file source reads only committed files;
- rejected departures go to a quarantine table with their reason (FL3).

With Kafka options the topic side uses the Kafka sink instead (at-least-once;
the departures store's set semantics and the metrics upsert absorb
duplicates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from railyard.operators import enrich as EN
from railyard.operators import ingest as IN
from railyard.sources import responses as RS
from railyard.streaming.jobs import StreamDirs, _trigger


def quarantine_dir(dirs: StreamDirs) -> str:
    return f"{dirs.base}/quarantine"


def start_ingest(spark: SparkSession, responses_path: str, dirs: StreamDirs, stations: DataFrame,
                 kafka_sink: dict | None = None, trigger: str = "10 seconds") -> list[StreamingQuery]:
    responses = IN.enabled_only(RS.read_responses(spark, responses_path, streaming=True), stations,
                                key="requested_station_id")
    valid = IN.flatten_departures(responses)
    records = EN.encode_envelopes(valid)
    if kafka_sink:
        w = (records.select("key", "value").writeStream.format("kafka").options(**kafka_sink))
    else:
        w = records.writeStream.format("parquet").option("path", dirs.topic)
    q1 = _trigger(w.queryName("ingest_topic").outputMode("append")
                  .option("checkpointLocation", dirs.checkpoint("ingest_topic")), trigger).start()
    bad = IN.quarantine(responses).withColumn("quarantined_at", F.current_timestamp())
    q2 = _trigger(bad.writeStream.queryName("ingest_quarantine").format("parquet")
                  .option("path", quarantine_dir(dirs)).outputMode("append")
                  .option("checkpointLocation", dirs.checkpoint("ingest_quarantine")), trigger).start()
    return [q1, q2]


def run_ingest_available_now(spark: SparkSession, responses_path: str, dirs: StreamDirs,
                             stations: DataFrame, **kw) -> list[StreamingQuery]:
    qs = start_ingest(spark, responses_path, dirs, stations, trigger="availableNow", **kw)
    for q in qs:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return qs
