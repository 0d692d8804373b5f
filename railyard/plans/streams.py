"""Registered stream scenarios: the live queries run over the fixture.

The fixture's envelopes are published to the file-backed topic in arrival
order (several appends), and after each append the two queries run with
`availableNow` on their kept checkpoints: every run after the first is a
restart that must resume where the last one stopped. The sinks are then
read back through the store views.

A scenario is run once per session and fixture folder; the stream queries
registered on it read its sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from railyard.functions import columns as C
from railyard.operators import enrich as EN
from railyard.operators import metrics as M
from railyard.operators import store as ST
from railyard.plans import board as B
from railyard.session import new_work_dir
from railyard.streaming import jobs as J
from railyard.streaming import topic as TP

# Columns of F5 that the stream computes exactly (A4, A7, A8 are HLL-based).
EXACT_METRIC_COLUMNS = [
    "station_id", "station_name", "window_start", "window_end", "avg_delay", "max_delay",
    "delayed_departures", "on_time_departures", "significant_delays", "total_records",
    "latitude", "longitude",
]

_RUNS: dict[tuple, J.StreamDirs] = {}
_PROGRESS: dict[str, list[dict]] = {}


def _key(spark: SparkSession, sf_dir: str, scenario: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, scenario)


def publish(flat: DataFrame, dirs: J.StreamDirs) -> None:
    """S4 (file stand-in): encode and append one delivery to the topic."""
    TP.write_topic(EN.encode_envelopes(flat), dirs.topic)


def _hour(h: int):
    return F.lit(f"2024-01-01 {h:02d}:00:00").cast("timestamp")


def _run(spark: SparkSession, deliveries: list[DataFrame], label: str, **kw) -> J.StreamDirs:
    dirs = J.StreamDirs.fresh(spark, label)
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    # State partitions are fixed at the first start; the fixture's state is
    # a few thousand windows.
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        for part in deliveries:
            publish(part, dirs)
            for q in J.run_available_now(spark, dirs, **kw):
                _PROGRESS.setdefault(dirs.base, []).extend(
                    {"query": q.name, **p} for p in (q.recentProgress or []))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    return dirs


def _dealt(spark: SparkSession, flat: DataFrame, number, n: int) -> list[DataFrame]:
    """`flat` as `n` deliveries: `number` gives a row's, from its parsed collection time (null: in none).

    The rows are made and their times parsed once and written by delivery; taken from
    `flat`, each delivery would make all rows again.
    """
    path = new_work_dir(spark, "deliveries")
    rows = flat.withColumn("_ts", C.parse_ts("collected_at"))
    rows.select(*flat.columns, number(F.col("_ts")).alias("_delivery")).write.partitionBy("_delivery").parquet(path)
    schema = StructType([*flat.schema, StructField("_delivery", IntegerType())])
    return [spark.read.schema(schema).parquet(path).filter(F.col("_delivery") == i).drop("_delivery") for i in range(n)]


def in_order_run(spark: SparkSession, sf_dir: str) -> J.StreamDirs:
    """Four deliveries of six hours each, in time order (nothing is late)."""
    k = _key(spark, sf_dir, "in_order")
    if k not in _RUNS:
        from railyard.plans.catalog import perturbed_flat
        # unparseable times travel with the last delivery
        hour = lambda ts: F.when(ts < _hour(6), 0).when(ts < _hour(12), 1).when(ts < _hour(18), 2).otherwise(3)
        parts = _dealt(spark, perturbed_flat(spark, sf_dir), hour, 4)
        _RUNS[k] = _run(spark, parts, "in-order")
    return _RUNS[k]


def late_run(spark: SparkSession, sf_dir: str) -> J.StreamDirs:
    """T4 scenario: file 1 = before 12:00 with event_id % 25 <> 0; file 2 = from
    12:00 (and unparseable times); file 3 = before 12:00 with event_id % 25 = 0,
    which arrives after the watermark has passed all its windows."""
    k = _key(spark, sf_dir, "late")
    if k not in _RUNS:
        from railyard.plans.catalog import perturbed_flat
        tagged = F.col("event_id") % 25 == 0
        file = lambda ts: (F.when(F.coalesce(ts >= _hour(12), F.lit(True)), 1).when(tagged, 2).when(~tagged, 0))
        parts = _dealt(spark, perturbed_flat(spark, sf_dir), file, 3)
        _RUNS[k] = _run(spark, parts, "late")
    return _RUNS[k]


def redelivered_run(spark: SparkSession, sf_dir: str, once: bool) -> J.StreamDirs:
    """T10 scenario: two deliveries, before and from 12:00; the second, and a third after it,
    bring every tenth event of the first again. Departures only, each delivery a restart."""
    k = _key(spark, sf_dir, f"redelivered-{once}")
    if k not in _RUNS:
        from railyard.plans.catalog import perturbed_flat
        flat = perturbed_flat(spark, sf_dir)
        early = C.parse_ts("collected_at") < _hour(12)
        again = flat.filter(early & (F.col("event_id") % 10 == 0))
        parts = [flat.filter(early), flat.filter(F.coalesce(~early, F.lit(True))).unionByName(again), again]
        _RUNS[k] = _run(spark, parts, "redelivered", which=("departures",), once_within="1 hour" if once else None)
    return _RUNS[k]


def progress_summary(dirs: J.StreamDirs) -> dict:
    """Rows in, batches, peak state rows / bytes and watermark drops per query."""
    out: dict = {}
    for p in _PROGRESS.get(dirs.base, []):
        q = out.setdefault(p["query"], {"batches": 0, "input_rows": 0, "trigger_ms": 0, "state_rows": 0,
                                        "state_bytes": 0, "dropped_by_watermark": 0})
        q["batches"] += 1
        q["input_rows"] += int(p.get("numInputRows") or 0)
        q["trigger_ms"] += int((p.get("durationMs") or {}).get("triggerExecution") or 0)
        ops = p.get("stateOperators") or []
        if ops:
            q["state_rows"] = max(q["state_rows"], sum(int(o.get("numRowsTotal") or 0) for o in ops))
            q["state_bytes"] = max(q["state_bytes"], sum(int(o.get("memoryUsedBytes") or 0) for o in ops))
            q["dropped_by_watermark"] += sum(int(o.get("numRowsDroppedByWatermark") or 0) for o in ops)
    for q in out.values():
        q["rows_per_sec"] = round(q["input_rows"] / (q["trigger_ms"] / 1000.0), 1) if q["trigger_ms"] else None
    return out


def _latest_metrics(spark: SparkSession, dirs: J.StreamDirs) -> DataFrame:
    return ST.current_metrics(J.read_metrics_changelog(spark, dirs), as_of=None)


def stream_station_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest stored windows, exact columns."""
    return _latest_metrics(spark, in_order_run(spark, sf_dir)).select(*EXACT_METRIC_COLUMNS)


def stream_station_metrics_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, A7, A8 as streamed (HLL++); checked with a tolerance, not by hash."""
    return _latest_metrics(spark, in_order_run(spark, sf_dir)).select(
        "station_id", "window_start", "total_departures", "unique_lines", "on_time_pct", "delay_pct")


def stream_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every enriched departure is stored, late or not."""
    rec = J.read_departures(spark, late_run(spark, sf_dir))
    return rec.drop("batch_id")


def stream_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 on the stream: members delivered again, over batches and restarts, are stored once."""
    return J.read_departures(spark, redelivered_run(spark, sf_dir, once=True)).drop("batch_id")


def stream_recent_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 as the departures sink maintains it: newest 50 per station, read from
    the last incremental snapshot. Members are late and are delivered up to three times."""
    return J.read_recent_departures(spark, redelivered_run(spark, sf_dir, once=False))


def stream_live_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T12 over the sink's snapshot, as_of = latest collection time, TTL 60 s."""
    dirs = late_run(spark, sf_dir)
    return J.read_live_departures(spark, dirs, J.event_time(spark, dirs), ttl_seconds=60)


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: windows after the late delivery; the late rows are not in them."""
    return _latest_metrics(spark, late_run(spark, sf_dir)).select(*EXACT_METRIC_COLUMNS)


def batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch counts of both queries in the late-data scenario."""
    return J.read_audit(spark, late_run(spark, sf_dir))


def audit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the departures query read, rejected and stored in all, from its commits."""
    rows = J.read_audit(spark, late_run(spark, sf_dir)).filter("query = 'departures'")
    return rows.groupBy("query").agg(
        *[F.sum(c).alias(c) for c in ("rows_read", "rows_malformed", "rows_rejected", "rows_stored")],
        F.min("min_event_time").alias("min_event_time"), F.max("max_event_time").alias("max_event_time"))


def replay_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-read every retained record as a batch through the same transform."""
    records = TP.replay(spark, path=in_order_run(spark, sf_dir).topic)
    e = EN.enrich(EN.decode_envelopes(records), watermark=None)
    return M.round_metrics(M.station_window_metrics(e, exact=True))


def export_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station table written as CSV to the shared folder, read back."""
    from railyard.plans.catalog import rollup_all
    table = B.station_table(rollup_all(spark, sf_dir))
    path = new_work_dir(spark, "export") + "/station_table"
    B.export_board(table, path)
    return spark.read.option("header", "true").schema(table.schema).csv(path)
