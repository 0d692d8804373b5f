"""The two streaming queries (S5, S6, T1-T4, T13-T18) and their sinks.

One enriched stream feeds two queries:

- departures: append, no state, one distributed Parquet write per
  micro-batch (late rows are kept, Q15);
- metrics: 15-minute tumbling windows with a 10-minute watermark in update
  mode; each micro-batch's updated windows are appended to a changelog,
  and readers take the latest row per key (see `railyard.operators.store`).

Each batch is written to a folder of its own and then published in the sink's
manifest (`railyard.streaming.manifest`), which readers follow: a batch that is
retried, an attempt that failed half-way and a fresh checkpoint on an old sink
all leave every departure stored once. A failing write fails the batch instead
of being swallowed (Q12). Counts and event-time bounds come from `observe` on the
single write (Q13) and are part of the commit (A22, T17). Checkpoints are kept
across restarts (Q11).
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from railyard.operators import enrich as EN
from railyard.operators import metrics as M
from railyard.operators import store as ST
from railyard.schemas import METRICS_CHANGELOG, STORED_DEPARTURE, WATERMARK_DELAY
from railyard.session import delete_path, ensure_utc, new_work_dir
from railyard.streaming import manifest as MF
from railyard.streaming import topic as TP

# Live trigger intervals of the two queries.
DEPARTURES_TRIGGER = "10 seconds"
METRICS_TRIGGER = "1 minute"


@dataclasses.dataclass(frozen=True)
class StreamDirs:
    """Folder layout under one shared base folder."""
    base: str

    @property
    def topic(self) -> str:
        return f"{self.base}/topic"

    @property
    def departures(self) -> str:
        return f"{self.base}/departures"

    @property
    def metrics(self) -> str:
        return f"{self.base}/metrics"

    @property
    def recent(self) -> str:
        return f"{self.base}/recent_departures"

    def manifest(self, query: str) -> MF.Manifest:
        return MF.Manifest(f"{self.base}/manifest/{query}")

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    @classmethod
    def fresh(cls, spark: SparkSession, label: str = "stream") -> "StreamDirs":
        return cls(new_work_dir(spark, label))


def enriched_stream(spark: SparkSession, dirs: StreamDirs, kafka: dict | None = None,
                    max_files_per_trigger: int | None = None, watermark: str | None = WATERMARK_DELAY,
                    usable_only: bool = True) -> DataFrame:
    """S1 -> P8 -> P9-P13, FL1, FL2 -> T1 watermark (10 minutes)."""
    ensure_utc(spark)
    records = TP.read_topic(spark, dirs.topic, kafka, streaming=True,
                            max_files_per_trigger=max_files_per_trigger)
    return EN.enrich(EN.decode_envelopes(records), watermark=watermark, usable_only=usable_only)


def once_each(enriched: DataFrame, within: str) -> DataFrame:
    """T10 on the stream: a member that is delivered again within `within` of its first delivery goes.

    The watermark is on the record's arrival on the topic, not on `collected_at`: arrival
    times advance with the stream, so a row that is late by its collection time is kept
    (T4), and the state holds the members of the last `within` only. Members are told by the
    whole payload, so the rows of a busy station spread over all state partitions.
    """
    return (enriched.withWatermark("kafka_timestamp", within)
            .dropDuplicatesWithinWatermark(ST.PAYLOAD_COLUMNS))


def bounds(low: str, high: str) -> list:
    """Bounds of the event time, in microseconds: the same in every time zone of a driver."""
    return [F.min(F.unix_micros(low)).alias("min_event_us"), F.max(F.unix_micros(high)).alias("max_event_us")]


def departures_writer(dirs: StreamDirs, k: int = 50):
    """foreachBatch function writing stored departures (F6) of one batch.

    Besides the full history it maintains the recent-k list per station (T9)
    incrementally: snapshot(N) = top-k(snapshot(N-1) + batch N). The snapshot
    holds at most k rows per station and the top-k runs as a window-group limit.

    A run on a fresh checkpoint is handed what earlier runs may have stored: rows
    whose members lie in earlier commits of the same event times are left out.
    Commits outside the batch's event times are not read.

    The batch holds the unusable rows too (FL1, FL2): they are counted and left out here,
    in the job that writes the others, so the commit tells what was read, malformed,
    rejected and stored, and how far the collection times lie behind the clock (P10).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, log = batch.sparkSession, dirs.manifest("departures")
        at, before = log.begin(spark, batch_id)
        if at is None:
            return
        read, kept = (Observation(f"{name}_{uuid.uuid4().hex}") for name in ("read", "kept"))
        lag = F.unix_micros(F.current_timestamp()) - F.unix_micros("collected_at_ts")
        rows = batch.observe(read, F.count(F.lit(1)).alias("rows_read"), F.count_if(EN.malformed()).alias("rows_malformed"),
                             F.max(lag).alias("max_lag_us")).filter(EN.usable())
        rec = ST.departure_records(rows).withColumn("batch_id", F.lit(at.position).cast("long")).observe(
            kept, F.count(F.lit(1)).alias("rows_stored"), *bounds("collected_at_ts", "collected_at_ts"))
        out = at.folder(dirs.departures)
        rec.write.parquet(out)
        counts = {**read.get, **kept.get}
        again = MF.overlapping(before, at, counts.get("min_event_us"), counts.get("max_event_us"))
        written = MF.read(spark, [out], STORED_DEPARTURE)
        if again:
            out = at.folder(dirs.departures)
            new = ST.not_stored(written, MF.read(spark, again, STORED_DEPARTURE))
            new.write.parquet(out)
            written = MF.read(spark, [out], STORED_DEPARTURE)
            counts["rows_stored"] = written.count()
        # Recent-k from what was just written (no second pass over the source).
        last = MF.newest_snapshot(before)
        merged = written if last is None else written.unionByName(MF.read(spark, [last], STORED_DEPARTURE))
        snapshot = at.folder(dirs.recent)
        ST.recent_departures(merged, k).drop("rank").write.parquet(snapshot)
        log.publish(spark, "batch", at, out, snapshot, counts)
    return write


def metrics_writer(dirs: StreamDirs):
    """foreachBatch function appending updated windows to the changelog.

    Rounds (P16), drops groups that cannot be stored (FL9), stamps key, position of
    the commit (as batch_id: later commits win, over all runs) and update time, and
    partitions by metric_date (P25) for lookback pruning.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, log = batch.sparkSession, dirs.manifest("metrics")
        at, _ = log.begin(spark, batch_id)
        if at is None:
            return
        obs = Observation(f"metrics_{uuid.uuid4().hex}")
        ok = (F.col("station_name").isNotNull() & F.col("avg_delay").isNotNull()
              & F.col("max_delay").isNotNull())
        rounded = M.round_metrics(batch).observe(
            obs, F.count(F.lit(1)).alias("rows_read"), F.count_if(ok).alias("rows_stored"),
            *bounds("window_start", "window_end"))
        out = at.folder(dirs.metrics)
        ST.metric_rows(M.storable(rounded), at.position, F.current_timestamp()).write.partitionBy("metric_date").parquet(out)
        log.publish(spark, "batch", at, out, counts=obs.get)
    return write


def _in_pool(spark: SparkSession, name: str, start):
    """Start a query with its jobs in scheduler pool `name` (used under FAIR)."""
    sc = spark.sparkContext
    prev = sc.getLocalProperty("spark.scheduler.pool")
    sc.setLocalProperty("spark.scheduler.pool", name)
    try:
        return start()
    finally:
        sc.setLocalProperty("spark.scheduler.pool", prev)


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start(spark: SparkSession, dirs: StreamDirs, kafka: dict | None = None,
          departures_trigger: str = DEPARTURES_TRIGGER, metrics_trigger: str = METRICS_TRIGGER,
          rsd: float = 0.01, which: tuple[str, ...] = ("departures", "metrics"),
          max_files_per_trigger: int | None = None, window: str = "15 minutes",
          slide: str | None = None, once_within: str | None = None) -> list[StreamingQuery]:
    """Start the departures and metrics queries over one enriched stream.

    `window` / `slide` set the metrics windows (tumbling 15 minutes by
    default; a slide gives the sliding variant, T3). With `once_within` ("1 hour",
    say) the departures query stores a redelivered member once (T10, once_each).
    State partitions are fixed at the first checkpoint
    from `spark.sql.shuffle.partitions`; size that to the state (windows x
    stations, or members) before the first start.
    """
    enriched = enriched_stream(spark, dirs, kafka, max_files_per_trigger)
    queries = []
    if "departures" in which:
        # unusable rows have no members to compare, so they are left out before once_each, uncounted
        rows = enriched_stream(spark, dirs, kafka, max_files_per_trigger, watermark=None, usable_only=bool(once_within))
        if once_within:
            rows = once_each(rows, once_within)
        w = (EN.departure_view(rows).writeStream.queryName("departures")
             .outputMode("append").foreachBatch(departures_writer(dirs))
             .option("checkpointLocation", dirs.checkpoint("departures")))
        queries.append(_in_pool(spark, "departures", _trigger(w, departures_trigger).start))
    if "metrics" in which:
        agg = M.station_window_metrics(enriched, window, slide, exact=False, rsd=rsd)
        w = (agg.writeStream.queryName("metrics").outputMode("update")
             .foreachBatch(metrics_writer(dirs))
             .option("checkpointLocation", dirs.checkpoint("metrics")))
        queries.append(_in_pool(spark, "metrics", _trigger(w, metrics_trigger).start))
    return queries


def run(spark: SparkSession, queries: list[StreamingQuery], poll_seconds: int = 5) -> None:
    """Wait until any of these queries ends; then stop the rest in start order.

    Waiting on all of them (not only the first) means a failure in either is
    seen and re-raised. Terminations of unrelated queries in the session are
    reset and ignored.
    """
    try:
        while all(q.isActive for q in queries):
            try:
                spark.streams.awaitAnyTermination(poll_seconds)
            except StreamingQueryException:
                pass  # raised for any query of the session; ours are looked at below
            spark.streams.resetTerminated()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        for q in queries:
            if q.exception():
                raise q.exception()


def run_available_now(spark: SparkSession, dirs: StreamDirs, **kw) -> list[StreamingQuery]:
    """Process everything now in the topic, then stop (tests, replay, catch-up)."""
    qs = start(spark, dirs, departures_trigger="availableNow", metrics_trigger="availableNow", **kw)
    for q in qs:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return qs


def read_departures(spark: SparkSession, dirs: StreamDirs) -> DataFrame:
    return MF.read(spark, MF.live_paths(dirs.manifest("departures").commits(spark)), STORED_DEPARTURE)


def read_metrics_changelog(spark: SparkSession, dirs: StreamDirs) -> DataFrame:
    """Every batch of the changelog that has not been retired, folded into a compaction or not."""
    rows = dirs.manifest("metrics").commits(spark)
    return MF.read(spark, [r.path for r in rows if r.kind == "batch" and r.path], METRICS_CHANGELOG)


def read_audit(spark: SparkSession, dirs: StreamDirs) -> DataFrame:
    """One row of counts and event-time bounds per query and batch, from the commits.

    For the metrics query rows are updated windows, rejected are those that cannot be stored (FL9).
    In a departures run that repeats an earlier one, rejected rows include those stored before.
    """
    out = None
    for query in ("departures", "metrics"):
        rows = (dirs.manifest(query).table(spark).filter("kind = 'batch'")
                .select(F.lit(query).alias("query"), "run_no", "batch_id", "rows_read", "rows_malformed", "rows_stored",
                        (F.col("rows_read") - F.col("rows_stored")).alias("rows_rejected"), (F.col("max_lag_us") / 1e6).alias("max_lag_sec"),
                        F.timestamp_micros("min_event_us").alias("min_event_time"), F.timestamp_micros("max_event_us").alias("max_event_time")))
        out = rows if out is None else out.unionByName(rows)
    return out


def event_time(spark: SparkSession, dirs: StreamDirs, query: str = "departures"):
    """`as_of` of a sink from its commits, as a literal: no look at the data."""
    return F.timestamp_micros(F.lit(MF.event_time_bound(dirs.manifest(query).commits(spark))).cast("long"))


def _snapshot(spark: SparkSession, dirs: StreamDirs) -> DataFrame:
    last = MF.newest_snapshot(dirs.manifest("departures").commits(spark))
    return MF.read(spark, [] if last is None else [last], STORED_DEPARTURE).drop("batch_id")


def read_recent_departures(spark: SparkSession, dirs: StreamDirs, k: int = 50) -> DataFrame:
    """T9 from the newest snapshot only (k rows per station at most)."""
    return ST.recent_departures(_snapshot(spark, dirs), k)


def read_live_departures(spark: SparkSession, dirs: StreamDirs, as_of,
                         ttl_seconds: int = 3600, k: int = 50) -> DataFrame:
    """T12 from the newest snapshot: stations whose last write is within the TTL.

    The newest entry of a station's list is its last write, so the snapshot
    alone answers the expiry test.
    """
    return ST.live_departures(_snapshot(spark, dirs), as_of, ttl_seconds, k)


def read_metrics(spark: SparkSession, dirs: StreamDirs) -> DataFrame:
    """The metrics store: latest compaction plus the changelog batches after it.

    Feed it to `store.current_metrics` / `recent_metrics` like the raw
    changelog; the result is the same, but the scan stops growing with the
    number of batches.
    """
    return MF.read(spark, MF.live_paths(dirs.manifest("metrics").commits(spark)), METRICS_CHANGELOG)


def compact_metrics(spark: SparkSession, dirs: StreamDirs, as_of, ttl_seconds: int = 7200) -> int:
    """Fold the changelog into one row per live key (T5 + TTL) and publish it.

    compacted(B) = current(compacted(previous) + batches <= B) at `as_of`, where B
    is the position of the newest commit; a failed run is simply run again.
    Rows past the TTL are dropped here; later reads use `read_metrics`.
    Returns B.
    """
    log = dirs.manifest("metrics")
    rows = log.commits(spark)
    last = max((r for r in rows if r.kind == "batch"), key=lambda r: r.position)
    if MF.compacted_upto(rows) == last.position:
        return last.position
    at = MF.Attempt(last.run, last.run_no, last.batch_id)
    cur = ST.current_metrics(MF.read(spark, MF.live_paths(rows), METRICS_CHANGELOG), as_of, ttl_seconds)
    out = at.folder(dirs.metrics)
    cur.write.partitionBy("metric_date").parquet(out)
    log.publish(spark, "compaction", at, out)
    return at.position


def retire(spark: SparkSession, dirs: StreamDirs, keep_snapshots: int = 2) -> int:
    """Retention: delete the folders no reader needs, and fold the manifests. Returns the number of folders deleted.

    Gone are batches folded into a compaction, all but the newest snapshots and
    compaction, and what failed attempts left. Run it while the queries of the sink
    are stopped: an attempt that is being written is not in the manifest yet.
    """
    gone = 0
    for query, bases in (("departures", (dirs.departures, dirs.recent)), ("metrics", (dirs.metrics,))):
        log = dirs.manifest(query)
        rows = log.commits(spark)
        if not rows:
            continue
        upto = MF.compacted_upto(rows)
        # the last batch of each run stays, as a mark of how far the run has come
        last = {r.run: r.commit for r in rows if r.kind == "batch"}
        kept = [r for r in rows if (r.position >= upto if r.kind == "compaction" else r.position > upto or r.commit == last[r.run])]
        shots = [r.snapshot for r in kept if r.snapshot][-keep_snapshots:]
        named = set(MF.live_paths(kept)) | set(shots)
        kept = [Row(**{**r.asDict(), "path": r.path if r.path in named else None,
                       "snapshot": r.snapshot if r.snapshot in named else None}) for r in kept]
        log.fold(spark, kept)
        for base in bases:
            for path in MF.unnamed(spark, base, named):
                delete_path(spark, path)
                gone += 1
    return gone
