"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator group.

Every query reads the driver's tables (through the fixture mapping) over their
whole extent; the matching DuckDB SQL is in `railyard.plans.oracle`.
Timestamps are reported as `timestamp_ntz` in UTC (the oracle's naive
TIMESTAMP); the library itself works in `timestamp`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from railyard.functions import columns as C
from railyard.operators import enrich as EN
from railyard.operators import ingest as IN
from railyard.operators import metrics as M
from railyard.operators import rollup as R
from railyard.operators import store as ST
from railyard.plans import board as B
from railyard.plans import streams as SM
from railyard.sources import fixtures as FX
from railyard.sources import responses as RS
from railyard.schemas import METRICS_CHANGELOG, WINDOW_DURATION
from railyard.session import new_work_dir
from railyard.streaming import jobs as J
from railyard.streaming import manifest as MF

RECENT_MINUTES = 120
LIVE_TTL_SECONDS = 60


def report(df: DataFrame) -> DataFrame:
    """Timestamps -> UTC wall-clock `timestamp_ntz` for comparison and display."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Shared inputs
# ---------------------------------------------------------------------------

def perturbed_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat departures with the processing perturbations (FL1, FL2, C4, C7, FL8)."""
    flat = FX.flat_departures(FX.departures(spark, sf_dir))
    return FX.perturb_zero_latitude(FX.perturb_for_enrich(flat))


_TOPICS: dict[tuple, str] = {}


def fixture_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The perturbed departures as topic records, written once per session.

    Production decodes records that already sit on the topic; the registered
    queries do the same. The table is written to the shared folder, which also
    cuts the lineage from the fixture mapping. `event_id` rides along as the
    record id (the role a partition + offset plays on a broker) so scenarios
    can select deliveries by it.
    """
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _TOPICS:
        flat = perturbed_flat(spark, sf_dir)
        path = new_work_dir(spark, "fixture-topic")
        EN.encode_envelopes(flat, keep=("event_id",)).write.parquet(path)
        _TOPICS[k] = path
    return spark.read.parquet(_TOPICS[k])


def enriched_from_topic(records: DataFrame) -> DataFrame:
    return EN.enrich(EN.decode_envelopes(records.select("key", "value", "timestamp")), watermark=None)


def enriched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_from_topic(fixture_topic(spark, sf_dir))


def snapshot_rows(enriched: DataFrame, batch_id: int = 0) -> DataFrame:
    """Stored metric rows as a replay writes them: A1 (exact) -> P16 -> FL9.

    In a replay every window is written as soon as its last observation
    arrives, so `updated_at` is the window's latest collection time.
    """
    m = M.round_metrics(M.station_window_metrics(enriched, exact=True, with_last_seen=True))
    return ST.metric_rows(M.storable(m), batch_id, F.col("last_seen")).drop("last_seen")


_STORES: dict[tuple, str] = {}


def _store_folder(spark: SparkSession, sf_dir: str) -> str:
    """The metrics store as the replay leaves it, with its manifest, written once per session.

    The bounds of the event time come from the same job that writes the store, so
    no reader decodes the topic for them.
    """
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _STORES:
        base = new_work_dir(spark, "metrics-store")
        log, obs = MF.Manifest(f"{base}/manifest"), Observation(f"store-{base[-12:]}")
        at, _ = log.begin(spark, 0)
        out = at.folder(f"{base}/metrics")
        e = enriched_rows(spark, sf_dir).observe(obs, F.count(F.lit(1)).alias("rows_read"), *J.bounds("collected_at_ts", "collected_at_ts"))
        snapshot_rows(e).write.partitionBy("metric_date").parquet(out)
        log.publish(spark, "batch", at, out, counts=obs.get)
        _STORES[k] = base
    return _STORES[k]


def metrics_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store queries read what the manifest names, as live readers read the streaming sink's."""
    rows = MF.Manifest(f"{_store_folder(spark, sf_dir)}/manifest").commits(spark)
    return MF.read(spark, MF.live_paths(rows), METRICS_CHANGELOG)


def store_as_of(spark: SparkSession, sf_dir: str):
    """The latest collection time the store was made from, as a literal (FL6)."""
    rows = MF.Manifest(f"{_store_folder(spark, sf_dir)}/manifest").commits(spark)
    return F.timestamp_micros(F.lit(MF.event_time_bound(rows)).cast("long"))


def departure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.departure_records(EN.departure_view(enriched_rows(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Processing
# ---------------------------------------------------------------------------

def q_station_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A9 + P16 in batch, exact distinct counts."""
    e = enriched_rows(spark, sf_dir)
    return report(M.round_metrics(M.station_window_metrics(e, exact=True)))


# ---------------------------------------------------------------------------
# Store (T5-T12)
# ---------------------------------------------------------------------------

def q_metrics_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: batch 0 writes the even events' windows, batch 1 all windows; last write wins."""
    topic = fixture_topic(spark, sf_dir)
    b0 = snapshot_rows(enriched_from_topic(topic.filter(F.col("event_id") % 2 == 0)), 0)
    b1 = snapshot_rows(enriched_from_topic(topic), 1)
    cur = ST.current_metrics(b0.unionByName(b1), as_of=None)
    return report(cur.drop("metric_date"))


def q_station_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed stations at as_of = latest collection time."""
    return report(ST.station_index(metrics_store(spark, sf_dir), store_as_of(spark, sf_dir)))


def q_recent_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 + FL6 + TTL: every station's live windows of the last two hours."""
    return report(ST.recent_metrics(metrics_store(spark, sf_dir), store_as_of(spark, sf_dir), RECENT_MINUTES)
                  .drop("metric_date"))


def q_station_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 + O2 for every station: live windows of the last two hours, in order."""
    return report(ST.station_history(metrics_store(spark, sf_dir), None, store_as_of(spark, sf_dir), RECENT_MINUTES)
                  .drop("metric_date"))


def doubled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored departures where every tenth event was delivered twice."""
    topic = fixture_topic(spark, sf_dir)
    doubled = topic.unionByName(topic.filter(F.col("event_id") % 10 == 0))
    return ST.departure_records(EN.departure_view(enriched_from_topic(doubled)))


def q_recent_departures_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 50 stored departures per station; a member delivered twice takes one place."""
    return report(ST.recent_departures(doubled_records(spark, sf_dir)))


def q_recent_departures_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations written within the TTL (60 s here), newest 50 each."""
    return report(ST.live_departures(departure_records(spark, sf_dir), store_as_of(spark, sf_dir), LIVE_TTL_SECONDS))


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event delivered twice; identical members kept once."""
    return report(ST.exact_dedup(doubled_records(spark, sf_dir)))


def q_latest_per_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored departure per (station, dedup hash), newest poll wins."""
    return report(ST.latest_per_hash(departure_records(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Roll-up and board
# ---------------------------------------------------------------------------

def rollup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up over every stored window (no lookback, no expiry)."""
    return R.station_rollup(ST.current_metrics(metrics_store(spark, sf_dir), as_of=None))


def rollup_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up as the live board reads it: TTL + two-hour lookback at as_of."""
    return R.station_rollup(ST.recent_metrics(metrics_store(spark, sf_dir), store_as_of(spark, sf_dir), RECENT_MINUTES))


def q_station_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(rollup_all(spark, sf_dir))


def q_station_rollup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest window's whole row as text, read back."""
    roll = R.station_rollup(ST.current_metrics(metrics_store(spark, sf_dir), as_of=None), with_raw=True)
    fields = "station_name string, window_key long, total_records long, avg_delay double, on_time_pct double"
    return roll.select("station_id", F.from_json("raw_metric", fields).alias("m")).select("station_id", "m.*")


def q_station_rollup_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(rollup_recent(spark, sf_dir))


def q_network_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(B.network_kpis(rollup_all(spark, sf_dir)))


def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(B.coverage(rollup_recent(spark, sf_dir), RECENT_MINUTES))


def q_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(B.leaders(rollup_all(spark, sf_dir)))


def q_station_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(B.station_table(rollup_all(spark, sf_dir)))


def q_map_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(B.map_markers(rollup_all(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Ingest (S3, P1-P6, FL3-FL5, A20, A21)
# ---------------------------------------------------------------------------

_LANDED: dict[tuple, str] = {}


def polled_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the JSON responses of the polled (enabled) stations, with the FL3/FL4 perturbation.

    They are landed in the shared folder once per session, as a poller lands them;
    the ingest queries read the files.
    """
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _LANDED:
        obs = FX.perturb_for_validation(FX.observations(spark, sf_dir))
        path = new_work_dir(spark, "landed-responses")
        RS.write_responses(RS.responses_from_observations(obs), path)
        _LANDED[k] = path
    return IN.enabled_only(RS.read_responses(spark, _LANDED[k]), FX.stations(spark), key="requested_station_id")


def q_flatten_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(IN.flatten_departures(polled_responses(spark, sf_dir)))


def q_quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(IN.quarantine(polled_responses(spark, sf_dir)))


def q_enabled_station_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL5 over all twelve stations' observations (two are not polled)."""
    flat = FX.flat_departures(FX.observations(spark, sf_dir))
    return report(IN.enabled_only(flat, FX.stations(spark)))


def q_ingest_cycle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(IN.ingest_cycle_summary(polled_responses(spark, sf_dir), FX.stations(spark)))


def q_ingest_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(IN.ingest_quality(polled_responses(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Envelope, enrich and metric variants
# ---------------------------------------------------------------------------

def q_envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + P8: decode(encode(x)) over the clean departures, nulls included."""
    flat = FX.flat_departures(FX.departures(spark, sf_dir))
    return EN.decode_envelopes(EN.encode_envelopes(flat)).drop("kafka_timestamp")


def q_enriched_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8-P13 + FL1/FL2 over the perturbed envelopes (P10 clock left out)."""
    return report(enriched_rows(spark, sf_dir).drop("kafka_timestamp"))


def q_dedup_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 for every stored departure."""
    rec = departure_records(spark, sf_dir)
    return report(rec.select("trip_id", "station_id", "planned_departure", "direction", "line_id",
                             "platform", "collected_at", "dedup_hash"))


def q_station_window_metrics_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 / A7 as the stream computes them: HLL++ at rsd 0.01."""
    e = enriched_rows(spark, sf_dir)
    return report(M.round_metrics(M.station_window_metrics(e, exact=False)))


def q_sliding_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute windows sliding by 1 minute (the configured, unused setting)."""
    e = enriched_rows(spark, sf_dir)
    return report(M.round_metrics(M.station_window_metrics(e, "5 minutes", "1 minute", exact=True)))


def q_mode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(M.mode_metrics(enriched_rows(spark, sf_dir)))


def q_delay_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(M.delay_distribution(enriched_rows(spark, sf_dir)))


def q_delay_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(M.delay_percentiles(enriched_rows(spark, sf_dir)))


_SKETCHES: dict[tuple, str] = {}


def delay_sketch_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delay sketches of all windows, written once per session beside the metrics store."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _SKETCHES:
        path = new_work_dir(spark, "delay-sketches")
        M.delay_sketches(enriched_rows(spark, sf_dir)).write.partitionBy("metric_date").parquet(path)
        _SKETCHES[k] = path
    return spark.read.parquet(_SKETCHES[k])


#: Allowed rank error of a merged sketch: about three times what its size promises.
RANK_ERROR = 0.02


def q_delay_percentiles_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A24 from stored sketches, over everything (minutes_back 0) and the last two hours.

    The sketch is random, so the estimates themselves are not compared: each is checked
    against the exact ranks of the raw rows, the number of delays is exact.
    """
    store, as_of, e = delay_sketch_store(spark, sf_dir), store_as_of(spark, sf_dir), enriched_rows(spark, sf_dir)
    out = None
    for minutes_back in (0, RECENT_MINUTES):
        back = minutes_back or None
        rows = ST.lookback(e.withColumn("window_start", F.window("collected_at_ts", WINDOW_DURATION).start), as_of, back)
        got = M.rank_bounds(rows, M.merged_percentiles(ST.lookback(store, as_of, back)))
        within = (F.col("share_below") <= F.col("quantile") + RANK_ERROR) & (F.col("share_upto") >= F.col("quantile") - RANK_ERROR)
        got = got.select(F.lit(minutes_back).alias("minutes_back"), "station_id", "quantile", "records", within.alias("within_bound"))
        out = got if out is None else out.unionByName(got)
    return out


def q_metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store key, ISO text of the window bounds and update time, parsed back."""
    snap = snapshot_rows(enriched_rows(spark, sf_dir))
    text = snap.select("station_id", "window_key",
                       C.iso_text("window_start").alias("window_start_text"),
                       C.iso_text("window_end").alias("window_end_text"),
                       C.iso_text("updated_at").alias("updated_at_text"))
    return report(text.withColumn("window_start_parsed", C.parse_ts("window_start_text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flatten_departures": q_flatten_departures,
    "quarantine_reasons": q_quarantine_reasons,
    "enabled_station_filter": q_enabled_station_filter,
    "ingest_cycle_summary": q_ingest_cycle_summary,
    "ingest_quality": q_ingest_quality,
    "envelope_roundtrip": q_envelope_roundtrip,
    "enriched_departures": q_enriched_departures,
    "dedup_hash": q_dedup_hash,
    "station_window_metrics_approx": q_station_window_metrics_approx,
    "sliding_window_metrics": q_sliding_window_metrics,
    "mode_metrics": q_mode_metrics,
    "delay_distribution": q_delay_distribution,
    "delay_percentiles": q_delay_percentiles,
    "delay_percentiles_merged": q_delay_percentiles_merged,
    "metrics_json": q_metrics_json,
    "stream_station_metrics": lambda spark, sf: report(SM.stream_station_metrics(spark, sf)),
    "stream_station_metrics_approx": lambda spark, sf: report(SM.stream_station_metrics_approx(spark, sf)),
    "stream_departures": lambda spark, sf: report(SM.stream_departures(spark, sf)),
    "stream_late_data": lambda spark, sf: report(SM.stream_late_data(spark, sf)),
    "stream_exact_dedup": lambda spark, sf: report(SM.stream_exact_dedup(spark, sf)),
    "stream_recent_departures": lambda spark, sf: report(SM.stream_recent_departures(spark, sf)),
    "stream_live_departures": lambda spark, sf: report(SM.stream_live_departures(spark, sf)),
    "batch_audit": lambda spark, sf: SM.batch_audit(spark, sf),
    "audit_totals": lambda spark, sf: report(SM.audit_totals(spark, sf)),
    "replay_metrics": lambda spark, sf: report(SM.replay_metrics(spark, sf)),
    "export_board": lambda spark, sf: SM.export_board(spark, sf),
    "station_window_metrics": q_station_window_metrics,
    "metrics_upsert_latest": q_metrics_upsert_latest,
    "station_index": q_station_index,
    "recent_metrics": q_recent_metrics,
    "station_history": q_station_history,
    "recent_departures_top50": q_recent_departures_top50,
    "recent_departures_live": q_recent_departures_live,
    "exact_dedup": q_exact_dedup,
    "latest_per_hash": q_latest_per_hash,
    "station_rollup": q_station_rollup,
    "station_rollup_raw": q_station_rollup_raw,
    "station_rollup_recent": q_station_rollup_recent,
    "network_kpis": q_network_kpis,
    "coverage": q_coverage,
    "leaders": q_leaders,
    "station_table": q_station_table,
    "map_markers": q_map_markers,
}
