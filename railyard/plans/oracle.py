"""DuckDB oracle SQL for the registered queries.

Each string runs in DuckDB over the driver's pre-registered tables. The
departures view is rebuilt here from `events` with the same fixed mapping
(FIXTURES.md section B) and, where a query needs one, the same perturbation
rule (section B.2). Timestamps are computed from microsecond integers rather
than parsed from text, so the oracle does not share code paths with Spark.
Timestamps are naive UTC (DuckDB TIMESTAMP); the Spark side reports
`timestamp_ntz` to match.
"""

from __future__ import annotations

# The fixture mapping (FIXTURES.md section B), as DuckDB SQL.
_OBS = """
ev AS (
  SELECT event_id, user_id, event_type, value, props,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 30 AS cu,
         cast(json_extract_string(props, '$.k') AS int) AS k,
         cast(user_id % 12 AS int) AS si
  FROM events),
ev2 AS (
  SELECT *, ((cu // 60000000) + (k % 5)) * 60000000 AS pu,
         CASE WHEN k % 20 = 0 THEN cast(NULL AS int) ELSE cast(floor(value * 6) AS int) - 60 END AS delay_s
  FROM ev),
obs AS (
  SELECT event_id, cu, pu, k, si,
         concat('trip-', user_id // 12, '-', cu // 3600000000) AS trip_id,
         concat('9000', lpad(cast(si AS varchar), 5, '0')) AS station_id,
         concat('Station ', si) AS station_name,
         si < 10 AS enabled,
         event_type AS line_id,
         upper(event_type) AS line_name,
         CASE event_type WHEN 'click' THEN 'suburban' WHEN 'view' THEN 'Subway'
              WHEN 'purchase' THEN 'BUS' WHEN 'signup' THEN 'tram' ELSE 'zeppelin' END AS product,
         concat('Dir ', k % 3) AS direction,
         strftime(make_timestamp(pu), '%Y-%m-%dT%H:%M:%S+00:00') AS planned_when,
         CASE WHEN k % 25 = 0 THEN NULL
              ELSE strftime(make_timestamp(pu + coalesce(delay_s, 0)::bigint * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') END AS actual_when,
         delay_s AS delay,
         coalesce(delay_s, 0) / 60::double AS delay_minutes,
         CASE WHEN k % 4 = 0 THEN NULL ELSE cast(k % 4 AS varchar) END AS platform,
         cast(1 + k % 4 AS varchar) AS planned_platform,
         k % 25 = 0 AS cancelled,
         52.5::double + si / 100::double AS latitude,
         13.4::double + si / 100::double AS longitude,
         strftime(make_timestamp(cu), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS collected_at,
         make_timestamp(cu) AS collected_at_ts,
         make_timestamp(pu) AS planned_ts,
         make_timestamp(pu + coalesce(delay_s, 0)::bigint * 1000000) AS actual_ts
  FROM ev2),
d AS (SELECT * FROM obs WHERE enabled),
f AS (
  SELECT *,
         CASE WHEN lower(product) IN ('suburban','subway','regional','express','tram','bus','ferry')
              THEN lower(product) ELSE 'not defined' END AS transport_mode,
         planned_when AS planned_departure,
         coalesce(actual_when, planned_when) AS actual_departure
  FROM d)"""

# Perturbed, enriched rows: FL1 (line_id null), FL2 (collected_at garbage),
# C4 (delay null), C7 (name null), FL8 (latitude 0 for station 9); then the
# not-null filters.
_ENRICHED = """,
fp AS (
  SELECT * REPLACE (
           CASE WHEN station_id = '900000009' THEN 0::double ELSE latitude END AS latitude,
           CASE WHEN event_id % 40 = 0 THEN NULL ELSE line_id END AS line_id,
           CASE WHEN event_id % 60 = 0 THEN 'garbage' ELSE collected_at END AS collected_at,
           CASE WHEN event_id % 30 = 0 THEN NULL ELSE delay_minutes END AS delay_minutes,
           CASE WHEN event_id % 45 = 0 THEN NULL ELSE station_name END AS station_name,
           CASE WHEN event_id % 60 = 0 THEN NULL ELSE collected_at_ts END AS collected_at_ts)
  FROM f),
e AS (
  SELECT *,
         planned_ts AS planned_departure_ts,
         CASE WHEN actual_when IS NULL THEN planned_ts ELSE actual_ts END AS actual_departure_ts,
         CASE WHEN delay_minutes > 2 THEN 1 ELSE 0 END AS is_delayed,
         CASE WHEN delay_minutes <= 2 THEN 1 ELSE 0 END AS is_on_time,
         CASE WHEN delay_minutes > 5 THEN 1 ELSE 0 END AS is_significant_delay
  FROM fp
  WHERE station_id IS NOT NULL AND trip_id IS NOT NULL AND line_id IS NOT NULL
    AND collected_at_ts IS NOT NULL)"""

def _r(x: str, dp: int) -> str:
    """Decimal-canonical rounding, as on the Spark side."""
    return f"cast(round(cast({x} AS decimal(20,6)), {dp}) AS double)"


def _window_metrics(src: str = "e", extra_where: str = "", sfx: str = "") -> str:
    """A1-A9 + P16 over enriched rows `src` (exact distinct) -> `m{sfx}`."""
    return f""",
wm{sfx} AS (
  SELECT station_id, station_name,
         time_bucket(INTERVAL '15 minutes', collected_at_ts) AS window_start,
         time_bucket(INTERVAL '15 minutes', collected_at_ts) + INTERVAL '15 minutes' AS window_end,
         avg(delay_minutes) AS avg_delay_raw, max(delay_minutes) AS max_delay_raw,
         count(DISTINCT trip_id) AS total_departures,
         cast(sum(is_delayed) AS bigint) AS delayed_departures,
         cast(sum(is_on_time) AS bigint) AS on_time_departures,
         cast(sum(is_significant_delay) AS bigint) AS significant_delays,
         count(*) AS total_records,
         count(DISTINCT line_id) AS unique_lines,
         latitude, longitude, max(collected_at_ts) AS last_seen
  FROM {src} {extra_where}
  GROUP BY ALL),
m{sfx} AS (
  SELECT station_id, station_name, window_start, window_end,
         {_r('avg_delay_raw', 2)} AS avg_delay, {_r('max_delay_raw', 2)} AS max_delay,
         total_departures, delayed_departures, on_time_departures, significant_delays,
         total_records, unique_lines,
         {_r('on_time_departures::double / total_departures::double * 100', 1)} AS on_time_pct,
         {_r('delayed_departures::double / total_departures::double * 100', 1)} AS delay_pct,
         latitude, longitude, last_seen
  FROM wm{sfx})"""


METRIC_COLS = ("station_id, station_name, window_start, window_end, avg_delay, max_delay, "
               "total_departures, delayed_departures, on_time_departures, significant_delays, "
               "total_records, unique_lines, on_time_pct, delay_pct, latitude, longitude")


# Stored metric rows of one replay batch (FL9 applied), `snap`.
def _snap(batch_id: int = 0, src: str = "m", name: str = "snap") -> str:
    return f""",
{name} AS (
  SELECT {METRIC_COLS}, epoch(window_start)::bigint AS window_key, {batch_id}::bigint AS batch_id,
         last_seen AS updated_at
  FROM {src}
  WHERE station_name IS NOT NULL AND avg_delay IS NOT NULL AND max_delay IS NOT NULL)"""


_AS_OF = "(SELECT max(collected_at_ts) FROM e)"


def _recent(minutes_back: int, ttl: int = 7200) -> str:
    """TTL from last update, index alive, lookback on window start."""
    return f""",
cur AS (
  SELECT * FROM snap
  WHERE updated_at > {_AS_OF} - INTERVAL '{ttl} seconds'
    AND window_start >= {_AS_OF} - INTERVAL '{minutes_back} minutes'
    AND (SELECT max(updated_at) FROM snap) > {_AS_OF} - INTERVAL '{ttl} seconds')"""


def _rollup(src: str) -> str:
    """A10-A15 over stored windows `src` -> `r`."""
    r = _r
    return f""",
rg AS (
  SELECT station_id,
         arg_max({{'n': station_name, 'lat': latitude, 'lon': longitude, 'u': updated_at}}, window_start) AS latest,
         count(*) FILTER (WHERE avg_delay IS NOT NULL) AS windows_count,
         cast(sum(total_departures) FILTER (WHERE avg_delay IS NOT NULL) AS bigint) AS total_departures,
         cast(sum(delayed_departures) FILTER (WHERE avg_delay IS NOT NULL) AS bigint) AS delayed_departures,
         cast(sum(on_time_departures) FILTER (WHERE avg_delay IS NOT NULL) AS bigint) AS on_time_departures,
         cast(sum(significant_delays) FILTER (WHERE avg_delay IS NOT NULL) AS bigint) AS significant_delays,
         sum(avg_delay * total_departures) FILTER (WHERE avg_delay IS NOT NULL AND total_departures > 0) AS weighted_delay,
         max(max_delay) FILTER (WHERE avg_delay IS NOT NULL) AS max_delay,
         min(window_start) FILTER (WHERE avg_delay IS NOT NULL) AS window_start,
         max(window_start) FILTER (WHERE avg_delay IS NOT NULL) AS window_end,
         max(window_end) FILTER (WHERE avg_delay IS NOT NULL) AS last_window_end
  FROM {src} GROUP BY station_id),
rc AS (
  SELECT *, least(on_time_departures, total_departures) AS on_c,
         least(delayed_departures, total_departures) AS dl_c
  FROM rg
  WHERE windows_count > 0 AND latest.lat IS NOT NULL AND latest.lon IS NOT NULL
    AND latest.lat <> 0 AND latest.lon <> 0),
rs AS (
  SELECT *, CASE WHEN on_c + dl_c > total_departures
                 THEN total_departures::double / (on_c + dl_c) ELSE 1.0::double END AS scale
  FROM rc),
r AS (
  SELECT station_id, latest.n AS station_name, latest.lat AS lat, latest.lon AS lon,
         {r('CASE WHEN total_departures > 0 THEN weighted_delay / total_departures ELSE 0.0 END', 1)} AS avg_delay,
         {r('max_delay', 1)} AS max_delay,
         total_departures, delayed_departures, on_time_departures, significant_delays,
         {r('CASE WHEN total_departures > 0 THEN on_c * scale / total_departures * 100.0 ELSE 100.0 END', 1)} AS on_time_pct,
         {r('CASE WHEN total_departures > 0 THEN dl_c * scale / total_departures * 100.0 ELSE 0.0 END', 1)} AS delay_pct,
         window_start, window_end, last_window_end, windows_count, latest.u AS updated_at
  FROM rs)"""


ROLLUP_COLS = ("station_id, station_name, lat, lon, avg_delay, max_delay, total_departures, "
               "delayed_departures, on_time_departures, significant_delays, on_time_pct, delay_pct, "
               "window_start, window_end, last_window_end, windows_count, updated_at")

_PROC = "WITH" + _OBS + _ENRICHED
_ROLL_ALL = _PROC + _window_metrics() + _snap() + _rollup("snap")
_ROLL_RECENT = _PROC + _window_metrics() + _snap() + _recent(120) + _rollup("cur")


def _records(src: str = "e") -> str:
    """F6 stored departures from enriched rows `src` -> `rec`."""
    return f""",
rec AS (
  SELECT trip_id, station_id, station_name, line_id, line_name, transport_mode, direction,
         planned_departure, actual_departure, delay_minutes, platform, planned_platform,
         collected_at, longitude, latitude, collected_at_ts,
         substr(md5(concat_ws(':', coalesce(station_id, 'None'), coalesce(planned_departure, 'None'),
                coalesce(direction, 'None'), coalesce(line_id, 'None'), coalesce(platform, 'None'))), 1, 8) AS dedup_hash,
         epoch_us(collected_at_ts)::double / 1e6 AS score
  FROM {src})"""


_NEWEST = ("collected_at_ts DESC, dedup_hash DESC, trip_id DESC, line_id DESC NULLS LAST, "
           "direction DESC NULLS LAST, planned_departure DESC NULLS LAST, platform DESC NULLS LAST")
REC_COLS = ("trip_id, station_id, station_name, line_id, line_name, transport_mode, direction, "
            "planned_departure, actual_departure, delay_minutes, platform, planned_platform, "
            "collected_at, longitude, latitude, collected_at_ts, dedup_hash, score")


# Validation perturbation (FL3/FL4) over polled stations -> `ov` with reason.
_VALIDATED = """,
op AS (
  SELECT * REPLACE (
           CASE WHEN event_id % 50 = 0 THEN 95::double ELSE latitude END AS latitude,
           CASE WHEN event_id % 70 = 0 THEN NULL ELSE direction END AS direction,
           CASE WHEN event_id % 190 = 0 THEN cast(event_id AS varchar) ELSE trip_id END AS trip_id)
  FROM obs WHERE enabled),
ov AS (
  SELECT *,
         CASE WHEN trip_id IS NULL THEN 'tripId: missing'
              WHEN event_id % 190 = 0 THEN 'tripId: not text'
              WHEN station_id IS NULL THEN 'stop.id: missing'
              WHEN station_name IS NULL THEN 'stop.name: missing'
              WHEN event_id % 170 = 0 THEN 'stop.products: missing'
              WHEN event_id % 230 = 0 THEN 'stop.products: not a flag'
              WHEN latitude IS NULL THEN 'latitude: missing'
              WHEN longitude IS NULL THEN 'longitude: missing'
              WHEN event_id % 90 = 0 OR event_id % 110 = 0 THEN 'delay: not a whole number'
              WHEN event_id % 130 = 0 OR event_id % 210 = 0 THEN 'cancelled: not a flag'
              WHEN direction IS NULL THEN 'direction: missing'
              WHEN line_id IS NULL THEN 'line.id: missing'
              WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude: out of range'
              WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude: out of range' END AS reason
  FROM op)"""

_TRANSPORT = ("CASE WHEN lower(product) IN ('suburban','subway','regional','express','tram','bus','ferry') "
              "THEN lower(product) ELSE 'not defined' END")

F2_COLS = ("trip_id, station_id, station_name, line_id, line_name, transport_mode, direction, "
           "planned_departure, actual_departure, delay_minutes, platform, planned_platform, "
           "collected_at, longitude, latitude")


def _other_sql() -> dict[str, str]:
    val = "WITH" + _OBS + _VALIDATED
    return {
        "flatten_departures": val + f"""
SELECT trip_id, station_id, station_name, line_id, line_name, {_TRANSPORT} AS transport_mode,
       direction, planned_ts AS planned_departure,
       CASE WHEN actual_when IS NULL THEN planned_ts ELSE actual_ts END AS actual_departure,
       delay_minutes, platform, planned_platform, cancelled, collected_at_ts AS collected_at,
       longitude, latitude
FROM ov WHERE reason IS NULL""",
        "quarantine_reasons": val + """
SELECT station_id AS requested_station_id, collected_at_ts AS fetched_at, trip_id, reason
FROM ov WHERE reason IS NOT NULL""",
        "enabled_station_filter": "WITH" + _OBS + f""",
fa AS (SELECT *, {_TRANSPORT} AS transport_mode, planned_when AS planned_departure,
              coalesce(actual_when, planned_when) AS actual_departure FROM obs WHERE enabled)
SELECT event_id, trip_id, station_id, station_name, line_id, line_name, transport_mode, direction,
       planned_departure, actual_departure, delay_minutes, platform, planned_platform, cancelled,
       collected_at, longitude, latitude
FROM fa""",
        "ingest_quality": val + """
SELECT station_id AS requested_station_id, collected_at_ts AS fetched_at,
       count(*)::int AS records_found, (count(*) FILTER (WHERE reason IS NULL))::int AS records_parsed
FROM ov GROUP BY station_id, collected_at_ts""",
        "ingest_cycle_summary": val + """,
resp AS (
  SELECT station_id, collected_at_ts AS fetched_at, count(*) FILTER (WHERE reason IS NULL) AS parsed
  FROM ov GROUP BY station_id, collected_at_ts)
SELECT cycle_start,
       10::bigint AS stations_polled,
       count(DISTINCT CASE WHEN parsed > 0 THEN station_id END) AS stations_ok,
       10::bigint - count(DISTINCT CASE WHEN parsed > 0 THEN station_id END) AS stations_failed,
       count(fetched_at) AS responses,
       cast(coalesce(sum(parsed), 0) AS bigint) AS departures,
       (epoch_us(max(fetched_at)) - epoch_us(min(fetched_at))) / 1e6 AS duration_sec
FROM (SELECT unnest(generate_series(min(date_trunc('minute', fetched_at)), max(date_trunc('minute', fetched_at)),
                                    INTERVAL '1 minute')) AS cycle_start FROM resp) s
LEFT JOIN resp ON date_trunc('minute', fetched_at) = cycle_start GROUP BY cycle_start""",
        "envelope_roundtrip": "WITH" + _OBS + f"""
SELECT station_id AS kafka_key, 'departure_update' AS event_type, {ENV_COLS} FROM f""",
        "enriched_departures": _PROC + f"""
SELECT station_id AS kafka_key, 'departure_update' AS event_type, {ENV_COLS},
       planned_departure_ts, actual_departure_ts, collected_at_ts,
       is_delayed, is_on_time, is_significant_delay
FROM e""",
        "dedup_hash": _PROC + _records() + """
SELECT trip_id, station_id, planned_departure, direction, line_id, platform, collected_at, dedup_hash
FROM rec""",
        "sliding_window_metrics": _PROC + """,
es AS (
  SELECT e.*, time_bucket(INTERVAL '1 minute', collected_at_ts) - to_minutes(s.i) AS ws
  FROM e, (SELECT unnest(range(0, 5)) AS i) s)""" + _window_metrics("es").replace(
            "time_bucket(INTERVAL '15 minutes', collected_at_ts) + INTERVAL '15 minutes'", "ws + INTERVAL '5 minutes'"
        ).replace("time_bucket(INTERVAL '15 minutes', collected_at_ts)", "ws") + f"\nSELECT {METRIC_COLS} FROM m",
        "mode_metrics": _PROC + f"""
SELECT time_bucket(INTERVAL '15 minutes', collected_at_ts) AS window_start,
       time_bucket(INTERVAL '15 minutes', collected_at_ts) + INTERVAL '15 minutes' AS window_end,
       transport_mode, count(DISTINCT trip_id) AS total_departures, count(*) AS total_records,
       cast(sum(is_delayed) AS bigint) AS delayed_departures,
       cast(sum(is_on_time) AS bigint) AS on_time_departures,
       {_r('avg(delay_minutes)', 2)} AS avg_delay
FROM e GROUP BY ALL""",
        "delay_distribution": _PROC + f"""
SELECT station_id,
       CASE WHEN delay_minutes <= 0 THEN 'On Time' WHEN delay_minutes <= 2 THEN 'Minor Delay'
            WHEN delay_minutes <= 5 THEN 'Moderate Delay' WHEN delay_minutes <= 10 THEN 'Major Delay'
            WHEN delay_minutes IS NOT NULL THEN 'Severe Delay' ELSE 'Unknown' END AS delay_category,
       count(*) AS records, {_r('avg(delay_minutes)', 2)} AS avg_delay
FROM e GROUP BY ALL""",
        "delay_percentiles_merged": _PROC + f"""
SELECT mb AS minutes_back, station_id, q AS quantile, count(*) AS records, TRUE AS within_bound
FROM e, (VALUES (0.5::double), (0.9::double), (0.99::double)) t(q), (VALUES (0), (120)) b(mb)
WHERE delay_minutes IS NOT NULL
  AND (mb = 0 OR time_bucket(INTERVAL '15 minutes', collected_at_ts) >= {_AS_OF} - INTERVAL '120 minutes')
GROUP BY ALL""",
        "metrics_json": _PROC + _window_metrics() + _snap() + """
SELECT station_id, window_key,
       strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS window_start_text,
       strftime(window_end, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS window_end_text,
       strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS updated_at_text,
       window_start AS window_start_parsed
FROM snap""",
    }


ENV_COLS = ("trip_id, station_id, station_name, line_id, line_name, transport_mode, direction, "
            "planned_departure, actual_departure, delay_minutes, longitude, latitude, platform, "
            "planned_platform, collected_at")


# Brute-force percentile (value at rank ceil(q * n) of the non-null delays):
# equal to percentile_approx only while its sketch keeps every value, so it is
# a small-fixture test, not a registered oracle.
PERCENTILE_BRUTE_FORCE = _PROC + """,
pr AS (
  SELECT station_id, delay_minutes,
         row_number() OVER (PARTITION BY station_id ORDER BY delay_minutes) AS rn,
         count(*) OVER (PARTITION BY station_id) AS n
  FROM e WHERE delay_minutes IS NOT NULL)
SELECT station_id,
       min(delay_minutes) FILTER (WHERE rn >= ceil(0.5::double * n)) AS p50,
       min(delay_minutes) FILTER (WHERE rn >= ceil(0.9::double * n)) AS p90,
       min(delay_minutes) FILTER (WHERE rn >= ceil(0.99::double * n)) AS p99
FROM pr GROUP BY station_id"""


EXACT_COLS = ("station_id, station_name, window_start, window_end, avg_delay, max_delay, "
              "delayed_departures, on_time_departures, significant_delays, total_records, "
              "latitude, longitude")


def _stream_sql() -> dict[str, str]:
    stored = "WHERE station_name IS NOT NULL AND avg_delay IS NOT NULL AND max_delay IS NOT NULL"
    late = ("WHERE NOT (collected_at_ts < TIMESTAMP '2024-01-01 12:00:00' AND event_id % 25 = 0)")
    return {
        "stream_station_metrics": _PROC + _window_metrics() + f"\nSELECT {EXACT_COLS} FROM m {stored}",
        "stream_late_data": _PROC + _window_metrics(extra_where=late) + f"\nSELECT {EXACT_COLS} FROM m {stored}",
        "stream_departures": _PROC + _records() + f"\nSELECT {REC_COLS} FROM rec",
        "audit_totals": _PROC + """
SELECT 'departures' AS query, count(*) AS rows_read, 0::bigint AS rows_malformed,
       count(*) - (SELECT count(*) FROM e) AS rows_rejected, (SELECT count(*) FROM e) AS rows_stored,
       (SELECT min(collected_at_ts) FROM e) AS min_event_time, (SELECT max(collected_at_ts) FROM e) AS max_event_time
FROM fp""",
        "replay_metrics": _PROC + _window_metrics() + f"\nSELECT {METRIC_COLS} FROM m",
    }


def all_sql() -> dict[str, str]:
    sql = {**_other_sql(), **_store_board_sql(), **_stream_sql()}
    sql["export_board"] = sql["station_table"]
    sql["stream_exact_dedup"] = sql["exact_dedup"]
    sql["stream_recent_departures"] = sql["recent_departures_top50"]
    sql["stream_live_departures"] = sql["recent_departures_live"]
    return sql


def _store_board_sql() -> dict[str, str]:
    top50 = (f"SELECT {REC_COLS}, cast(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY station_id "
             f"ORDER BY {_NEWEST}) AS rank FROM (SELECT DISTINCT {REC_COLS} FROM {{src}})) WHERE rank <= 50")
    leaders = " UNION ALL ".join(
        f"(SELECT '{role}' AS role, station_id, station_name, avg_delay, on_time_pct, total_departures "
        f"FROM r ORDER BY {order}, station_id LIMIT 1)"
        for role, order in (("best", "avg_delay ASC"), ("worst", "avg_delay DESC"),
                            ("busiest", "total_departures DESC")))
    doubled = _OBS.replace("d AS (SELECT * FROM obs WHERE enabled)",
                           "d AS (SELECT * FROM obs WHERE enabled UNION ALL "
                           "SELECT * FROM obs WHERE enabled AND event_id % 10 = 0)")
    return {
        "station_window_metrics": _PROC + _window_metrics() + f"\nSELECT {METRIC_COLS} FROM m",
        "metrics_upsert_latest": (
            _PROC + _window_metrics(extra_where="WHERE event_id % 2 = 0", sfx="0") + _snap(0, "m0", "s0")
            + _window_metrics(sfx="1") + _snap(1, "m1", "s1") + f"""
SELECT {METRIC_COLS}, window_key, batch_id, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, window_start
            ORDER BY batch_id DESC, total_records DESC, station_name DESC NULLS LAST) AS rn
  FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1)) WHERE rn = 1"""),
        "station_index": _PROC + _window_metrics() + _snap() + f"""
SELECT DISTINCT station_id FROM snap
WHERE (SELECT max(updated_at) FROM snap) > {_AS_OF} - INTERVAL '7200 seconds'""",
        "recent_metrics": _PROC + _window_metrics() + _snap() + _recent(120)
        + f"\nSELECT {METRIC_COLS}, window_key, batch_id, updated_at FROM cur",
        "station_history": _PROC + _window_metrics() + _snap() + _recent(120).replace(
            "\n    AND (SELECT max(updated_at) FROM snap) > " + _AS_OF + " - INTERVAL '7200 seconds'", "")
        + f"\nSELECT {METRIC_COLS}, window_key, batch_id, updated_at FROM cur ORDER BY station_id, window_start",
        "recent_departures_top50": _PROC + _records() + "\n" + top50.format(src="rec"),
        "recent_departures_live": _PROC + _records() + """,
writes AS (
  SELECT station_id, collected_at_ts,
         coalesce(lead(collected_at_ts) OVER (PARTITION BY station_id ORDER BY collected_at_ts),
                  (SELECT max(collected_at_ts) FROM rec)) AS next_write
  FROM (SELECT DISTINCT station_id, collected_at_ts FROM rec)),
ended AS (
  SELECT station_id, max(collected_at_ts) AS ended_at FROM writes
  WHERE next_write - collected_at_ts >= INTERVAL '60 seconds' GROUP BY station_id),
live AS (
  SELECT rec.* FROM rec LEFT JOIN ended USING (station_id) WHERE ended_at IS NULL OR collected_at_ts > ended_at)
""" + top50.format(src="live"),
        "exact_dedup": "WITH" + doubled + _ENRICHED + _records() + f"\nSELECT DISTINCT {REC_COLS} FROM rec",
        "latest_per_hash": _PROC + _records() + f"""
SELECT {REC_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY station_id, planned_departure, direction, line_id, platform
  ORDER BY {_NEWEST}) AS rn FROM rec) WHERE rn = 1""",
        "station_rollup": _ROLL_ALL + f"\nSELECT {ROLLUP_COLS} FROM r",
        "station_rollup_raw": _ROLL_ALL + """
SELECT r.station_id, snap.station_name, snap.window_key, snap.total_records, snap.avg_delay, snap.on_time_pct
FROM r JOIN snap ON snap.station_id = r.station_id
JOIN (SELECT station_id, max(window_start) AS newest FROM snap GROUP BY station_id) n
  ON n.station_id = snap.station_id AND n.newest = snap.window_start""",
        "station_rollup_recent": _ROLL_RECENT + f"\nSELECT {ROLLUP_COLS} FROM r",
        "network_kpis": _ROLL_ALL + f"""
SELECT count(*) AS active_stations, {_r('avg(avg_delay)', 2)} AS avg_delay,
       CASE WHEN avg(avg_delay) < 2 THEN 'green' WHEN avg(avg_delay) < 5 THEN 'yellow' ELSE 'red' END AS delay_status,
       cast(sum(total_departures) AS bigint) AS total_departures
FROM r HAVING count(*) > 0""",
        "coverage": _ROLL_RECENT + f"""
SELECT 120 AS minutes_back, 8 AS expected_windows, count(*) AS stations,
       {_r('avg(windows_count)', 1)} AS avg_windows, min(windows_count) AS min_windows,
       max(windows_count) AS max_windows, cast(sum(total_departures) AS bigint) AS total_departures
FROM r HAVING count(*) > 0""",
        "leaders": _ROLL_ALL + "\n" + leaders,
        "station_table": _ROLL_ALL + f"""
SELECT CASE WHEN a < 2 THEN 'green' WHEN a < 5 THEN 'yellow' ELSE 'red' END AS status,
       station_name AS station, a AS avg_delay_min, {_r('max_delay', 1)} AS max_delay_min,
       CASE WHEN o > 80 THEN 'green' WHEN o > 60 THEN 'yellow' ELSE 'red' END AS performance,
       o AS on_time_pct, total_departures, delayed_departures, station_id
FROM (SELECT *, {_r('avg_delay', 1)} AS a, {_r('on_time_pct', 1)} AS o FROM r)""",
        "map_markers": _ROLL_ALL + """
SELECT station_id, station_name, lat, lon, avg_delay,
       CASE WHEN avg_delay <= 0 THEN 'On Time' WHEN avg_delay <= 2 THEN 'Minor Delay'
            WHEN avg_delay <= 5 THEN 'Moderate Delay' WHEN avg_delay <= 10 THEN 'Major Delay'
            WHEN avg_delay IS NOT NULL THEN 'Severe Delay' END AS delay_category,
       max_delay, total_departures, delayed_departures, on_time_pct, delay_pct, windows_count
FROM r""",
    }
