"""Declared schemas (F1-F8). One module, so reader, writer and checks agree."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    ArrayType,
    BinaryType,
    VariantType,
)

# Transport modes of the source API, and the label for anything else.
TRANSPORT_MODES = ["suburban", "subway", "regional", "express", "tram", "bus", "ferry"]
MODE_NOT_DEFINED = "not defined"

# Live settings of the processing job.
WINDOW_DURATION = "15 minutes"
WATERMARK_DELAY = "10 minutes"
EVENT_TYPE = "departure_update"
METRICS_TTL_SECONDS = 7200
DEPARTURES_TTL_SECONDS = 3600
RECENT_DEPARTURES_PER_STATION = 50
APPROX_RSD = 0.01

# The ten polled station ids (config order).
ENABLED_STATIONS = [
    "900100003", "900100001", "900003201", "900120003", "900023201",
    "900017101", "900024101", "900013102", "900110001", "900230999",
]


def _s(name, dtype=StringType(), nullable=True):
    return StructField(name, dtype, nullable)


# F1 raw_response: one API response per (station, poll). A departure is read as a VARIANT, so
# that validation (FL3) can tell a missing value, an explicit null and one of another type apart.
RAW_RESPONSE = StructType([
    _s("requested_station_id"), _s("fetched_at", TimestampType()),
    _s("departures", ArrayType(VariantType())),
])
# The product flags of a stop.
PRODUCT_FLAGS = ["suburban", "subway", "tram", "bus", "ferry", "express", "regional"]

# F3 envelope data: the 15 fields on the topic (no `cancelled`).
ENVELOPE_DATA_FIELDS = [
    "trip_id", "station_id", "station_name", "line_id", "line_name", "transport_mode",
    "direction", "planned_departure", "actual_departure", "delay_minutes", "longitude",
    "latitude", "platform", "planned_platform", "collected_at",
]
_DOUBLE_FIELDS = {"delay_minutes", "longitude", "latitude"}
ENVELOPE_DATA = StructType([
    _s(f, DoubleType() if f in _DOUBLE_FIELDS else StringType()) for f in ENVELOPE_DATA_FIELDS
])
ENVELOPE = StructType([_s("event_type"), _s("timestamp"), _s("data", ENVELOPE_DATA)])

# Topic record shape (what a Kafka source yields, and the file stand-in mirrors).
TOPIC_RECORD = StructType([
    _s("key", BinaryType()), _s("value", BinaryType()), _s("timestamp", TimestampType()),
])

# Departures sink columns (P14), in output order.
DEPARTURE_VIEW_COLUMNS = [
    "trip_id", "station_id", "station_name", "line_id", "line_name", "transport_mode",
    "direction", "planned_departure", "actual_departure", "delay_minutes", "platform",
    "planned_platform", "collected_at", "collected_at_ts", "longitude", "latitude",
]

# F6 stored departures, as the sink writes them.
STORED_DEPARTURE = StructType([
    *[_s(f, DoubleType() if f in _DOUBLE_FIELDS else TimestampType() if f == "collected_at_ts" else StringType())
      for f in ["trip_id", "station_id", "station_name", "line_id", "line_name", "transport_mode", "direction",
                "planned_departure", "actual_departure", "delay_minutes", "platform", "planned_platform",
                "collected_at", "longitude", "latitude", "collected_at_ts", "dedup_hash"]],
    _s("score", DoubleType()), _s("batch_id", LongType()),
])

# F5 station_window_metrics columns, in output order.
METRIC_COLUMNS = [
    "station_id", "station_name", "window_start", "window_end", "avg_delay", "max_delay",
    "total_departures", "delayed_departures", "on_time_departures", "significant_delays",
    "total_records", "unique_lines", "on_time_pct", "delay_pct", "latitude", "longitude",
]

METRICS_TABLE = StructType([
    _s("station_id"), _s("station_name"),
    _s("window_start", TimestampType()), _s("window_end", TimestampType()),
    _s("avg_delay", DoubleType()), _s("max_delay", DoubleType()),
    _s("total_departures", LongType()), _s("delayed_departures", LongType()),
    _s("on_time_departures", LongType()), _s("significant_delays", LongType()),
    _s("total_records", LongType()), _s("unique_lines", LongType()),
    _s("on_time_pct", DoubleType()), _s("delay_pct", DoubleType()),
    _s("latitude", DoubleType()), _s("longitude", DoubleType()),
])

# The metrics changelog: stored windows, partitioned by date.
METRICS_CHANGELOG = StructType([
    *METRICS_TABLE.fields, _s("window_key", LongType()), _s("batch_id", LongType()),
    _s("updated_at", TimestampType()), _s("metric_date", DateType()),
])

# F8 stations dimension.
STATIONS = StructType([_s("station_id"), _s("enabled", BooleanType())])
