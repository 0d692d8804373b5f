"""Tiny hand-made inputs for unit cases (FIXTURES.md section C)."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators import enrich as EN
from railyard.schemas import ENVELOPE_DATA_FIELDS

BASE = datetime(2024, 1, 1, 10, 0, tzinfo=timezone.utc)

FLAT_SCHEMA = ("trip_id string, station_id string, station_name string, line_id string, "
               "line_name string, transport_mode string, direction string, planned_departure string, "
               "actual_departure string, delay_minutes double, longitude double, latitude double, "
               "platform string, planned_platform string, collected_at string")


def dep(trip="t1", station="900000001", name="Station 1", line="U2", delay=1.0,
        collected=BASE, planned=None, direction="Dir 0", platform="1", lat=52.5, lon=13.4) -> dict:
    planned = planned or collected
    return {
        "trip_id": trip, "station_id": station, "station_name": name, "line_id": line,
        "line_name": (line or "").upper(), "transport_mode": "subway", "direction": direction,
        "planned_departure": planned.isoformat() if isinstance(planned, datetime) else planned,
        "actual_departure": planned.isoformat() if isinstance(planned, datetime) else planned,
        "delay_minutes": delay, "longitude": lon, "latitude": lat, "platform": platform,
        "planned_platform": "1",
        "collected_at": collected.isoformat() if isinstance(collected, datetime) else collected,
    }


def flat_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[f] for f in ENVELOPE_DATA_FIELDS) for r in rows], FLAT_SCHEMA)


def records(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return EN.encode_envelopes(flat_df(spark, rows), record_ts=F.current_timestamp())


def enriched(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return EN.enrich(EN.decode_envelopes(records(spark, rows)), watermark=None)


def minutes(n: float) -> timedelta:
    return timedelta(minutes=n)
