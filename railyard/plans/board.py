"""Board compositions (V1-V6): the numbers behind the live dashboard.

All take the roll-up (F7) and return small DataFrames; an empty roll-up
flows through as empty results, never an error (V6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.functions import columns as C
from railyard.operators import rollup as R
from railyard.operators import store as ST
from railyard.operators.rollup import coverage, leaders, network_kpis  # V5, V3, V1


def map_markers(rollup: DataFrame) -> DataFrame:
    """V2: one marker row per station with its delay category (P20)."""
    return rollup.select(
        "station_id", "station_name", "lat", "lon", "avg_delay",
        C.delay_category("avg_delay").alias("delay_category"),
        "max_delay", "total_departures", "delayed_departures", "on_time_pct", "delay_pct",
        "windows_count")


def station_table(rollup: DataFrame) -> DataFrame:
    """V4: the eight table columns, ordered by average delay."""
    avg = C.round_dp("avg_delay", 1)
    on_time = C.round_dp("on_time_pct", 1)
    return rollup.select(
        C.delay_status(avg).alias("status"),
        F.col("station_name").alias("station"),
        avg.alias("avg_delay_min"),
        C.round_dp("max_delay", 1).alias("max_delay_min"),
        C.performance_status(on_time).alias("performance"),
        on_time.alias("on_time_pct"),
        "total_departures", "delayed_departures",
        "station_id",
    ).orderBy(F.col("avg_delay_min").desc(), F.col("station_id"))


def export_board(table: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the station table (distributed write; header for CSV)."""
    w = table.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)


def board_views(changelog: DataFrame, as_of, minutes_back: int = 15) -> dict[str, DataFrame]:
    """Entry C: what one board refresh reads, as DataFrames.

    Metrics store at `as_of` (TTL, index, lookback) -> per-station roll-up ->
    KPIs, markers, leaders, table, coverage. The roll-up has one row per
    station; callers that show several views can `persist()` it.
    """
    roll = R.station_rollup(ST.recent_metrics(changelog, as_of, minutes_back))
    return {
        "rollup": roll,
        "network_kpis": network_kpis(roll),
        "map_markers": map_markers(roll),
        "leaders": leaders(roll),
        "station_table": station_table(roll),
        "coverage": coverage(roll, minutes_back),
    }
