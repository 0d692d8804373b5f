"""Per-station roll-up over stored windows (A10-A15, FL7, FL8) and the
network-level aggregates built on it (A16-A18).

One `groupBy(station_id)` does the whole roll-up: sums, weighted mean, max,
window range and the latest window's attributes (via `max_by` on a struct,
which makes it a sort aggregation), partial before the shuffle and final after
it. The roll-up has one row per station, so the network aggregates that follow
are tiny global aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.functions import columns as C


def station_rollup(metrics: DataFrame, with_raw: bool = False) -> DataFrame:
    """Roll stored windows (F5 + updated_at) up to one row per station.

    - sums and weights use only windows with an average (FL7);
    - name, position and updated_at come from the latest window of all;
    - a station whose latest latitude or longitude is null or 0 is left out (FL8);
    - counts are clamped to total_departures and rescaled to sum to 100 (A13);
    - `window_end` is the latest valid window *start* (Q7); `last_window_end`
      is its end.
    """
    valid = F.col("avg_delay").isNotNull()
    trips = F.col("total_departures")
    latest = F.max_by(F.struct(*[F.col(c) for c in
                                 ("station_name", "latitude", "longitude", "updated_at", "window_start")]
                               + ([F.to_json(F.struct(*[F.col(c) for c in metrics.columns])).alias("raw")]
                                  if with_raw else [])),
                      F.col("window_start"))
    g = (metrics.groupBy("station_id").agg(
        latest.alias("latest"),
        F.count(F.when(valid, 1)).alias("windows_count"),
        F.sum(F.when(valid, trips)).alias("total_departures"),
        F.sum(F.when(valid, F.col("delayed_departures"))).alias("delayed_departures"),
        F.sum(F.when(valid, F.col("on_time_departures"))).alias("on_time_departures"),
        F.sum(F.when(valid, F.col("significant_delays"))).alias("significant_delays"),
        F.sum(F.when(valid & (trips > 0), F.col("avg_delay") * trips)).alias("weighted_delay"),
        F.max(F.when(valid, F.col("max_delay"))).alias("max_delay"),
        F.min(F.when(valid, F.col("window_start"))).alias("window_start"),
        F.max(F.when(valid, F.col("window_start"))).alias("window_end"),
        F.max(F.when(valid, F.col("window_end"))).alias("last_window_end"),
    ))
    lat, lon = F.col("latest.latitude"), F.col("latest.longitude")
    g = g.filter((F.col("windows_count") > 0)
                 & lat.isNotNull() & lon.isNotNull() & (lat != 0) & (lon != 0))

    total = F.col("total_departures")
    on_c = F.least(F.col("on_time_departures"), total)
    dl_c = F.least(F.col("delayed_departures"), total)
    scale = F.when(on_c + dl_c > total, total.cast("double") / (on_c + dl_c)).otherwise(F.lit(1.0))
    on_pct = F.when(total > 0, on_c * scale / total * 100.0).otherwise(F.lit(100.0))
    dl_pct = F.when(total > 0, dl_c * scale / total * 100.0).otherwise(F.lit(0.0))
    avg = F.when(total > 0, F.col("weighted_delay") / total).otherwise(F.lit(0.0))

    out = g.select(
        "station_id",
        F.col("latest.station_name").alias("station_name"),
        lat.alias("lat"), lon.alias("lon"),
        C.round_dp(avg, 1).alias("avg_delay"),
        C.round_dp("max_delay", 1).alias("max_delay"),
        "total_departures", "delayed_departures", "on_time_departures", "significant_delays",
        C.round_dp(on_pct, 1).alias("on_time_pct"),
        C.round_dp(dl_pct, 1).alias("delay_pct"),
        "window_start", "window_end", "last_window_end", "windows_count",
        F.col("latest.updated_at").alias("updated_at"),
        *([F.col("latest.raw").alias("raw_metric")] if with_raw else []),
    )
    return out


def network_kpis(rollup: DataFrame) -> DataFrame:
    """A16 + P21: active stations, unweighted mean of station averages, total trips.

    Empty input gives no row (V6).
    """
    g = rollup.agg(F.count(F.lit(1)).alias("active_stations"),
                   F.avg("avg_delay").alias("_avg"),
                   F.sum("total_departures").alias("total_departures"))
    return g.filter("active_stations > 0").select(
        "active_stations",
        C.round_dp("_avg", 2).alias("avg_delay"),
        C.delay_status("_avg").alias("delay_status"),
        "total_departures")


def coverage(rollup: DataFrame, minutes_back: int) -> DataFrame:
    """A17 + P24: windows per station (mean, min, max) against the expected count."""
    g = rollup.agg(F.count(F.lit(1)).alias("stations"),
                   F.avg("windows_count").alias("_avg"),
                   F.min("windows_count").alias("min_windows"),
                   F.max("windows_count").alias("max_windows"),
                   F.sum("total_departures").alias("total_departures"))
    return g.filter("stations > 0").select(
        F.lit(minutes_back).alias("minutes_back"),
        F.lit(minutes_back // 15).alias("expected_windows"),
        "stations",
        C.round_dp("_avg", 1).alias("avg_windows"),
        "min_windows", "max_windows", "total_departures")


def leaders(rollup: DataFrame) -> DataFrame:
    """Best (lowest avg delay), worst (highest), busiest (most trips).

    One aggregation with min_by over (metric, station_id): ties go to the
    smallest station id, independent of row order.
    """
    row = F.struct("station_id", "station_name", "avg_delay", "on_time_pct", "total_departures")
    g = rollup.agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(row, F.struct(F.col("avg_delay"), F.col("station_id"))).alias("best"),
        F.min_by(row, F.struct(-F.col("avg_delay"), F.col("station_id"))).alias("worst"),
        F.min_by(row, F.struct(-F.col("total_departures"), F.col("station_id"))).alias("busiest"),
    ).filter("_n > 0")
    picked = g.select(F.explode(F.array(
        F.struct(F.lit("best").alias("role"), F.col("best").alias("s")),
        F.struct(F.lit("worst").alias("role"), F.col("worst").alias("s")),
        F.struct(F.lit("busiest").alias("role"), F.col("busiest").alias("s")),
    )).alias("x"))
    return picked.select(F.col("x.role").alias("role"), "x.s.*")
