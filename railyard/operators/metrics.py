"""Windowed station metrics (A1-A9, P16, T2, T3) and the claimed extras.

The aggregation is declared once; Spark plans partial aggregation before the
shuffle on (window, station), so a hot station cannot overload one task with
raw rows, and in streaming the same plan becomes the stateful aggregate.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.functions import columns as C
from railyard.schemas import APPROX_RSD, METRIC_COLUMNS, WINDOW_DURATION


#: What a window's metrics are grouped by.
GROUP = ["station_id", "station_name", "latitude", "longitude"]


def _distinct(col: str, exact: bool, rsd: float) -> F.Column:
    """Distinct count: exact in batch, a sketch on streams, which refuse the exact one.

    The sketch has 2^k registers, k chosen for a relative error of about `rsd`.
    """
    if exact:
        return F.count_distinct(col)
    k = min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(col, k)), F.lit(0)).cast("long")


def _micros(spark: SparkSession, duration: str) -> int:
    """`5 minutes` -> microseconds."""
    words = duration.lower().removeprefix("interval ")
    took = spark.sql(f"SELECT timestamp_ntz'1970-01-01 00:00:00' + interval {words} AS t").first()["t"]
    return (took - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def _fresh(value: str, most: int, by: list[str]) -> F.Column:
    """Panes since the group last had `value`, at most `most`; 0 in the same pane, or without a value.

    A row opens that many of the windows its pane lies in to its value: in the others an
    earlier row has it. So distinct values are counted by adding up rows.
    """
    own = Window.partitionBy(*by, value, F.when(F.col(value).isNull(), F.col("pane"))).orderBy("pane")
    gap = F.coalesce(F.col("pane") - F.lag("pane").over(own), F.lit(most))
    return F.when(F.col(value).isNotNull(), F.least(gap, F.lit(most))).otherwise(F.lit(0)).cast("int")


def _sliding_windows(enriched: DataFrame, window: str, slide: str, with_last_seen: bool) -> DataFrame:
    """The aggregate of station_window_metrics over sliding windows, with exact distinct counts.

    Time is cut into panes, of which every window is a whole number. Rows are sorted once by
    trip; from then on there is a row per (pane, station, line) and number of windows opened, and
    only these few go into each window. Nothing holds all trips of a window at once.
    """
    spark = enriched.sparkSession
    size = _micros(spark, window)
    step = _micros(spark, slide)
    if not 0 < step <= size:
        raise ValueError(f"a slide of {slide} does not suit windows of {window}")
    width = math.gcd(size, step)
    most = size // width
    us = "unix_micros(collected_at_ts)"
    pane = F.expr(f"({us} - pmod({us}, {width}L)) div {width}L")
    rows = (enriched.filter(F.col("collected_at_ts").isNotNull())
            .select(pane.alias("pane"), *GROUP, "trip_id", "line_id", "delay_minutes", "is_delayed", "is_on_time", "is_significant_delay",
                    *(["collected_at_ts"] if with_last_seen else []))
            .withColumn("trips", _fresh("trip_id", most, GROUP)))
    few = rows.groupBy("pane", *GROUP, "line_id", "trips").agg(
        F.sum("delay_minutes").alias("delay"), F.count("delay_minutes").alias("delays"), F.max("delay_minutes").alias("max_delay"),
        F.sum("is_delayed").alias("delayed"), F.sum("is_on_time").alias("on_time"), F.sum("is_significant_delay").alias("significant"),
        F.count(F.lit(1)).alias("records"), *([F.max("collected_at_ts").alias("last_seen")] if with_last_seen else []))
    few = few.withColumn("lines", _fresh("line_id", most, GROUP))
    # the pane is the n-th of the window that starts n panes earlier
    each = (few.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
            .withColumn("start_us", (F.col("pane") - F.col("n")) * F.lit(width)).filter(F.col("start_us") % step == 0))
    at = lambda c: F.timestamp_micros(c)
    opened = lambda c, by: F.sum(F.when(F.col(by) > F.col("n"), F.col(c) if c else F.lit(1)).otherwise(F.lit(0))).cast("long")
    agg = each.groupBy("start_us", *GROUP).agg(
        F.try_divide(F.sum("delay"), F.sum("delays")).alias("avg_delay"),
        F.max("max_delay").alias("max_delay"),
        opened("records", "trips").alias("total_departures"),
        F.sum("delayed").cast("long").alias("delayed_departures"),
        F.sum("on_time").cast("long").alias("on_time_departures"),
        F.sum("significant").cast("long").alias("significant_delays"),
        F.sum("records").cast("long").alias("total_records"),
        opened(None, "lines").alias("unique_lines"),
        *([F.max("last_seen").alias("last_seen")] if with_last_seen else []))
    start = F.col("start_us")
    return agg.withColumn("window", F.struct(at(start).alias("start"), at(start + F.lit(size)).alias("end")))


def station_window_metrics(enriched: DataFrame, window: str = WINDOW_DURATION,
                           slide: str | None = None, exact: bool = False,
                           rsd: float = APPROX_RSD, with_last_seen: bool = False) -> DataFrame:
    """One row per (window, station_id, station_name, latitude, longitude).

    on_time_pct / delay_pct divide record-level flag sums by distinct trips and
    so may exceed 100 (kept, Q1). Values are unrounded; see `round_metrics`.
    `with_last_seen` adds the group's latest collection time (`last_seen`),
    which replays use as the write time of the window.
    """
    if exact and slide:
        agg = _sliding_windows(enriched, window, slide, with_last_seen)
    else:
        win = F.window("collected_at_ts", window, slide) if slide else F.window("collected_at_ts", window)
        agg = (enriched
               .groupBy(win.alias("window"), *GROUP)
               .agg(F.avg("delay_minutes").alias("avg_delay"),
                    F.max("delay_minutes").alias("max_delay"),
                    _distinct("trip_id", exact, rsd).alias("total_departures"),
                    F.sum("is_delayed").cast("long").alias("delayed_departures"),
                    F.sum("is_on_time").cast("long").alias("on_time_departures"),
                    F.sum("is_significant_delay").cast("long").alias("significant_delays"),
                    F.count(F.lit(1)).alias("total_records"),
                    _distinct("line_id", exact, rsd).alias("unique_lines"),
                    *([F.max("collected_at_ts").alias("last_seen")] if with_last_seen else [])))
    pct = lambda c: F.try_divide(F.col(c).cast("double"), F.col("total_departures").cast("double")) * 100.0
    return agg.select(
        "station_id", "station_name",
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "avg_delay", "max_delay", "total_departures", "delayed_departures",
        "on_time_departures", "significant_delays", "total_records", "unique_lines",
        pct("on_time_departures").alias("on_time_pct"), pct("delayed_departures").alias("delay_pct"),
        "latitude", "longitude", *(["last_seen"] if with_last_seen else []),
    )


def round_metrics(metrics: DataFrame) -> DataFrame:
    """Averages and maxima to 2 dp, percentages to 1 dp (decimal-canonical)."""
    return metrics.withColumns({
        "avg_delay": C.round_dp("avg_delay", 2),
        "max_delay": C.round_dp("max_delay", 2),
        "on_time_pct": C.round_dp("on_time_pct", 1),
        "delay_pct": C.round_dp("delay_pct", 1),
    }).select(*METRIC_COLUMNS, *[c for c in metrics.columns if c not in METRIC_COLUMNS])


def storable(metrics: DataFrame) -> DataFrame:
    """FL9: a group with no name, average or maximum is never stored."""
    return metrics.filter(F.col("station_name").isNotNull()
                          & F.col("avg_delay").isNotNull()
                          & F.col("max_delay").isNotNull())


def mode_metrics(enriched: DataFrame, window: str = WINDOW_DURATION, exact: bool = True,
                 rsd: float = APPROX_RSD) -> DataFrame:
    """Per (window, transport mode): trips, records, delayed, on time, mean delay."""
    agg = (enriched
           .groupBy(F.window("collected_at_ts", window).alias("window"), "transport_mode")
           .agg(_distinct("trip_id", exact, rsd).alias("total_departures"),
                F.count(F.lit(1)).alias("total_records"),
                F.sum("is_delayed").cast("long").alias("delayed_departures"),
                F.sum("is_on_time").cast("long").alias("on_time_departures"),
                F.avg("delay_minutes").alias("avg_delay")))
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      "transport_mode", "total_departures", "total_records",
                      "delayed_departures", "on_time_departures",
                      C.round_dp("avg_delay", 2).alias("avg_delay"))


def delay_distribution(enriched: DataFrame, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """Records per delay category (P20 bins on each record's delay).

    Records with no delay form their own `Unknown` bucket, so buckets add up to
    the record count.
    """
    cat = F.coalesce(C.delay_category("delay_minutes"), F.lit("Unknown"))
    return (enriched.groupBy(*by, cat.alias("delay_category"))
            .agg(F.count(F.lit(1)).alias("records"),
                 C.round_dp(F.avg("delay_minutes"), 2).alias("avg_delay")))


def delay_percentiles(enriched: DataFrame, by: tuple[str, ...] = ("station_id",),
                      percentages=(0.5, 0.9, 0.99), accuracy: int = 10000) -> DataFrame:
    """Approximate delay percentiles (mergeable sketch, no global sort)."""
    return (enriched.groupBy(*by)
            .agg(F.percentile_approx("delay_minutes", list(percentages), accuracy).alias("p"))
            .select(*by, *[F.col("p")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(percentages)]))


def delay_sketches(enriched: DataFrame, window: str = WINDOW_DURATION, k: int = 400) -> DataFrame:
    """A24, stored form: a KLL sketch of the delays of each (window, station), and their number.

    Sketches merge, so percentiles over any lookback come from the stored windows without
    the raw rows. A window without a delay has no sketch. `k` sets size (some kB at
    most) and rank error (about 0.7 % at 400).
    """
    return (enriched.filter(F.col("delay_minutes").isNotNull())
            .groupBy(F.window("collected_at_ts", window).alias("window"), "station_id")
            .agg(F.count(F.lit(1)).alias("records"), F.kll_sketch_agg_double("delay_minutes", k).alias("sketch"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    F.to_date(F.col("window.start")).alias("metric_date"), "station_id", "records", "sketch"))


def merged_percentiles(sketches: DataFrame, by: tuple[str, ...] = ("station_id",), quantiles=(0.5, 0.9, 0.99)) -> DataFrame:
    """One row per group and quantile, from merged window sketches: quantile, records, delay.

    Partial merges run before the shuffle, so a task sends one sketch per group.
    """
    merged = sketches.groupBy(*by).agg(F.sum("records").alias("records"), F.kll_merge_agg_double("sketch").alias("sketch"))
    each = [F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("delay"))
            for q in quantiles]
    return merged.select(*by, "records", F.explode(F.array(*each)).alias("x")).select(*by, "x.quantile", "records", "x.delay")


def rank_bounds(enriched: DataFrame, estimates: DataFrame, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """`estimates` with the exact shares of delays below, and up to, each estimated one (share_below, share_upto)."""
    d = F.col("delay_minutes")
    rows = enriched.filter(d.isNotNull()).select(*by, "delay_minutes")
    return (rows.join(estimates, list(by)).groupBy(*by, "quantile", "records", "delay")
            .agg((F.count_if(d < F.col("delay")) / F.count(F.lit(1))).alias("share_below"),
                 (F.count_if(d <= F.col("delay")) / F.count(F.lit(1))).alias("share_upto")))
