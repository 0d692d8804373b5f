"""Departure observations derived from the driver's `events` table.

The mapping is fixed (FIXTURES.md section B): one event row becomes one
departure observation of one of twelve stations. Everything is a projection,
so it adds no shuffle and scans only the six `events` columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions import columns as C
from railyard.session import ensure_utc

# The fixture mapping (FIXTURES.md section B), as Spark SQL.
_HELPERS = {
    "cu": "1704067200000000L + (unix_micros(cast(ts as timestamp)) - 1704067200000000L) div 30",
    "k": "cast(get_json_object(props, '$.k') as int)",
    "si": "cast(user_id % 12 as int)",
}
_HELPERS2 = {
    "pu": "((cu div 60000000) + (k % 5)) * 60000000",
    "delay_s": "case when k % 20 = 0 then cast(null as int) else cast(floor(value * 6) as int) - 60 end",
}
_COLUMNS = {
    "event_id": "event_id",
    "trip_id": "concat('trip-', cast(user_id div 12 as string), '-', cast(cu div 3600000000 as string))",
    "station_id": "concat('9000', lpad(cast(si as string), 5, '0'))",
    "station_name": "concat('Station ', cast(si as string))",
    "enabled": "si < 10",
    "line_id": "event_type",
    "line_name": "upper(event_type)",
    "product": ("case event_type when 'click' then 'suburban' when 'view' then 'Subway' "
                "when 'purchase' then 'BUS' when 'signup' then 'tram' else 'zeppelin' end"),
    "direction": "concat('Dir ', cast(k % 3 as string))",
    "planned_when": "date_format(timestamp_micros(pu), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\")",
    "actual_when": ("case when k % 25 = 0 then null else date_format(timestamp_micros("
                    "pu + coalesce(delay_s, 0) * 1000000L), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\") end"),
    "delay": "delay_s",
    "delay_minutes": "coalesce(delay_s, 0) / 60D",
    "platform": "case when k % 4 = 0 then null else cast(k % 4 as string) end",
    "planned_platform": "cast(1 + k % 4 as string)",
    "cancelled": "k % 25 = 0",
    "latitude": "52.5D + si / 100D",
    "longitude": "13.4D + si / 100D",
    "collected_at": "date_format(timestamp_micros(cu), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\")",
    "collected_at_ts": "timestamp_micros(cu)",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core.

    A small table stored as one row group scans as a single partition, and
    every expression above it (JSON, time parsing) then runs in one task. When
    the scan has fewer splits than the cluster's default parallelism, a
    round-robin repartition of the narrow input spreads that work; a large
    table already has more splits than cores and is left as it is (no
    shuffle).
    """
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:   # no RDD view (e.g. a Connect session): leave the scan as it is
        return df
    return df.repartition(want) if have < want else df


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All mapped rows (twelve stations, `enabled` marks the ten polled ones)."""
    ensure_utc(spark)
    ev = spread(read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"))
    ev = ev.select("*", *[F.expr(v).alias(k) for k, v in _HELPERS.items()])
    ev = ev.select("*", *[F.expr(v).alias(k) for k, v in _HELPERS2.items()])
    return ev.select(*[F.expr(v).alias(k) for k, v in _COLUMNS.items()])


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `departures` view: rows of enabled stations only."""
    return observations(spark, sf_dir).filter("enabled").drop("enabled")


def stations(spark: SparkSession, n_stations: int = 12, n_enabled: int = 10) -> DataFrame:
    """F8: the fixture's station list (ids 900000000 + i, the first ten enabled).

    This is configuration, like the poller's station list: one row per station.
    """
    return (spark.range(n_stations)
            .select(F.concat(F.lit("9000"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("station_id"),
                    (F.col("id") < n_enabled).alias("enabled")))


def flat_departures(obs: DataFrame) -> DataFrame:
    """Observation rows -> F2 flat departures with ISO text times (P3-P5 applied)."""
    return obs.select(
        "event_id", "trip_id", "station_id", "station_name", "line_id", "line_name",
        C.transport_mode("product").alias("transport_mode"),
        "direction",
        F.col("planned_when").alias("planned_departure"),
        C.actual_departure("actual_when", "planned_when").alias("actual_departure"),
        C.delay_minutes("delay").alias("delay_minutes"),
        "platform", "planned_platform", "cancelled", "collected_at",
        "longitude", "latitude",
    )


# ---------------------------------------------------------------------------
# Perturbations (FIXTURES.md B.2): rule-based, row-local, identical in the oracle.
# ---------------------------------------------------------------------------

def perturb_for_enrich(flat: DataFrame) -> DataFrame:
    """FL1: line_id null (event_id % 40 = 0); FL2: collected_at garbage (% 60);
    C4: delay_minutes null (% 30); C7/FL9: station_name null (% 45)."""
    e = F.col("event_id")
    return flat.withColumns({
        "line_id": F.when(e % 40 == 0, F.lit(None).cast("string")).otherwise(F.col("line_id")),
        "collected_at": F.when(e % 60 == 0, F.lit("garbage")).otherwise(F.col("collected_at")),
        "delay_minutes": F.when(e % 30 == 0, F.lit(None).cast("double")).otherwise(F.col("delay_minutes")),
        "station_name": F.when(e % 45 == 0, F.lit(None).cast("string")).otherwise(F.col("station_name")),
    })


def perturb_for_validation(obs: DataFrame) -> DataFrame:
    """FL3/FL4: latitude 95 (event_id % 50 = 0); direction null (% 70); delay of another
    type (% 90) or with a fraction (% 110); cancelled of another type (% 130) or an explicit
    null (% 210); no products (% 170) or a product flag of another type (% 230); a trip id
    that is a number (% 190)."""
    e = F.col("event_id")
    word = F.parse_json(F.lit('"maybe"'))
    return obs.withColumns({
        "latitude": F.when(e % 50 == 0, F.lit(95.0)).otherwise(F.col("latitude")),
        "direction": F.when(e % 70 == 0, F.lit(None).cast("string")).otherwise(F.col("direction")),
        "raw_trip": F.when(e % 190 == 0, e.cast("variant")).otherwise(F.col("trip_id").cast("variant")),
        "raw_delay": (F.when(e % 90 == 0, F.parse_json(F.lit('"abc"'))).when(e % 110 == 0, F.parse_json(F.lit("60.5")))
                      .otherwise(F.col("delay").cast("variant"))),
        "raw_cancelled": (F.when(e % 130 == 0, word).when(e % 210 == 0, F.parse_json(F.lit("null")))
                          .otherwise(F.col("cancelled").cast("variant"))),
        "raw_flag": F.when(e % 230 == 0, word).otherwise((F.lower("product") == "subway").cast("variant")),
        "no_products": e % 170 == 0,
    })


def perturb_zero_latitude(df: DataFrame, station_id: str = "900000009") -> DataFrame:
    """FL8: latitude 0 for one station."""
    return df.withColumn(
        "latitude",
        F.when(F.col("station_id") == station_id, F.lit(0.0)).otherwise(F.col("latitude")))
