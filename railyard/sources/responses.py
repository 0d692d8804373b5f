"""API responses (F1): reading them, and rebuilding them from observations.

A response is one poll of one station: every departure in it shares the
fetch time, so (station, fetched_at) identifies it and its size is bounded
by what one poll returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.schemas import PRODUCT_FLAGS, RAW_RESPONSE


def read_responses(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """S3: JSON responses (one object per line) with the declared F1 schema."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(RAW_RESPONSE).json(path)


def write_responses(responses: DataFrame, path: str) -> None:
    """Store responses as JSON lines (the form a poller would land them in)."""
    responses.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def _raw_departure(obs: DataFrame):
    """JSON text of an observation's raw departure. Columns raw_* (VARIANT), if there are any, stand for the values as sent."""
    sent = lambda raw, own: F.col(raw) if raw in obs.columns else F.col(own).cast("variant")
    p = F.lower(F.col("product"))
    flags = [(p == F.lit(m)).cast("variant") if m != "subway" or "raw_flag" not in obs.columns else F.col("raw_flag")
             for m in PRODUCT_FLAGS]
    products = F.struct(*[f.alias(m) for f, m in zip(flags, PRODUCT_FLAGS)])
    location = F.struct(F.lit("location").alias("type"), F.col("station_id").alias("id"),
                        F.col("latitude").alias("latitude"), F.col("longitude").alias("longitude"))
    stop = F.struct(F.lit("stop").alias("type"), F.col("station_id").alias("id"),
                    F.col("station_name").alias("name"), location.alias("location"),
                    (F.when(~F.col("no_products"), products) if "no_products" in obs.columns else products)
                    .alias("products"))
    line = F.struct(F.lit("line").alias("type"), F.col("line_id").alias("id"),
                    F.col("line_name").alias("name"), F.lit("train").alias("mode"),
                    F.col("product").alias("product"))
    return F.to_json(F.struct(
        sent("raw_trip", "trip_id").alias("tripId"), stop.alias("stop"),
        F.col("actual_when").alias("when"), F.col("planned_when").alias("plannedWhen"),
        sent("raw_delay", "delay").alias("delay"), F.col("platform").alias("platform"),
        F.col("planned_platform").alias("plannedPlatform"), F.col("direction").alias("direction"),
        line.alias("line"), sent("raw_cancelled", "cancelled").alias("cancelled")))


def responses_from_observations(obs: DataFrame) -> DataFrame:
    """Observation rows -> F1 responses, one per (station, fetch time).

    Shuffles once on (station, fetched_at); each group is one poll's result.
    Departures are ordered inside the array by trip id so responses are
    deterministic.
    """
    return (obs.groupBy(F.col("station_id").alias("requested_station_id"),
                        F.col("collected_at_ts").alias("fetched_at"))
            .agg(F.array_sort(F.collect_list(
                F.struct(F.col("trip_id").alias("_k"), F.col("event_id").alias("_e"),
                         _raw_departure(obs).alias("d")))).alias("_ds"))
            .select("requested_station_id", "fetched_at",
                    F.from_json(F.concat(F.lit("["), F.array_join(F.transform("_ds", lambda x: x["d"]), ","), F.lit("]")),
                                RAW_RESPONSE["departures"].dataType).alias("departures")))
