"""Ingest: validate and flatten API responses (P1-P6, FL3-FL5, A20, A21).

A raw departure (a VARIANT) is taken apart once, and validation is one Column
expression over its members, so the same rule runs on exploded rows (flatten / quarantine) and inside a higher-order
`filter` over the array (per-response counts without exploding).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions import columns as C
from railyard.schemas import ENABLED_STATIONS, PRODUCT_FLAGS, STATIONS


def _departure_type() -> str:
    """The members of a raw departure, each as it stands (a VARIANT)."""
    leaf = lambda names: ", ".join(f"{n} variant" for n in names)
    location = f"struct<{leaf(('type', 'id', 'latitude', 'longitude'))}>"
    stop = f"struct<{leaf(('type', 'id', 'name'))}, location {location}, products struct<{leaf(PRODUCT_FLAGS)}>>"
    line = f"struct<{leaf(('type', 'id', 'name', 'mode', 'product'))}>"
    return (f"struct<{leaf(('tripId', 'when', 'plannedWhen', 'delay', 'platform', 'plannedPlatform', 'direction', 'cancelled'))}, "
            f"stop {stop}, line {line}>")


def read_departure(d: Column) -> Column:
    """A raw departure's members, taken apart in one pass: each as it stands, null where it is missing.

    A record (the departure, `stop`, `stop.location`, ...) that is missing or no object is null.
    The rules look at these members; by path, each look would start at the whole departure.
    """
    return F.struct(d.alias("raw"), F.try_variant_get(d, "$", _departure_type()).alias("of"))


def _member(r: Column, path: str) -> Column:
    out = r["of"]
    for name in path.split("."):
        out = out[name]
    return out


def _as(r: Column, path: str, dtype: str) -> Column:
    return C.member_as(_member(r, path), "", dtype)


def _missing(r: Column, path: str) -> Column:
    """Not there, or an explicit null."""
    m = _member(r, path)
    return m.isNull() | F.coalesce(F.is_variant_null(m), F.lit(False))


def _not(r: Column, path: str, kind: str) -> Column:
    """There (explicit nulls included), but of another type."""
    m = _member(r, path)
    return m.isNotNull() & ~F.schema_of_variant(m).startswith(kind)


def _is(r: Column, path: str, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(_member(r, path)) == kind, F.lit(False))


def _time(r: Column, path: str) -> Column:
    return C.member_time(_member(r, path), "")


def validation_reason(d: Column) -> Column:
    """FL3 / FL4: first failed rule of a raw departure, or null when valid.

    Required members must be there and no nulls; text must be text, not a number;
    numbers may be written as text, and flags as yes / no, 0 / 1. Members with a
    default (types, product flags, `cancelled`) may be missing but not null;
    optional ones (`when`, `delay`, platforms) may be either. Coordinates must be
    within [-90, 90] / [-180, 180]. A bad record fails alone; its siblings in the
    response are unaffected.
    """
    return reading_reason(read_departure(d))


def reading_reason(d: Column) -> Column:
    """validation_reason of a departure that is already taken apart (read_departure)."""
    lat, lon = "stop.location.latitude", "stop.location.longitude"
    number = lambda p: _as(d, p, "double")
    text = lambda p: [(_missing(d, p), f"{p}: missing"), (_not(d, p, "STRING"), f"{p}: not text")]
    optional_text = lambda p: [(~_missing(d, p) & _not(d, p, "STRING"), f"{p}: not text")]
    default_text = lambda p: [(_not(d, p, "STRING"), f"{p}: not text")]

    def record(p):
        kind = F.coalesce(C.member_kind(d["raw"], p), F.lit("VOID"))
        none = _member(d, p).isNull()
        return [(none & (kind == "VOID"), f"{p}: missing"), (none, f"{p}: not a record")]

    def flag(p):
        return (_member(d, p).isNotNull() & ~_is(d, p, "BOOLEAN") & C.yes_no(_as(d, p, "string")).isNull())

    any_flag = None
    for m in PRODUCT_FLAGS:
        bad = flag(f"stop.products.{m}")
        any_flag = bad if any_flag is None else any_flag | bad
    rules = [
        (d["of"].isNull(), "not a record"),
        *text("tripId"), *record("stop"), *default_text("stop.type"), *text("stop.id"), *text("stop.name"),
        *record("stop.location"), *default_text("stop.location.type"), *text("stop.location.id"),
        *record("stop.products"), (any_flag, "stop.products: not a flag"),
        (_missing(d, lat), "latitude: missing"), (number(lat).isNull(), "latitude: not a number"),
        (_missing(d, lon), "longitude: missing"), (number(lon).isNull(), "longitude: not a number"),
        (_missing(d, "plannedWhen"), "plannedWhen: missing"),
        (_time(d, "plannedWhen").isNull(), "plannedWhen: not a time"),
        (~_missing(d, "when") & _time(d, "when").isNull(), "when: not a time"),
        (~_missing(d, "delay") & _delay(d).isNull(), "delay: not a whole number"),
        (flag("cancelled"), "cancelled: not a flag"),
        *optional_text("platform"), *optional_text("plannedPlatform"),
        *text("direction"), *record("line"), *default_text("line.type"), *text("line.id"), *text("line.name"),
        *text("line.mode"), *text("line.product"),
        (~number(lat).between(-90, 90), "latitude: out of range"),
        (~number(lon).between(-180, 180), "longitude: out of range"),
    ]
    expr = None
    for cond, reason in rules:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def _delay(r: Column) -> Column:
    """Seconds; a flag counts as 0 or 1."""
    return (F.when(_is(r, "delay", "BOOLEAN"), _as(r, "delay", "boolean").cast("int"))
            .otherwise(C.whole_seconds(_as(r, "delay", "string"))))


def judged_departures(departures) -> Column:
    """The departures of a response, taken apart (read_departure), each with its `reason`."""
    return F.transform(F.transform(departures, read_departure),
                       lambda r: F.struct(r["raw"].alias("raw"), r["of"].alias("of"), reading_reason(r).alias("reason")))


def explode_departures(responses: DataFrame) -> DataFrame:
    """One row per departure (`d`), with the response's station and fetch time, and FL3's reason in `d`.

    Taken apart and judged inside the generator: above it, the optimizer would do it again
    for each use, and the rules would make one method too long for the JVM to compile.
    """
    return responses.select("requested_station_id", "fetched_at", F.explode(judged_departures("departures")).alias("d"))


def with_validation(exploded: DataFrame) -> DataFrame:
    return exploded.withColumn("reason", F.col("d.reason"))


def project_departure(validated: DataFrame) -> DataFrame:
    """Nested raw record -> flat F2 record."""
    d = F.col("d")
    text = lambda p: _as(d, p, "string")
    planned = _time(d, "plannedWhen")
    return validated.select(
        text("tripId").alias("trip_id"),
        text("stop.id").alias("station_id"),
        text("stop.name").alias("station_name"),
        text("line.id").alias("line_id"),
        text("line.name").alias("line_name"),
        C.transport_mode(text("line.product")).alias("transport_mode"),
        text("direction").alias("direction"),
        planned.alias("planned_departure"),
        C.actual_departure(_time(d, "when"), planned).alias("actual_departure"),
        C.delay_minutes(_delay(d)).alias("delay_minutes"),
        text("platform").alias("platform"),
        text("plannedPlatform").alias("planned_platform"),
        F.coalesce(C.yes_no(text("cancelled")), F.lit(False)).alias("cancelled"),
        F.col("fetched_at").alias("collected_at"),
        _as(d, "stop.location.longitude", "double").alias("longitude"),
        _as(d, "stop.location.latitude", "double").alias("latitude"),
    )


def flatten_departures(responses: DataFrame, include_cancelled: bool = True) -> DataFrame:
    """P1-P6 + FL3/FL4: valid departures of all responses as flat F2 rows.

    Cancelled trips are kept by default (Q14: the topic never carried the
    flag, so a cancelled trip with no delay counted as on time); pass
    `include_cancelled=False` to leave them out before they reach the topic.
    """
    v = with_validation(explode_departures(responses))
    flat = project_departure(v.filter(F.col("reason").isNull()))
    return flat if include_cancelled else flat.filter(~F.col("cancelled"))


def quarantine(responses: DataFrame) -> DataFrame:
    """FL3: rejected departures with the first failed rule."""
    v = with_validation(explode_departures(responses))
    return v.filter(F.col("reason").isNotNull()).select(
        "requested_station_id", "fetched_at",
        _as(F.col("d"), "tripId", "string").alias("trip_id"), "reason")


def configured_stations(spark: SparkSession) -> DataFrame:
    """F8: the configured station list, all enabled."""
    return spark.createDataFrame([(s, True) for s in ENABLED_STATIONS], STATIONS)


def enabled_only(df: DataFrame, stations: DataFrame | None = None, key: str = "station_id") -> DataFrame:
    """FL5: keep rows of enabled stations; of the configured ones if no list is given.

    The station list is configuration (one row per polled station); it is
    broadcast when its estimated size is within the limit, so the semi-join
    runs map-side with no shuffle of `df`, and planned as a shuffle join
    otherwise.
    """
    if stations is None:
        stations = configured_stations(df.sparkSession)
    allow = stations.filter("enabled").select(F.col("station_id").alias(key))
    return df.join(allow, key, "left_semi")


def ingest_quality(responses: DataFrame) -> DataFrame:
    """Per response, departures found and departures that validate.

    Counted with a higher-order filter over the array: no explode, no shuffle.
    """
    parsed = F.size(F.filter(F.transform("departures", read_departure), lambda r: reading_reason(r).isNull()))
    return responses.select(
        "requested_station_id", "fetched_at",
        F.coalesce(F.size("departures"), F.lit(0)).alias("records_found"),
        F.when(F.col("departures").isNull(), F.lit(0)).otherwise(parsed).alias("records_parsed"))


def ingest_cycle_summary(responses: DataFrame, stations: DataFrame) -> DataFrame:
    """Per one-minute poll cycle, stations ok / failed and the cycle span.

    A poll succeeds when its response holds at least one valid departure; an
    enabled station without a successful poll in the cycle counts as failed.
    Every minute from the first cycle to the last has a row, also one in which
    each poll failed (no responses, no departures, no span). Responses of other
    stations are left out. The enabled-station count is a scalar subquery over
    the station list, so no stations x cycles grid is built.
    """
    responses = enabled_only(responses, stations, "requested_station_id")
    n_enabled = stations.filter("enabled").select(F.count(F.lit(1))).scalar()
    q = ingest_quality(responses)
    cyc = F.date_trunc("minute", F.col("fetched_at"))
    g = q.groupBy(cyc.alias("cycle_start")).agg(
        F.count_distinct(F.when(F.col("records_parsed") > 0, F.col("requested_station_id"))).alias("stations_ok"),
        F.count(F.lit(1)).alias("responses"),
        F.sum("records_parsed").cast("long").alias("departures"),
        F.min("fetched_at").alias("first_fetch"),
        F.max("fetched_at").alias("last_fetch"))
    minute = F.date_trunc("minute", F.col("fetched_at"))
    span = responses.agg(F.min(minute).alias("lo"), F.max(minute).alias("hi")).filter("lo is not null")
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 minute"))).alias("cycle_start"))
    g = spine.join(g, "cycle_start", "left").fillna(0, ["stations_ok", "responses", "departures"])
    return g.select(
        "cycle_start",
        n_enabled.alias("stations_polled"),
        "stations_ok",
        (n_enabled - F.col("stations_ok")).alias("stations_failed"),
        "responses", "departures",
        ((F.unix_micros("last_fetch") - F.unix_micros("first_fetch")) / F.lit(1e6)).alias("duration_sec"))
