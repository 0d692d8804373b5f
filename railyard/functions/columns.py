"""Scalar column functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen
and run unchanged in batch and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard.schemas import MODE_NOT_DEFINED, TRANSPORT_MODES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def delay_minutes(delay_seconds) -> Column:
    """Source delay in seconds (nullable, may be negative) -> minutes, null -> 0."""
    return F.coalesce(_c(delay_seconds), F.lit(0)).cast("double") / F.lit(60.0)


def whole_seconds(text) -> Column:
    """FL3: text of a whole number (`60`, `60.0`, `-5`) -> int; anything else, or out of int range -> null."""
    d = _c(text).try_cast("double")
    return F.when((d == F.floor(d)) & (F.abs(d) <= 2147483647), d).cast("int")


def yes_no(text) -> Column:
    """FL3: text of a yes / no value -> boolean; anything else -> null."""
    t = F.lower(_c(text))
    return (F.when(t.isin("true", "t", "yes", "y", "on", "1", "1.0"), F.lit(True))
            .when(t.isin("false", "f", "no", "n", "off", "0", "0.0"), F.lit(False)))


def _path(path: str) -> str:
    return f"$.{path}" if path else "$"


def member(value, path: str) -> Column:
    """A member of a VARIANT as it stands, by its path (empty: the value itself); null where it is missing."""
    return F.try_variant_get(_c(value), _path(path), "variant") if path else _c(value)


def member_kind(value, path: str) -> Column:
    """The type of a member: null where it is missing, 'VOID' for an explicit null, else STRING, BIGINT, OBJECT<...>, ..."""
    return F.schema_of_variant(member(value, path))


def member_as(value, path: str, dtype: str) -> Column:
    """A member cast to a type; null where it is missing, null or cannot be cast."""
    return F.try_variant_get(_c(value), _path(path), dtype)


def member_time(value, path: str) -> Column:
    """A member that is a time: ISO-8601 text, or seconds (beyond 2e10: milliseconds) since the epoch."""
    n = member_as(value, path, "double")
    seconds = F.when(F.abs(n) <= 2e10, n).otherwise(n / 1000)
    epoch = F.when(F.abs(seconds) < 2.5e11, F.timestamp_micros((seconds * 1e6).cast("long")))
    return F.when(member_kind(value, path) == "STRING", parse_ts(member_as(value, path, "string"))).when(
        member_kind(value, path).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), epoch)


def actual_departure(when, planned_when) -> Column:
    """Actual departure = `when`, else the planned time."""
    return F.coalesce(_c(when), _c(planned_when))


def transport_mode(product) -> Column:
    """P5: product -> mode, case-insensitive; unknown or missing -> 'not defined'."""
    p = F.lower(_c(product))
    return F.when(p.isin(*TRANSPORT_MODES), p).otherwise(F.lit(MODE_NOT_DEFINED))


def parse_ts(text) -> Column:
    """ISO-8601 text (offset, `Z`, fraction) -> timestamp; bad text -> null.

    Spark 4 runs ANSI, where `to_timestamp('garbage')` raises; `try_to_timestamp`
    gives the null the non-ANSI reference produced.
    """
    return F.try_to_timestamp(_c(text))


def iso_text(ts) -> Column:
    """Timestamp -> ISO-8601 text with microseconds and offset."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def envelope_text(ts) -> Column:
    """Timestamp -> the envelope's ISO text: no fraction where it is zero.

    The text a source writes for a whole second, so typed and text input give
    one envelope and one dedup hash.
    """
    whole = F.unix_micros(_c(ts)) % 1_000_000 == 0
    return F.when(whole, F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(iso_text(ts))


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (a null condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_delayed(delay) -> Column:
    """Delay > 2 minutes."""
    return flag(_c(delay) > 2)


def is_on_time(delay) -> Column:
    """Delay <= 2 minutes (null delay is neither on time nor delayed)."""
    return flag(_c(delay) <= 2)


def is_significant_delay(delay) -> Column:
    """Delay > 5 minutes."""
    return flag(_c(delay) > 5)


def nan_to_null(x) -> Column:
    """Q21: a NaN delay would compare as greater than everything; treat it as missing."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def round_dp(x, dp: int) -> Column:
    """Decimal-canonical rounding (half up on the decimal value).

    Rounding the binary double directly differs between engines at ties; going
    through decimal(20, 6) makes Spark and the SQL oracle agree.
    """
    return F.round(_c(x).cast("decimal(20,6)"), dp).cast("double")


def dedup_hash(station_id, planned, direction, line_id, platform) -> Column:
    """First 8 hex digits of md5('station:planned:direction:line:platform').

    A null part is written as the text `None`, as the source's string
    formatting did.
    """
    parts = [F.coalesce(_c(x).cast("string"), F.lit("None"))
             for x in (station_id, planned, direction, line_id, platform)]
    return F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8)


def window_key(window_start) -> Column:
    """Store key = epoch seconds of the window start."""
    return F.unix_seconds(_c(window_start))


def delay_category(avg_delay) -> Column:
    """P20: right-closed bins (-inf,0] (0,2] (2,5] (5,10] (10,inf)."""
    d = _c(avg_delay)
    return (F.when(d <= 0, "On Time")
            .when(d <= 2, "Minor Delay")
            .when(d <= 5, "Moderate Delay")
            .when(d <= 10, "Major Delay")
            .when(d.isNotNull(), "Severe Delay"))


def delay_status(avg_delay) -> Column:
    """< 2 green, < 5 yellow, else red."""
    d = _c(avg_delay)
    return F.when(d < 2, "green").when(d < 5, "yellow").otherwise("red")


def performance_status(on_time_pct) -> Column:
    """> 80 green, > 60 yellow, else red."""
    p = _c(on_time_pct)
    return F.when(p > 80, "green").when(p > 60, "yellow").otherwise("red")
