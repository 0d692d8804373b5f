"""Store semantics as tables and views (T5-T12, FL6, FL9, P15, P17, P25).

The reference kept these in a key-value store with per-key expiry. Here the
metrics are an append-only changelog (one directory per micro-batch, so a
retried batch overwrites only itself) and every read is a view:
latest-per-key, TTL as an `as_of` predicate, lookback as a filter that the
`metric_date` partition column lets the scan prune.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.functions import columns as C
from railyard.schemas import (
    DEPARTURES_TTL_SECONDS,
    METRICS_TTL_SECONDS,
    RECENT_DEPARTURES_PER_STATION,
)

# The stored payload's fields.
PAYLOAD_COLUMNS = [
    "trip_id", "station_id", "station_name", "line_id", "line_name", "transport_mode",
    "direction", "planned_departure", "actual_departure", "delay_minutes", "platform",
    "planned_platform", "collected_at", "longitude", "latitude",
]
#: What the dedup hash (P15) is made of.
_IDENTITY_COLUMNS = ["station_id", "planned_departure", "direction", "line_id", "platform"]


def _lit_ts(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, datetime):
        return F.lit(x).cast("timestamp")
    return F.to_timestamp(F.lit(x))


def _secs(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' SECOND")


def as_of_from(df: DataFrame, col: str = "collected_at_ts") -> Column:
    """`as_of` taken from the data: a scalar subquery over max(col)."""
    return df.select(F.max(col)).scalar()


def as_of_value(df: DataFrame, col: str = "collected_at_ts") -> Column:
    """`as_of` taken from the data once, as a literal.

    One job computes max(col) (a single scalar reaches the driver); the views
    then use a literal, so the bound is evaluated once instead of once per
    reference, and `metric_date >= ...` prunes partitions at planning time.
    A live reader passes its wall clock instead.
    """
    micros = df.select(F.max(F.unix_micros(col))).first()[0]
    return F.timestamp_micros(F.lit(micros)) if micros is not None else F.lit(None).cast("timestamp")


# ---------------------------------------------------------------------------
# Metrics store (T5-T8, FL6, P17, P25)
# ---------------------------------------------------------------------------

def metric_rows(rounded: DataFrame, batch_id, updated_at: Column) -> DataFrame:
    """F5 row as written by one batch: + key (P17), batch id, update time, date (P25)."""
    return rounded.withColumns({
        "window_key": C.window_key("window_start"),
        "batch_id": F.lit(batch_id).cast("long") if not isinstance(batch_id, Column) else batch_id,
        "updated_at": updated_at,
        "metric_date": F.to_date("window_start"),
    })


def latest_per_key(changelog: DataFrame) -> DataFrame:
    """T5: last write wins on (station_id, window_start).

    Later batches win; inside one batch, rows that collide on the key (same
    station and window, different name or position, Q3) are ordered by
    total_records then station_name so the winner is deterministic. Spark
    plans this as a window-group limit, which keeps one row per key on the map
    side before the shuffle.
    """
    w = Window.partitionBy("station_id", "window_start").orderBy(
        F.col("batch_id").desc(), F.col("total_records").desc(), F.col("station_name").desc_nulls_last())
    return (changelog.withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").drop("_rn"))


def current_metrics(changelog: DataFrame, as_of=None, ttl_seconds: int | None = METRICS_TTL_SECONDS) -> DataFrame:
    """T5 read view: latest row per key that has not expired at `as_of`.

    A key expires `ttl_seconds` after its last update; `as_of=None` reads
    without expiry.
    """
    cur = latest_per_key(changelog)
    if as_of is not None and ttl_seconds is not None:
        cur = cur.filter(F.col("updated_at") > _lit_ts(as_of) - _secs(ttl_seconds))
    return cur


def station_index(changelog: DataFrame, as_of=None, ttl_seconds: int | None = METRICS_TTL_SECONDS) -> DataFrame:
    """Stations that ever had stored metrics.

    The index is one set whose expiry every write refreshes, so it is either
    complete (some write within the TTL) or empty.
    """
    ids = changelog.select("station_id").distinct()
    if as_of is not None and ttl_seconds is not None:
        last_write = changelog.select(F.max("updated_at")).scalar()
        ids = ids.filter(last_write > _lit_ts(as_of) - _secs(ttl_seconds))
    return ids


def lookback(metrics: DataFrame, as_of, minutes_back: int | None) -> DataFrame:
    """FL6: windows whose start is at or after as_of - minutes_back.

    The date bound on `metric_date` is implied by the timestamp bound; stating
    it lets a partitioned scan skip whole days.
    """
    if minutes_back is None:
        return metrics
    lo = _lit_ts(as_of) - _secs(60 * minutes_back)
    out = metrics
    if "metric_date" in metrics.columns:
        out = out.filter(F.col("metric_date") >= F.to_date(lo))
    return out.filter(F.col("window_start") >= lo)


def recent_metrics(changelog: DataFrame, as_of, minutes_back: int | None = 15,
                   ttl_seconds: int | None = METRICS_TTL_SECONDS) -> DataFrame:
    """Every indexed station's live windows in the lookback.

    Stations with no window are simply absent. The index and the windows share
    one TTL, so a live window proves its station indexed and the index alive:
    no join with the index. The lookback comes first: it is on the key's
    window_start, so it keeps or drops whole keys, and the scan prunes dates.
    """
    return current_metrics(lookback(changelog, as_of, minutes_back), as_of, ttl_seconds)


def station_history(changelog: DataFrame, station_id: str | None, as_of, minutes_back: int | None = 15,
                    ttl_seconds: int | None = METRICS_TTL_SECONDS) -> DataFrame:
    """T7 + O2: a station's live windows in the lookback, ordered by window start.

    `station_id=None` reads every station's history (ordered by station, then
    window start); the filter on one id prunes the scan otherwise.
    """
    src = changelog if station_id is None else changelog.filter(F.col("station_id") == station_id)
    cur = current_metrics(lookback(src, as_of, minutes_back), as_of, ttl_seconds)
    return cur.orderBy("station_id", "window_start")


# ---------------------------------------------------------------------------
# Departures store
# ---------------------------------------------------------------------------

def departure_records(view: DataFrame) -> DataFrame:
    """stored departure = payload + dedup hash (P15) + score (epoch seconds)."""
    return view.select(
        *[c for c in PAYLOAD_COLUMNS if c in view.columns],
        "collected_at_ts",
        C.dedup_hash(*_IDENTITY_COLUMNS).alias("dedup_hash"),
        (F.unix_micros("collected_at_ts") / F.lit(1e6)).alias("score"),
    )


def _newest_first() -> list[Column]:
    # Score first; the remaining keys only make ties deterministic.
    return [F.col("collected_at_ts").desc(), F.col("dedup_hash").desc(), F.col("trip_id").desc(),
            F.col("line_id").desc_nulls_last(), F.col("direction").desc_nulls_last(),
            F.col("planned_departure").desc_nulls_last(), F.col("platform").desc_nulls_last()]


def recent_departures(records: DataFrame, k: int = RECENT_DEPARTURES_PER_STATION) -> DataFrame:
    """The newest k distinct departures per station.

    A list is a set of members: a member delivered again takes no second slot.
    The rank is dense over an order on every payload column, so repeats share
    theirs. `dense_rank() <= k` is planned as a window-group limit: each map
    task keeps k members per station before the shuffle, so a station holding
    a third of all rows still sends only those.
    """
    order = _newest_first() + [F.col(c).desc_nulls_last() for c in PAYLOAD_COLUMNS if c in records.columns]
    w = Window.partitionBy("station_id").orderBy(*order)
    top = records.withColumn("rank", F.dense_rank().over(w)).filter(F.col("rank") <= k)
    return top.dropDuplicates(["station_id", "rank"])


def exact_dedup(records: DataFrame) -> DataFrame:
    """Identical stored members kept once (set semantics).

    The member is hash + full payload, which includes collected_at, so repeat
    polls of one departure are *not* merged (Q4).
    """
    cols = [c for c in records.columns if c != "score"]
    return records.dropDuplicates(cols)


def not_stored(records: DataFrame, stored: DataFrame) -> DataFrame:
    """Those of `records` whose member (hash + full payload) is not among the `stored` ones."""
    cols = [c for c in [*PAYLOAD_COLUMNS, "dedup_hash"] if c in records.columns]
    have = stored.select(*[F.col(c).alias(f"_{c}") for c in cols])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]
    return records.join(have, same, "left_anti")


def latest_per_hash(records: DataFrame) -> DataFrame:
    """The intended dedup, one row per departure identity, newest poll wins.

    Keyed on the identity columns themselves: the 8 displayed hash digits
    collide between departures of a busy station.
    """
    w = Window.partitionBy(*_IDENTITY_COLUMNS).orderBy(*_newest_first())
    return records.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def live_departures(records: DataFrame, as_of, ttl_seconds: int = DEPARTURES_TTL_SECONDS,
                    k: int = RECENT_DEPARTURES_PER_STATION) -> DataFrame:
    """A station's whole list expires ttl after its last write; newest k of what lives.

    Write time is the row's collection time (writes are immediate in replay).
    A silence of ttl or longer ended the list before it, so rows older than the
    last such gap stay gone. The newest k come first: the newest row is the last
    write, and the gaps between the k newest members decide for all of them.
    """
    top = recent_departures(records, k)
    w = Window.partitionBy("station_id").orderBy(F.col("rank"))
    newer = F.coalesce(F.lag("collected_at_ts").over(w), _lit_ts(as_of))
    lapsed = F.when(F.col("collected_at_ts") <= newer - _secs(ttl_seconds), 1).otherwise(0)
    gone = F.max("_lapsed").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return top.withColumn("_lapsed", lapsed).withColumn("_gone", gone).filter("_gone = 0").drop("_lapsed", "_gone")
