from pyspark.sql import functions as F

from railyard.operators import enrich as EN
from railyard.operators import rollup as R
from railyard.operators import store as ST
from railyard.plans import board as B
from railyard.schemas import METRICS_TABLE

from helpers import BASE, dep, enriched, minutes


def _metrics(spark, rows):
    """rows: (station, window_start, avg, max, trips, delayed, on_time, lat, name)."""
    data = []
    for st, ws, avg, mx, trips, dl, on, lat, name in rows:
        data.append((st, name, ws, ws + minutes(15), avg, mx, trips, dl, on, 0, trips, 1,
                     None, None, lat, 13.4))
    df = spark.createDataFrame(data, METRICS_TABLE)
    return df.withColumn("updated_at", F.col("window_end"))


def test_c9_c10_clamp_and_rescale(spark):
    m = _metrics(spark, [("a", BASE, 4.0, 6.0, 1, 3, 0, 52.5, "A"),
                         ("b", BASE, 1.0, 2.0, 2, 2, 2, 52.5, "B")])
    r = {x["station_id"]: x for x in R.station_rollup(m).collect()}
    assert r["a"]["delay_pct"] == 100.0 and r["a"]["on_time_pct"] == 0.0
    assert (r["b"]["on_time_pct"], r["b"]["delay_pct"]) == (50.0, 50.0)


def test_weighted_mean_and_latest_attributes(spark):
    m = _metrics(spark, [("a", BASE, 2.0, 3.0, 1, 0, 1, 52.5, "Old"),
                         ("a", BASE + minutes(15), 4.0, 9.0, 3, 3, 0, 52.6, "New"),
                         ("a", BASE + minutes(30), None, None, 5, 0, 0, 52.7, "Newest")])
    r = R.station_rollup(m).first()
    assert r["avg_delay"] == 3.5 and r["max_delay"] == 9.0 and r["total_departures"] == 4
    assert r["windows_count"] == 2 and r["station_name"] == "Newest" and r["lat"] == 52.7
    assert r["window_end"] == (BASE + minutes(15)).replace(tzinfo=None)   # latest valid window *start* (Q7)


def test_c11_zero_latitude_left_out(spark):
    m = _metrics(spark, [("a", BASE, 1.0, 1.0, 1, 0, 1, 0.0, "A"), ("b", BASE, 1.0, 1.0, 1, 0, 1, 52.5, "B")])
    assert [r["station_id"] for r in R.station_rollup(m).collect()] == ["b"]


def test_v6_empty_input_gives_empty_outputs(spark):
    empty = _metrics(spark, []).limit(0)
    roll = R.station_rollup(empty)
    for df in (roll, B.network_kpis(roll), B.leaders(roll), B.station_table(roll),
               B.map_markers(roll), B.coverage(roll, 15)):
        assert df.count() == 0


def test_leaders_ties_go_to_smallest_id(spark):
    m = _metrics(spark, [("b", BASE, 1.0, 1.0, 5, 0, 5, 52.5, "B"), ("a", BASE, 1.0, 1.0, 5, 0, 5, 52.5, "A")])
    got = {r["role"]: r["station_id"] for r in B.leaders(R.station_rollup(m)).collect()}
    assert got == {"best": "a", "worst": "a", "busiest": "a"}


def test_ttl_and_index(spark):
    m = _metrics(spark, [("a", BASE, 1.0, 1.0, 1, 0, 1, 52.5, "A"),
                         ("a", BASE + minutes(180), 1.0, 1.0, 1, 0, 1, 52.5, "A")])
    snap = ST.metric_rows(m, 0, F.col("updated_at"))
    as_of = BASE + minutes(200)
    assert ST.current_metrics(snap, as_of).count() == 1          # first window expired (2 h TTL)
    assert ST.station_index(snap, as_of).count() == 1
    assert ST.station_index(snap, BASE + minutes(500)).count() == 0   # whole index expired
    assert ST.recent_metrics(snap, as_of, minutes_back=15).count() == 0   # start < as_of - 15
    assert ST.recent_metrics(snap, as_of, minutes_back=30).count() == 1


def test_c15_top50_evicts_oldest(spark):
    rows = [dep(trip=f"t{i:02d}", collected=BASE + minutes(i)) for i in range(51)]
    rec = ST.departure_records(EN.departure_view(enriched(spark, rows)))
    top = ST.recent_departures(rec, 50)
    assert top.count() == 50
    assert top.filter(F.col("trip_id") == "t00").count() == 0


def test_c16_repeat_polls_kept_intended_dedup_keeps_one(spark):
    rows = [dep(collected=BASE, planned=BASE), dep(collected=BASE + minutes(1), planned=BASE),
            dep(collected=BASE + minutes(1), planned=BASE)]
    rec = ST.departure_records(EN.departure_view(enriched(spark, rows)))
    assert ST.exact_dedup(rec).count() == 2          # identical member only once
    latest = ST.latest_per_hash(rec).select(F.unix_seconds("collected_at_ts").alias("t")).collect()
    assert [r["t"] for r in latest] == [int((BASE + minutes(1)).timestamp())]


def test_live_departures_ttl(spark):
    rows = [dep(station="900000001", collected=BASE), dep(station="900000002", collected=BASE + minutes(90))]
    rec = ST.departure_records(EN.departure_view(enriched(spark, rows)))
    live = ST.live_departures(rec, BASE + minutes(100), ttl_seconds=3600)
    assert [r["station_id"] for r in live.collect()] == ["900000002"]


def test_redelivered_departures_take_no_slot(spark):
    rows = [dep(trip=f"t{i}", collected=BASE + minutes(i)) for i in range(50)]
    rec = ST.departure_records(EN.departure_view(enriched(spark, rows + rows[:25])))
    top = ST.recent_departures(rec, 50)
    assert top.count() == 50 and top.select("trip_id").distinct().count() == 50


def test_live_departures_drop_what_lay_before_a_silence(spark):
    rows = [dep(trip="old", collected=BASE), dep(trip="edge", collected=BASE + minutes(240)),
            dep(trip="new", collected=BASE + minutes(300)), dep(trip="newer", collected=BASE + minutes(359))]
    rec = ST.departure_records(EN.departure_view(enriched(spark, rows)))
    live = ST.live_departures(rec, BASE + minutes(360), ttl_seconds=3600)
    assert {r["trip_id"] for r in live.collect()} == {"new", "newer"}


def test_typed_and_text_times_give_one_hash(spark):
    from helpers import flat_df
    flat = flat_df(spark, [dep(planned=BASE), dep(planned=BASE + minutes(0.5))])
    typed = flat.withColumn("planned_departure", F.to_timestamp("planned_departure"))
    hashes = [{r["dedup_hash"] for r in ST.departure_records(EN.departure_view(EN.enrich(
        EN.decode_envelopes(EN.encode_envelopes(x)), watermark=None))).collect()} for x in (flat, typed)]
    assert hashes[0] == hashes[1] and len(hashes[0]) == 2


def test_top50_plan_limits_before_shuffle(spark):
    from railyard.plans import catalog as K
    df = ST.recent_departures(K.departure_records(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rollup_percentages_bounded_on_fixture(spark):
    from railyard.plans import catalog as K
    r = K.rollup_all(spark, "/root/testdata/sf0.01")
    assert r.filter(F.col("on_time_pct") + F.col("delay_pct") > 100.0001).count() == 0
    assert ST.recent_departures(K.departure_records(spark, "/root/testdata/sf0.01")) \
        .groupBy("station_id").count().filter("count > 50").count() == 0
