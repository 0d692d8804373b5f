from pyspark.sql import functions as F

from railyard.operators import enrich as EN
from railyard.operators import metrics as M
from railyard.operators import store as ST

from helpers import BASE, dep, enriched, flat_df, minutes, records


def test_c1_malformed_or_null_value_dropped(spark):
    good = records(spark, [dep()])
    bad = spark.createDataFrame([(b"900000001", b"not json"), (b"900000001", None)], "key binary, value binary") \
        .withColumn("timestamp", F.current_timestamp())
    out = EN.enrich(EN.decode_envelopes(good.unionByName(bad)), watermark=None)
    assert out.count() == 1


def test_c2_null_ids_dropped(spark):
    rows = [dep(trip=None), dep(station=None), dep(line=None), dep()]
    assert enriched(spark, rows).count() == 1


def test_c3_bad_collected_at_dropped_without_error(spark):
    rows = [dep(collected="garbage"), dep(collected=""), dep(collected=None), dep()]
    assert enriched(spark, rows).count() == 1


def test_c4_null_delay_kept_flags_zero(spark):
    e = enriched(spark, [dep(delay=None), dep(trip="t2", delay=3.0)])
    m = M.station_window_metrics(e, exact=True).first()
    assert m["total_records"] == 2
    assert m["avg_delay"] == 3.0 and m["max_delay"] == 3.0
    assert (m["delayed_departures"], m["on_time_departures"]) == (1, 0)


def test_nan_delay_is_missing(spark):
    rows = [dep(delay=float("nan"))]
    e = enriched(spark, rows).first()
    assert e["delay_minutes"] is None and e["is_delayed"] == 0


def test_roundtrip_keeps_nulls(spark):
    rows = [dep(platform=None, lat=None, delay=None), dep(trip="t2")]
    flat = flat_df(spark, rows)
    back = EN.decode_envelopes(EN.encode_envelopes(flat)).drop("kafka_key", "kafka_timestamp", "event_type")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, flat.collect()))
    text = EN.encode_envelopes(flat).select(F.col("value").cast("string")).first()[0]
    assert '"platform":null' in text


def test_c8_repeat_polls_exceed_100_percent(spark):
    rows = [dep(trip="t1", delay=4.0, collected=BASE + minutes(i)) for i in range(3)]
    m = M.round_metrics(M.station_window_metrics(enriched(spark, rows), exact=True)).first()
    assert (m["total_departures"], m["total_records"], m["delay_pct"]) == (1, 3, 300.0)


def test_window_bounds_epoch_aligned(spark):
    e = enriched(spark, [dep(collected=BASE + minutes(22))])
    m = M.station_window_metrics(e, exact=True).first()
    assert m["window_start"].minute == 15 and m["window_end"].minute == 30


def test_c6_c7_not_storable(spark):
    rows = [dep(delay=None, station="900000002"), dep(name=None, station="900000003"), dep()]
    m = M.storable(M.round_metrics(M.station_window_metrics(enriched(spark, rows), exact=True)))
    assert [r["station_id"] for r in m.collect()] == ["900000001"]


def test_c18_name_collision_last_write_deterministic(spark):
    rows = [dep(name="A"), dep(name="A", trip="t2"), dep(name="B", trip="t3")]
    m = M.round_metrics(M.station_window_metrics(enriched(spark, rows), exact=True))
    assert m.count() == 2
    snap = ST.metric_rows(m, 0, F.current_timestamp())
    cur = ST.current_metrics(snap, as_of=None).collect()
    assert len(cur) == 1 and cur[0]["station_name"] == "A"     # more records wins


def test_sliding_windows_cover_each_row_five_times(spark):
    e = enriched(spark, [dep(collected=BASE + minutes(2.5))])
    m = M.station_window_metrics(e, "5 minutes", "1 minute", exact=True)
    assert m.count() == 5 and m.agg(F.sum("total_records")).first()[0] == 5


def test_properties_on_fixture(spark):
    from railyard.plans import catalog as K
    e = K.enriched_rows(spark, "/root/testdata/sf0.001")
    m = M.station_window_metrics(e, exact=True)
    g = e.groupBy(F.window("collected_at_ts", "15 minutes"), "station_id", "station_name").agg(
        F.sum("is_on_time").alias("on"), F.sum("is_delayed").alias("dl"),
        F.count_if(F.col("delay_minutes").isNull()).alias("n"), F.count(F.lit(1)).alias("total"))
    assert g.filter(F.col("on") + F.col("dl") + F.col("n") != F.col("total")).count() == 0
    assert m.filter(F.col("max_delay") < F.col("avg_delay")).count() == 0


def test_approx_distinct_within_tolerance(spark):
    from railyard.plans import catalog as K
    e = K.enriched_rows(spark, "/root/testdata/sf0.01")
    keys = ["station_id", "station_name", "window_start", "latitude", "longitude"]
    ex = M.station_window_metrics(e, exact=True).select(*keys, F.col("total_departures").alias("x"))
    ap = M.station_window_metrics(e, exact=False).select(*keys, F.col("total_departures").alias("a"))
    cond = [ex[k].eqNullSafe(ap[k]) for k in keys]
    j = ex.join(ap, cond)
    assert j.count() == ex.count()
    assert j.filter(F.abs(F.col("x") - F.col("a")) > 5).count() == 0


def test_sliding_windows_count_each_trip_once_without_a_row_per_window(spark):
    """Against a count per window: trips and lines that come back, a slide that does not divide the window, null names, before 1970."""
    from datetime import datetime, timezone
    early = datetime(1969, 12, 31, 23, 55, tzinfo=timezone.utc)
    rows = [dep(trip=f"t{i * i % 5}", line=f"l{i % 3}", name=None if i % 4 == 0 else "n", delay=float(i % 9), collected=at + minutes(i * 0.7))
            for at in (BASE, early) for i in range(30)]
    e = enriched(spark, rows + rows[:3])
    for window, slide in (("5 minutes", "1 minute"), ("5 minutes", "2 minutes"), ("4 minutes", "4 minutes")):
        plain = e.groupBy(F.window("collected_at_ts", window, slide).alias("w"), "station_name").agg(
            F.count_distinct("trip_id"), F.count_distinct("line_id"), F.count(F.lit(1)), F.max("delay_minutes"), F.round(F.avg("delay_minutes"), 9),
            F.sum("is_delayed"), F.max("collected_at_ts")).select("w.start", "w.end", "*").drop("w")
        m = M.station_window_metrics(e, window, slide, exact=True, with_last_seen=True)
        got = m.select("window_start", "window_end", "station_name", "total_departures", "unique_lines", "total_records", "max_delay",
                       F.round("avg_delay", 9), "delayed_departures", "last_seen")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
