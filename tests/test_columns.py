import hashlib

from pyspark.sql import functions as F

from railyard.functions import columns as C


def test_c5_flags(spark):
    df = spark.createDataFrame([(2.0,), (2.0000001,), (5.0,), (5.0000001,), (-1.0,), (None,)], "d double")
    got = [tuple(r) for r in df.select(C.is_delayed("d"), C.is_on_time("d"), C.is_significant_delay("d")).collect()]
    assert got == [(0, 1, 0), (1, 0, 0), (1, 0, 0), (1, 0, 1), (0, 1, 0), (0, 0, 0)]


def test_c12_delay_category_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (5.0,), (10.0,), (10.1,), (-3.0,)], "d double")
    got = [r[0] for r in df.select(C.delay_category("d")).collect()]
    assert got == ["On Time", "Minor Delay", "Moderate Delay", "Major Delay", "Severe Delay", "On Time"]


def test_c13_status(spark):
    df = spark.createDataFrame([(2.0, 80.0), (5.0, 60.0), (1.9, 80.1)], "d double, p double")
    got = [tuple(r) for r in df.select(C.delay_status("d"), C.performance_status("p")).collect()]
    assert got == [("yellow", "yellow"), ("red", "red"), ("green", "green")]


def test_c14_dedup_hash_matches_python_md5_with_none(spark):
    rows = [("900000001", "2024-01-01T10:00:00+00:00", "Dir 0", "U2", None),
            ("900000001", "2024-01-01T10:00:00+00:00", "Dir 0", "U2", "3")]
    df = spark.createDataFrame(rows, "s string, p string, d string, l string, pl string")
    got = [r[0] for r in df.select(C.dedup_hash("s", "p", "d", "l", "pl")).collect()]
    want = [hashlib.md5(f"{s}:{p}:{d}:{l}:{pl}".encode()).hexdigest()[:8] for s, p, d, l, pl in rows]
    assert got == want


def test_c20_transport_mode(spark):
    df = spark.createDataFrame([("SUBURBAN",), ("zeppelin",), ("Bus",), (None,)], "p string")
    got = [r[0] for r in df.select(C.transport_mode("p")).collect()]
    assert got == ["suburban", "not defined", "bus", "not defined"]


def test_p3_p4_c21_cancelled_counts_as_on_time(spark):
    df = spark.createDataFrame([(None, None, "2024-01-01T10:00:00+00:00")], "delay int, w string, pw string")
    r = df.select(C.delay_minutes("delay").alias("m"), C.actual_departure("w", "pw").alias("a")).first()
    assert r["m"] == 0.0 and r["a"] == "2024-01-01T10:00:00+00:00"
    assert df.select(C.is_on_time(C.delay_minutes("delay"))).first()[0] == 1


def test_c3_parse_never_raises(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T11:00:00+01:00",),
                                ("2024-01-01T10:00:00.123456+00:00",), ("garbage",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(F.unix_micros(C.parse_ts("t"))).collect()]
    assert got[0] == got[1] == 1704103200000000
    assert got[2] == 1704103200123456
    assert got[3:] == [None, None, None]


def test_round_dp_half_up_on_decimal(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(C.round_dp("x", 2)).collect()]
    assert got == [2.68, 1.01, -0.13, None]



def test_spread_only_when_scan_has_too_few_splits(spark):
    from railyard.sources.fixtures import read_table, spread
    ev = read_table(spark, "/root/testdata/sf0.001", "events")
    want = spark.sparkContext.defaultParallelism
    assert ev.rdd.getNumPartitions() < want
    assert spread(ev).rdd.getNumPartitions() == want
    wide = spark.range(0, 1000, numPartitions=want * 2)
    assert spread(wide) is wide                       # enough splits: no shuffle added
