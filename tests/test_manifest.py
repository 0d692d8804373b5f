"""Commit manifests: fresh checkpoints, failed attempts, retention, late folding."""

from pyspark.sql import functions as F

from railyard.operators import store as ST
from railyard.plans import catalog as K
from railyard.plans import streams as SM
from railyard.session import list_path
from railyard.streaming import jobs as J
from railyard.streaming import manifest as MF

from helpers import BASE, dep, enriched, flat_df, minutes

import pytest


def _deliver(spark, dirs, lo, hi, **kw):
    SM.publish(flat_df(spark, [dep(trip=f"t{i}", collected=BASE + minutes(i)) for i in range(lo, hi)]), dirs)
    J.run_available_now(spark, dirs, **kw)


def _on_fresh_checkpoint(dirs):
    """The same sink and topic, a checkpoint that knows nothing."""
    class Fresh(J.StreamDirs):
        def checkpoint(self, name):
            return f"{self.base}/fresh/{name}"
    return Fresh(dirs.base)


def test_fresh_checkpoint_on_an_old_sink_gives_no_duplicates(spark):
    dirs = J.StreamDirs.fresh(spark, "fresh")
    _deliver(spark, dirs, 0, 10)
    _deliver(spark, dirs, 10, 20)
    before = SM._latest_metrics(spark, dirs).select("station_id", "window_start", "total_records").collect()
    again = _on_fresh_checkpoint(dirs)
    J.run_available_now(spark, again)
    trips = [r.trip_id for r in J.read_departures(spark, dirs).collect()]
    assert sorted(trips) == sorted(f"t{i}" for i in range(20))
    assert SM._latest_metrics(spark, dirs).select("station_id", "window_start", "total_records").collect() == before
    _deliver(spark, again, 20, 25)  # and goes on from there
    assert J.read_departures(spark, dirs).count() == 25
    assert {r.trip_id for r in J.read_recent_departures(spark, dirs).collect()} == {f"t{i}" for i in range(25)}
    runs = {(r.run, r.run_no) for r in dirs.manifest("departures").commits(spark)}
    assert len(runs) == 2 and {n for _, n in runs} == {1, 2}


def test_a_new_run_s_metrics_win_over_the_old_run_s(spark):
    """Batch numbers restart with a checkpoint; the order of commits does not."""
    dirs = J.StreamDirs.fresh(spark, "order")
    for i in range(3):
        _deliver(spark, dirs, i, i + 1, which=("metrics",))
    J.run_available_now(spark, _on_fresh_checkpoint(dirs), which=("metrics",))
    cur = SM._latest_metrics(spark, dirs).collect()
    assert [r.total_records for r in cur] == [3] and cur[0].batch_id >= MF.RUN_STRIDE


def test_crash_between_write_and_publish_is_invisible(spark, monkeypatch):
    dirs = J.StreamDirs.fresh(spark, "crash")
    e = enriched(spark, [dep(trip="a"), dep(trip="b")])
    write = J.departures_writer(dirs)
    real = MF.Manifest.publish

    def crash(*a, **k):
        raise RuntimeError("lost")
    monkeypatch.setattr(MF.Manifest, "publish", crash)
    with pytest.raises(RuntimeError):
        write(e, 0)
    assert list_path(spark, dirs.departures) and J.read_departures(spark, dirs).count() == 0
    assert J.read_recent_departures(spark, dirs).count() == 0
    monkeypatch.setattr(MF.Manifest, "publish", real)
    write(e, 0)
    write(e, 0)  # published: not written again
    assert J.read_departures(spark, dirs).count() == 2
    assert len(dirs.manifest("departures").commits(spark)) == 1
    assert J.retire(spark, dirs) == 2  # what the crash left: rows and snapshot
    assert J.read_departures(spark, dirs).count() == 2


def test_readers_open_named_folders_only(spark):
    dirs = J.StreamDirs.fresh(spark, "named")
    _deliver(spark, dirs, 0, 3)
    enriched(spark, [dep(trip="x")]).write.parquet(f"{dirs.departures}/attempt=00001-000000000-stray")
    assert {r.trip_id for r in J.read_departures(spark, dirs).collect()} == {"t0", "t1", "t2"}


def test_retention_keeps_the_current_view(spark):
    dirs = J.StreamDirs.fresh(spark, "retire")
    for i in range(4):
        _deliver(spark, dirs, 20 * i, 20 * i + 3)
    key = ["station_id", "window_start", "total_records", "avg_delay"]
    view = lambda: sorted(map(tuple, ST.current_metrics(J.read_metrics(spark, dirs), as_of=None).select(*key).collect()))
    want, recent = view(), sorted(r.trip_id for r in J.read_recent_departures(spark, dirs).collect())
    J.compact_metrics(spark, dirs, as_of=None)
    batches = [r for r in dirs.manifest("metrics").commits(spark) if r.kind == "batch"]  # those without new data among them
    gone = J.retire(spark, dirs, keep_snapshots=1)
    assert gone == len(batches) + 3  # folded batches; all snapshots but the newest
    assert view() == want and J.read_departures(spark, dirs).count() == 12
    assert sorted(r.trip_id for r in J.read_recent_departures(spark, dirs).collect()) == recent
    assert J.retire(spark, dirs, keep_snapshots=1) == 0
    _deliver(spark, dirs, 100, 101)  # the run goes on after its manifest was folded
    J.run_available_now(spark, dirs)
    assert J.read_departures(spark, dirs).count() == 13 and len(view()) == len(want) + 1
    assert len(list_path(spark, f"{dirs.base}/manifest/metrics")) <= 3  # the fold and the commits since


def test_as_of_comes_from_the_commits(spark):
    dirs = J.StreamDirs.fresh(spark, "as-of")
    assert spark.range(1).select(J.event_time(spark, dirs)).first()[0] is None
    _deliver(spark, dirs, 0, 3)
    got = spark.range(1).select(F.unix_micros(J.event_time(spark, dirs))).first()[0]
    assert got == J.read_departures(spark, dirs).agg(F.max(F.unix_micros("collected_at_ts"))).first()[0]


def test_store_queries_do_not_decode_the_topic(spark):
    sf = "/root/testdata/sf0.001"
    plan = K.q_recent_metrics(spark, sf)._jdf.queryExecution().toString()
    assert "from_json" not in plan and "fixture-topic" not in plan
    assert K.metrics_store(spark, sf).count() > 0
    want = K.enriched_rows(spark, sf).agg(F.max(F.unix_micros("collected_at_ts"))).first()[0]
    assert spark.range(1).select(F.unix_micros(K.store_as_of(spark, sf))).first()[0] == want


# --- T10 on the stream -----------------------------------------------------------

def _arrive(spark, dirs, rows, at):
    from railyard.operators import enrich as EN
    from railyard.streaming import topic as TP
    TP.write_topic(EN.encode_envelopes(flat_df(spark, rows), record_ts=F.lit(at).cast("timestamp")), dirs.topic)
    (q,) = J.run_available_now(spark, dirs, which=("departures",), once_within="1 hour")
    return sum(o["numRowsTotal"] for p in q.recentProgress[-1:] for o in p["stateOperators"])


def test_redelivered_members_are_stored_once_and_state_is_bounded(spark):
    dirs = J.StreamDirs.fresh(spark, "once")
    first = [dep(trip="a"), dep(trip="b"), dep(trip="b")]  # twice in one batch
    _arrive(spark, dirs, first, "2024-01-01 10:00:00")
    # again after a restart, with one late by its collection time and a repeat poll (another member)
    _arrive(spark, dirs, [dep(trip="a"), dep(trip="old", collected=BASE - minutes(600)), dep(trip="a", collected=BASE + minutes(1))], "2024-01-01 10:30:00")
    assert sorted(r.trip_id for r in J.read_departures(spark, dirs).collect()) == ["a", "a", "b", "old"]
    _arrive(spark, dirs, [dep(trip="c")], "2024-01-01 20:00:00")
    kept = _arrive(spark, dirs, [dep(trip="d")], "2024-01-01 20:00:01")
    assert kept <= 2  # the members of the morning are forgotten
    assert J.read_departures(spark, dirs).count() == 6


def test_without_the_option_redeliveries_are_kept(spark):
    dirs = J.StreamDirs.fresh(spark, "twice")
    for _ in range(2):
        SM.publish(flat_df(spark, [dep(trip="a")]), dirs)
        J.run_available_now(spark, dirs, which=("departures",))
    assert J.read_departures(spark, dirs).count() == 2
    assert J.read_recent_departures(spark, dirs).count() == 1


# --- A22, T17: what a batch read, rejected and stored ---------------------------------

def test_audit_counts_rejected_rows(spark):
    from railyard.operators import enrich as EN
    from railyard.streaming import topic as TP
    dirs = J.StreamDirs.fresh(spark, "audit")
    good = [dep(trip="a"), dep(trip="b", collected=BASE + minutes(1))]
    bad = [dep(trip="c", line=None), dep(trip="d", collected="garbage"), dep(trip=None)]
    rows = EN.encode_envelopes(flat_df(spark, good + bad))
    junk = rows.limit(2).withColumn("value", F.lit("not json").cast("binary"))
    TP.write_topic(rows.unionByName(junk).coalesce(1), dirs.topic)
    J.run_available_now(spark, dirs, which=("departures",))
    (r,) = J.read_audit(spark, dirs).collect()
    assert (r.rows_read, r.rows_malformed, r.rows_rejected, r.rows_stored) == (7, 2, 5, 2)
    assert r.max_lag_sec > 0 and r.min_event_time < r.max_event_time
    assert J.read_departures(spark, dirs).count() == 2


def test_merged_sketches_keep_their_rank_error(spark):
    from railyard.operators import metrics as M
    rows = [dep(trip=f"t{i}", station=f"90000000{i % 2}", delay=None if i % 7 == 0 else float(i * 37 % 501), collected=BASE + minutes(i % 180))
            for i in range(3000)]
    e = enriched(spark, rows)
    sketches = M.delay_sketches(e)
    assert sketches.count() == 24 and sketches.agg(F.sum("records")).first()[0] == sum(r["delay_minutes"] is not None for r in rows)
    got = M.rank_bounds(e, M.merged_percentiles(sketches)).collect()
    assert len(got) == 6
    assert all(r.share_below <= r["quantile"] + K.RANK_ERROR and r.share_upto >= r["quantile"] - K.RANK_ERROR for r in got)
    nothing = M.delay_sketches(enriched(spark, [dep(delay=None)]))
    assert nothing.count() == 0 and M.merged_percentiles(nothing).count() == 0
