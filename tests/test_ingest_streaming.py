import json

from pyspark.sql import functions as F

from railyard.operators import ingest as IN
from railyard.session import new_work_dir
from railyard.sources import fixtures as FX
from railyard.sources import responses as RS
from railyard.streaming import jobs as J
from railyard.plans import streams as SM

from helpers import BASE, dep, flat_df, minutes


def _raw(trip="t1", lat=52.5, direction="Dir 0", product="subway", planned="2024-01-01T10:00:00+00:00"):
    return {"tripId": trip,
            "stop": {"type": "stop", "id": "900000001", "name": "S1",
                     "location": {"type": "location", "id": "900000001", "latitude": lat, "longitude": 13.4},
                     "products": {"subway": True}},
            "when": None, "plannedWhen": planned, "delay": None, "platform": None,
            "plannedPlatform": "1", "direction": direction,
            "line": {"type": "line", "id": "U2", "name": "U2", "mode": "train", "product": product},
            "cancelled": True}


def _responses(spark, resp):
    path = new_work_dir(spark, "responses")
    spark.sparkContext.parallelize([json.dumps(r) for r in resp], 1).saveAsTextFile(path)
    return RS.read_responses(spark, path)


def test_c19_bad_record_dropped_alone(spark):
    resp = [{"requested_station_id": "900000001", "fetched_at": "2024-01-01T10:00:00Z",
             "departures": [_raw("ok"), _raw("lat", lat=91.0), _raw("dir", direction=None),
                            _raw("prod", product=None), _raw("time", planned="soon")]}]
    df = _responses(spark, resp)
    flat = IN.flatten_departures(df).collect()
    assert [r["trip_id"] for r in flat] == ["ok"]
    assert flat[0]["transport_mode"] == "subway" and flat[0]["delay_minutes"] == 0.0
    assert flat[0]["actual_departure"] == flat[0]["planned_departure"]      # C21
    reasons = {r["trip_id"]: r["reason"] for r in IN.quarantine(df).collect()}
    assert reasons == {"lat": "latitude: out of range", "dir": "direction: missing",
                       "prod": "line.product: missing", "time": "plannedWhen: not a time"}


def test_fl3_mistyped_values_reject_the_record_alone(spark):
    def bad(name, **kw):
        return dict(_raw(name), **kw)
    no_products = _raw("products")
    del no_products["stop"]["products"]
    resp = [{"requested_station_id": "900000001", "fetched_at": "2024-01-01T10:00:00Z", "departures": [
        bad("text", delay="abc"), bad("fraction", delay=60.5), bad("huge", delay=1e12), bad("nan", delay="NaN"),
        bad("flag", cancelled="maybe"), no_products,
        bad("plain", delay=90, cancelled=False), bad("quoted", delay="-60", cancelled="off"), bad("float", delay=120.0)]}]
    df = _responses(spark, resp)
    flat = {r["trip_id"]: (r["delay_minutes"], r["cancelled"]) for r in IN.flatten_departures(df).collect()}
    assert flat == {"plain": (1.5, False), "quoted": (-1.0, False), "float": (2.0, True)}
    reasons = {r["trip_id"]: r["reason"] for r in IN.quarantine(df).collect()}
    assert reasons == {**dict.fromkeys(("text", "fraction", "huge", "nan"), "delay: not a whole number"),
                       "flag": "cancelled: not a flag", "products": "stop.products: missing"}
    q = IN.ingest_quality(df).first()
    assert (q["records_found"], q["records_parsed"]) == (9, 3)


def test_fl3_missing_null_and_mistyped_are_told_apart(spark):
    """Records as the API may send them: each member missing, null, or of another type."""
    def with_(name, path, value):
        r = json.loads(json.dumps(_raw(name)))
        at = r
        *inner, last = path.split(".")
        for k in inner:
            at = at[k]
        if value is ...:
            at.pop(last, None)
        else:
            at[last] = value
        return r
    cases = {  # path: value -> reason, or None where the record is valid
        "tripId": {5: "tripId: not text"},
        "cancelled": {None: "cancelled: not a flag", ...: None, 1: None, "Yes": None, 0.0: None, 2: "cancelled: not a flag"},
        "stop.products.bus": {None: "stop.products: not a flag", ...: None, "maybe": "stop.products: not a flag", "off": None},
        "stop.products": {None: "stop.products: missing", ...: "stop.products: missing", "bus": "stop.products: not a record"},
        "stop": {"S1": "stop: not a record", ...: "stop: missing"},
        "stop.type": {...: None, None: "stop.type: not text"},
        "stop.name": {7: "stop.name: not text", None: "stop.name: missing"},
        "stop.location.latitude": {"52.5": None, "north": "latitude: not a number", None: "latitude: missing", ...: "latitude: missing"},
        "when": {None: None, ...: None, "later": "when: not a time", 1704103200: None},
        "plannedWhen": {...: "plannedWhen: missing", 1704103200: None, True: "plannedWhen: not a time"},
        "delay": {None: None, ...: None, "x": "delay: not a whole number", True: None},
        "platform": {3: "platform: not text", None: None, ...: None, "": None},
        "line.product": {...: "line.product: missing", 1: "line.product: not text"},
        "line": {None: "line: missing"},
    }
    sent, want = ["no record at all", 5], {}
    for path, values in cases.items():
        for k, (value, reason) in enumerate(values.items()):
            name = f"{path}-{k}" if path != "tripId" else value
            sent.append(with_(name, path, value))
            want[str(name)] = reason
    df = _responses(spark, [{"requested_station_id": "900000001", "fetched_at": "2024-01-01T10:00:00Z", "departures": sent}])
    bad = IN.quarantine(df).collect()
    assert {r["trip_id"]: r["reason"] for r in bad if r["trip_id"]} == {k: v for k, v in want.items() if v}
    assert [r["reason"] for r in bad if not r["trip_id"]] == ["not a record"] * 2
    flat = {r["trip_id"]: r for r in IN.flatten_departures(df).collect()}
    assert set(flat) == {k for k, v in want.items() if not v}
    assert flat["plannedWhen-1"]["planned_departure"] == flat["when-3"]["actual_departure"] == BASE.replace(tzinfo=None)
    assert flat["delay-3"]["delay_minutes"] == 1 / 60 and flat["cancelled-1"]["cancelled"] is False
    q = IN.ingest_quality(df).first()
    assert (q["records_found"], q["records_parsed"]) == (len(sent), len(flat))


def test_c22_zero_parsed_is_failed_poll(spark):
    resp = [{"requested_station_id": "900000001", "fetched_at": "2024-01-01T10:00:01Z",
             "departures": [_raw("ok")]},
            {"requested_station_id": "900000002", "fetched_at": "2024-01-01T10:00:02Z",
             "departures": [_raw("bad", lat=99.0)]}]
    df = _responses(spark, resp)
    st = spark.createDataFrame([("900000001", True), ("900000002", True), ("900000003", False)],
                               "station_id string, enabled boolean")
    s = IN.ingest_cycle_summary(df, st).first()
    assert (s["stations_polled"], s["stations_ok"], s["stations_failed"]) == (2, 1, 1)
    assert s["duration_sec"] == 1.0
    q = {r["requested_station_id"]: (r["records_found"], r["records_parsed"])
         for r in IN.ingest_quality(df).collect()}
    assert q == {"900000001": (1, 1), "900000002": (1, 0)}


def test_responses_json_roundtrip(spark):
    obs = FX.observations(spark, "/root/testdata/sf0.001")
    resp = RS.responses_from_observations(obs)
    path = new_work_dir(spark, "resp")
    RS.write_responses(resp, path)
    back = RS.read_responses(spark, path)
    assert back.count() == resp.count()
    assert IN.flatten_departures(back).count() == obs.count()


def test_enabled_only_semi_join_broadcasts(spark):
    flat = FX.flat_departures(FX.observations(spark, "/root/testdata/sf0.001"))
    out = IN.enabled_only(flat, FX.stations(spark))
    assert out.filter(F.col("station_id").isin("900000010", "900000011")).count() == 0
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString() or \
        "BroadcastHashJoin" in out._jdf.queryExecution().toString()


def test_enabled_only_defaults_to_the_configured_stations(spark):
    rows = spark.createDataFrame([("900100003",), ("900000001",), (None,)], "station_id string")
    assert [r.station_id for r in IN.enabled_only(rows).collect()] == ["900100003"]


def test_c17_late_row_dropped_from_metrics_kept_in_departures(spark):
    dirs = J.StreamDirs.fresh(spark, "late-unit")
    batches = [[dep(trip="a", collected=BASE)],                              # 10:00
               [dep(trip="b", collected=BASE + minutes(30))],                # watermark -> 10:20
               [dep(trip="late", collected=BASE + minutes(5)),               # window 10:00-10:15 closed
                dep(trip="open", collected=BASE + minutes(31))]]
    progress = []
    for rows in batches:
        SM.publish(flat_df(spark, rows), dirs)
        for q in J.run_available_now(spark, dirs):
            progress.extend(q.recentProgress)
    deps = {r["trip_id"] for r in J.read_departures(spark, dirs).collect()}
    assert deps == {"a", "b", "late", "open"}
    cur = SM._latest_metrics(spark, dirs).collect()
    by_start = {r["window_start"].minute: r["total_records"] for r in cur}
    assert by_start == {0: 1, 30: 2}
    dropped = sum(o["numRowsDroppedByWatermark"] for p in progress for o in p.get("stateOperators", []))
    assert dropped >= 1


def test_restart_resumes_from_checkpoint(spark):
    dirs = J.StreamDirs.fresh(spark, "restart-unit")
    SM.publish(flat_df(spark, [dep(trip="a", collected=BASE)]), dirs)
    J.run_available_now(spark, dirs)
    SM.publish(flat_df(spark, [dep(trip="b", collected=BASE + minutes(1))]), dirs)
    J.run_available_now(spark, dirs)
    # a third run with nothing new must not re-process anything
    J.run_available_now(spark, dirs)
    assert J.read_departures(spark, dirs).count() == 2
    cur = SM._latest_metrics(spark, dirs).collect()
    assert len(cur) == 1 and cur[0]["total_records"] == 2
    audit = J.read_audit(spark, dirs).filter("query = 'departures'").agg(F.sum("rows_read")).first()[0]
    assert audit == 2


def test_stream_hll_counts_close_to_exact(spark):
    from railyard.plans import catalog as K
    from railyard.operators import metrics as M
    sf = "/root/testdata/sf0.01"
    ap = SM.stream_station_metrics_approx(spark, sf)
    ex = M.storable(M.round_metrics(M.station_window_metrics(K.enriched_rows(spark, sf), exact=True))).select(
        "station_id", "window_start", F.col("total_departures").alias("x"))
    j = ap.join(ex, ["station_id", "window_start"])
    assert j.count() == ap.count() > 0
    assert j.filter(F.abs(F.col("x") - F.col("total_departures")) > 5).count() == 0


def test_replay_bounds_and_lifecycle(spark):
    from railyard.streaming import topic as TP
    dirs = J.StreamDirs.fresh(spark, "replay-unit")
    SM.publish(flat_df(spark, [dep(trip="a"), dep(trip="b")]), dirs)
    assert TP.replay(spark, path=dirs.topic).count() == 2
    assert TP.replay(spark, path=dirs.topic, end="2000-01-01 00:00:00").count() == 0
    qs = J.start(spark, dirs, departures_trigger="availableNow", which=("departures",))
    J.run(spark, qs)                     # T18: returns when the query ends, nothing left active
    assert all(not q.isActive for q in qs)
    assert J.read_departures(spark, dirs).count() == 2


def test_clock_column_and_station_history(spark):
    from railyard.operators import enrich as EN
    from railyard.operators import store as ST
    from railyard.operators import metrics as M
    from helpers import records
    e = EN.enrich(EN.decode_envelopes(records(spark, [dep(), dep(station="900000002")])),
                  with_clock=True, watermark=None)
    assert e.filter(F.col("current_time").isNull()).count() == 0
    snap = ST.metric_rows(M.round_metrics(M.station_window_metrics(e, exact=True)), 0, F.col("window_end"))
    h = ST.station_history(snap, "900000002", BASE + minutes(10), minutes_back=15).collect()
    assert [r["station_id"] for r in h] == ["900000002"]


def test_entry_a_ingest_stream_feeds_processing(spark):
    """responses (JSON files) -> ingest stream -> topic -> departures + metrics streams."""
    from railyard.streaming import ingest_job as IJ
    from railyard.plans import catalog as K
    from railyard.operators import metrics as M
    sf = "/root/testdata/sf0.001"
    obs = FX.perturb_for_validation(FX.observations(spark, sf))
    resp_dir = new_work_dir(spark, "responses-in")
    RS.write_responses(RS.responses_from_observations(obs), resp_dir)
    dirs = J.StreamDirs.fresh(spark, "entry-a")
    IJ.run_ingest_available_now(spark, resp_dir, dirs, FX.stations(spark))
    J.run_available_now(spark, dirs)
    want = IN.flatten_departures(K.polled_responses(spark, sf))
    assert J.read_departures(spark, dirs).count() == want.count()
    assert spark.read.parquet(IJ.quarantine_dir(dirs)).count() == IN.quarantine(K.polled_responses(spark, sf)).count()
    got = SM._latest_metrics(spark, dirs).agg(F.sum("total_records")).first()[0]
    assert got == want.count()


def test_entry_c_board_over_streamed_store(spark):
    from railyard.plans import board as B
    dirs = J.StreamDirs.fresh(spark, "board-unit")
    rows = [dep(trip=f"t{i}", station=f"90000000{i % 3}", delay=float(i % 7), collected=BASE + minutes(i))
            for i in range(30)]
    SM.publish(flat_df(spark, rows), dirs)
    J.run_available_now(spark, dirs)
    views = B.board_views(J.read_metrics_changelog(spark, dirs), BASE + minutes(30), minutes_back=60)
    assert views["rollup"].count() == 3
    assert views["network_kpis"].first()["active_stations"] == 3
    assert views["leaders"].count() == 3 and views["station_table"].count() == 3
    cov = views["coverage"].first()
    assert (cov["expected_windows"], cov["min_windows"], cov["max_windows"]) == (4, 2, 2)


def test_metrics_compaction_keeps_current_view(spark):
    dirs = J.StreamDirs.fresh(spark, "compact-unit")
    for i in range(3):
        rows = [dep(trip=f"t{i}{j}", collected=BASE + minutes(20 * i + j)) for j in range(3)]
        SM.publish(flat_df(spark, rows), dirs)
        J.run_available_now(spark, dirs, which=("metrics",))
    import railyard.operators.store as ST2
    want = ST2.current_metrics(J.read_metrics_changelog(spark, dirs), as_of=None)
    upto = J.compact_metrics(spark, dirs, as_of=None)
    got = ST2.current_metrics(J.read_metrics(spark, dirs), as_of=None)
    cols = ["station_id", "window_start", "total_records", "avg_delay"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    # one more delivery after the compaction is read from the changelog
    SM.publish(flat_df(spark, [dep(trip="late-t", collected=BASE + minutes(61))]), dirs)
    J.run_available_now(spark, dirs, which=("metrics",))
    got2 = ST2.current_metrics(J.read_metrics(spark, dirs), as_of=None)
    assert got2.count() == want.count() + 1 and upto >= 0


def test_compaction_of_expired_rows_stays_empty(spark):
    dirs = J.StreamDirs.fresh(spark, "compact-expired")
    SM.publish(flat_df(spark, [dep(trip="a"), dep(trip="b", collected=BASE + minutes(20))]), dirs)
    J.run_available_now(spark, dirs, which=("metrics",))
    assert J.read_metrics(spark, dirs).count() == 2
    late = BASE + minutes(60 * 24 * 365 * 50)
    upto = J.compact_metrics(spark, dirs, as_of=late)
    assert J.read_metrics(spark, dirs).count() == 0
    assert J.compact_metrics(spark, dirs, as_of=late) == upto


def test_sink_batch_retry_is_idempotent(spark):
    """A micro-batch re-run after a failure (e.g. a lost executor) replaces its output."""
    from helpers import enriched
    from railyard.operators import metrics as M
    dirs = J.StreamDirs.fresh(spark, "retry-unit")
    e = enriched(spark, [dep(trip="a"), dep(trip="b", collected=BASE + minutes(1))])
    dw, mw = J.departures_writer(dirs), J.metrics_writer(dirs)
    agg = M.station_window_metrics(e, exact=False)
    for _ in range(2):                   # same batch id twice
        dw(e, 0)
        mw(agg, 0)
    assert J.read_departures(spark, dirs).count() == 2
    assert J.read_recent_departures(spark, dirs).count() == 2
    assert J.read_metrics_changelog(spark, dirs).count() == 1
    assert J.read_audit(spark, dirs).count() == 2        # one row per (query, batch)


def test_sliding_windows_in_stream(spark):
    dirs = J.StreamDirs.fresh(spark, "sliding-unit")
    SM.publish(flat_df(spark, [dep(collected=BASE + minutes(2.5))]), dirs)
    J.run_available_now(spark, dirs, which=("metrics",), window="5 minutes", slide="1 minute")
    cur = SM._latest_metrics(spark, dirs)
    assert cur.count() == 5 and cur.agg(F.sum("total_records")).first()[0] == 5


def test_q14_cancelled_kept_by_default_excludable(spark):
    resp = [{"requested_station_id": "900000001", "fetched_at": "2024-01-01T10:00:00Z",
             "departures": [_raw("gone"), dict(_raw("runs"), cancelled=False)]}]
    df = _responses(spark, resp)
    assert {r["trip_id"] for r in IN.flatten_departures(df).collect()} == {"gone", "runs"}
    assert [r["trip_id"] for r in IN.flatten_departures(df, include_cancelled=False).collect()] == ["runs"]


def test_departures_are_taken_apart_once(spark):
    """Each rule of FL3 and each output column reads the members, none of them goes into the departure by path again."""
    import json
    good = {"tripId": "a", "stop": {"id": "s", "name": "n", "location": {"id": "s", "latitude": 1, "longitude": 2}, "products": {}},
            "plannedWhen": "2024-01-01T10:00:00Z", "direction": "d", "line": {"id": "l", "name": "l", "mode": "m", "product": "bus"}}
    bad = [{**good, "stop": 5}, {**good, "stop": None}, {k: v for k, v in good.items() if k != "line"}, 7, None, {**good, "tripId": None}, {**good, "delay": True}]
    text = json.dumps([good, *bad])
    df = spark.range(1).select(F.lit("s").alias("requested_station_id"), F.current_timestamp().alias("fetched_at"),
                               F.from_json(F.lit(text), "array<variant>").alias("departures"))
    assert [r["reason"] for r in IN.quarantine(df).collect()] == [
        "stop: not a record", "stop: missing", "line: missing", "not a record", "not a record", "tripId: missing"]
    assert sorted(r["delay_minutes"] for r in IN.flatten_departures(df).collect()) == [0.0, 1 / 60]
    plan = IN.flatten_departures(df)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "$.stop" not in above and "$.plannedWhen" not in above


def test_deliveries_are_dealt_from_one_pass(spark):
    """Every row goes to the delivery of its number, rows without one to none; the rows are made once, not for each delivery."""
    rows = [dep(trip=str(i), collected=BASE + minutes(i)) for i in range(4)] + [dep(trip="bad", collected="garbage")]
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    flat = flat_df(spark, rows)
    flat = flat.mapInArrow(count, flat.schema)
    number = lambda ts: F.when(ts.isNull(), 2).when(F.col("trip_id") == "3", None).otherwise(F.minute(ts) % 2)
    parts = SM._dealt(spark, flat, number, 4)
    assert [sorted(r["trip_id"] for r in p.collect()) for p in parts] == [["0", "2"], ["1"], ["bad"], []]
    assert all(p.columns == flat.columns for p in parts) and made.value == len(rows)
