from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators.filters import FilterSpec
from gaugeloom.operators.inputs import InputConfig, normalise
from gaugeloom.operators.points import make_point
from gaugeloom.plans import coord
from gaugeloom.session import scratch_dir
from gaugeloom.streaming import landing, state
from helpers import SNAP, T0, points, snap

EVENTS = "id bigint, ts timestamp, kind string, v bigint"


def land(rows, path, *data):
    rows(EVENTS, *[(i, T0 + timedelta(seconds=s), k, v) for i, s, k, v in data]).coalesce(1).write.mode("append").parquet(path)


def as_points(df):
    return make_point(df, F.col("kind"), {"k": F.col("kind")}, {"v": F.col("v")}, F.col("ts"), source="t")


def test_points_of_a_stream_equal_the_static_ones(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    land(rows, path, (1, 0, "a", 1), (2, 1, "b", 2), (3, 2, "c", 3))
    cfg = InputConfig(name_prefix="p_", tags={"dc": "x"}, filter=FilterSpec(name_drop=["p_c"]), precision_ns=60 * 10**9)
    streamed = landing.drained(spark, normalise(as_points(landing.read_landing(spark, path, EVENTS)), cfg), "t")
    static = normalise(as_points(spark.read.parquet(path)), cfg)
    assert points(streamed) == points(static) and streamed.count() == 2
    assert [r.time_ns for r in streamed.collect()] == [int(T0.timestamp()) * 10**9] * 2


def test_reply_job_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "snaps")
    snap(spark, ["zk_a\t1\n", "bad\n"], "h:1").write.parquet(path)
    out = coord.mntr(landing.read_landing(spark, path, SNAP))
    assert points(landing.drained(spark, out.metrics, "m")) == [("zookeeper", {"server": "h", "port": "1"}, {"a": 1})]
    assert landing.drained(spark, out.errors, "e").count() == 1


def test_checkpoint_reads_each_file_once(spark, rows, tmp_path):
    path, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    land(rows, path, (1, 0, "a", 1))
    df = as_points(landing.read_landing(spark, path, EVENTS))
    for extra in ((2, 5, "b", 2), None):
        landing.stream_points(df, InputConfig(), out, mark).awaitTermination()
        if extra:
            land(rows, path, extra)
    assert [p[0] for p in points(spark.read.parquet(out))] == ["a", "b"]


def test_repeated_events_are_dropped(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    land(rows, path, (1, 0, "a", 1), (1, 0, "a", 1), (2, 1, "a", 1))
    land(rows, path, (1, 0, "a", 1), (3, 2, "a", 1))
    df = state.dedup(landing.read_landing(spark, path, EVENTS, files_per_batch=1), ["id"], "ts", "1 hour")
    assert sorted(r.id for r in landing.drained(spark, df, "d").collect()) == [1, 2, 3]


def test_sums_grow_over_batches(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    for i in range(3):
        land(rows, path, (i, i, "a", 10), (i, i, "b", i))
    df = landing.read_landing(spark, path, EVENTS, files_per_batch=1).select(
        F.lit("m").alias("measurement"), F.create_map(F.lit("k"), F.col("kind")).alias("tags"), F.lit("f").alias("field"), "v")
    out = landing.drained(spark, state.sums(df), "c", mode="update")
    assert out.count() == 6
    assert sorted(r.value for r in landing.latest(out, ["series", "field"]).collect()) == [3, 30]


def test_timing_means_carry_over(spark, rows, tmp_path):
    reads = rows("series string, slot timestamp, total bigint, n bigint",
                 ("s", T0, 15, 2), ("s", T0 + timedelta(seconds=10), 0, 0), ("s", T0 + timedelta(seconds=20), 12, 1),
                 ("s", T0 + timedelta(seconds=30), -3, 2), ("new", T0, 0, 0))
    path = str(tmp_path / "sums")
    reads.filter("slot < timestamp'2018-06-01 12:00:20Z'").coalesce(1).write.parquet(path)
    df = landing.read_landing(spark, path, reads.schema)
    out, mark = scratch_dir(spark, "out"), scratch_dir(spark, "mark")
    landing.write_stream(state.carried_means(df), out, mark).awaitTermination()
    reads.filter("slot >= timestamp'2018-06-01 12:00:20Z'").coalesce(1).write.mode("append").parquet(path)
    landing.write_stream(state.carried_means(df), out, mark).awaitTermination()
    got = spark.read.parquet(out).orderBy("series", "slot").collect()
    assert [(r.series, r.value) for r in got] == [("new", 0), ("s", 7), ("s", 7), ("s", 12), ("s", -1)]


def ran(df, out, mark, mode="append"):
    start = landing.write_stream if mode == "append" else landing.write_batches
    start(df, out, mark, mode=mode).awaitTermination()


def test_gate_follows_the_last_report_over_a_restart(spark, rows, tmp_path):
    path, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    # 59 and 61 lie on both sides of a minute: only the distance to the last report counts. 20 arrives after 40, 90 after 119.
    land(rows, path, (1, 59, "a", 1), (2, 61, "a", 1), (3, 40, "b", 1))
    land(rows, path, (4, 20, "b", 1), (5, 80, "b", 1), (6, 119, "a", 1))
    df = state.slow_interval(landing.read_landing(spark, path, EVENTS, files_per_batch=1), 60, "ts", "30 seconds", server="kind")
    ran(df, out, mark)
    land(rows, path, (7, 100, "a", 1), (8, 178, "a", 1), (9, 179, "a", 1), (10, 140, "b", 1))
    land(rows, path, (11, 5000, "c", 1))
    ran(df, out, mark)
    got = sorted((r.server, int(r.first_ts.timestamp() - T0.timestamp())) for r in spark.read.parquet(out).collect())
    assert got == [("a", 59), ("a", 119), ("a", 179), ("b", 20), ("b", 80), ("b", 140)]


COUNTED = "seq bigint, ts timestamp, kind string, op string, v bigint"


def test_counters_take_sets_out_of_order_over_a_restart(spark, rows, tmp_path):
    from gaugeloom.operators.stats import counter_stats

    path, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    named = lambda df: df.select(F.lit("m").alias("measurement"), F.create_map(F.lit("k"), F.col("kind")).alias("tags"), F.lit("f").alias("field"), "seq", "ts", "op", "v")
    land_ops = lambda *data: rows(COUNTED, *[(q, T0 + timedelta(seconds=q), k, o, v) for q, k, o, v in data]).coalesce(1).write.mode("append").parquet(path)
    land_ops((10, "a", "incr", 10), (20, "a", "incr", 5), (12, "b", "incr", 1))
    land_ops((15, "a", "set", 12), (40, "a", "incr", -2), (41, "b", "incr", 2**62), (42, "b", "incr", 2**62))  # the set lies between increments seen before
    df = state.counters(named(landing.read_landing(spark, path, COUNTED, files_per_batch=1)), "ts", "30 seconds")
    ran(df, out, mark, "update")
    assert {r.series[-1]: r.value for r in landing.latest(spark.read.parquet(out), ["series", "field"]).collect()} == {"a": 15, "b": None}
    land_ops((30, "a", "set", 7), (100, "b", "set", 3), (14, "a", "set", 99))
    land_ops((101, "b", "incr", 4), (200, "c", "incr", 1))
    land_ops((102, "b", "set", -1), (201, "c", "incr", 1), (2, "a", "incr", 10**6))  # the last is later than the watermark
    ran(df, out, mark, "update")
    got = {r.series[-1]: r.value for r in landing.latest(spark.read.parquet(out), ["series", "field"]).collect()}
    whole = counter_stats(named(spark.read.parquet(path).where("seq > 2"))).collect()
    assert got == {r.tags["k"]: r.value for r in whole} == {"a": 5, "b": -1, "c": 2}


@pytest.fixture
def default_store(spark):
    """Spark's own state store, which a session that is not built here has."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield
    spark.conf.set(name, before)


def test_counters_run_on_the_default_state_store(spark, rows, tmp_path, default_store):
    path, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    big = 2**60 + 1
    at = lambda us: T0 + timedelta(microseconds=us)
    named = lambda df: df.select(F.lit("m").alias("measurement"), F.create_map(F.lit("k"), F.col("kind")).alias("tags"), F.lit("f").alias("field"), "seq", "ts", "op", "v")
    # The watermark is then at T0, in whole milliseconds: what lies in the same millisecond has not been passed.
    rows(COUNTED, (big, at(200), "a", "incr", 4), (big + 5, at(30_000_900), "b", "incr", big)).coalesce(1).write.parquet(path)
    df = state.counters(named(landing.read_landing(spark, path, COUNTED, files_per_batch=1)), "ts", "30 seconds")
    ran(df, out, mark, "update")
    rows(COUNTED, (big + 1, at(400), "a", "incr", 16), (big + 6, at(30_000_950), "b", "incr", 1)).coalesce(1).write.mode("append").parquet(path)
    ran(df, out, mark, "update")
    rows(COUNTED, (big - 1, at(100), "a", "set", 100), (big + 7, at(30_000_990), "c", "set", big)).coalesce(1).write.mode("append").parquet(path)
    ran(df, out, mark, "update")
    got = {r.series[-1]: r.value for r in landing.latest(spark.read.parquet(out), ["series", "field"]).collect()}
    assert got == {"a": 120, "b": big + 1, "c": big}


def counted(df):
    return df.select("measurement", F.create_map(F.lit("k"), F.col("kind")).alias("tags"), "field", "seq", "ts", "op", "v")


NAMED = "measurement string, kind string, field string, seq bigint, ts timestamp, op string, v bigint"


def test_counters_of_a_group_share_one_call_and_state(spark, tmp_path):
    from gaugeloom.operators.stats import counter_stats

    path, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    events = spark.range(12_000, numPartitions=2).selectExpr(
        "'m' AS measurement", "string(id % 6000) AS kind", "'f' AS field", "id AS seq", "timestamp_seconds(id) AS ts",
        "if(id % 7 = 0, 'set', 'incr') AS op", "id % 11 AS v")
    events.write.parquet(path)
    query = landing.write_batches(state.counters(counted(landing.read_landing(spark, path, events.schema, files_per_batch=1)), "ts", "1 hour"), out, mark)
    query.awaitTermination()
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 4096
    got = {r.series: r.value for r in landing.latest(spark.read.parquet(out), ["series", "field"]).collect()}
    whole = counter_stats(counted(spark.read.parquet(path))).collect()
    assert got == {f"m\x02k\x01{r.tags['k']}": r.value for r in whole} and len(got) == 6000


def test_counters_of_a_group_stay_apart(spark, rows, tmp_path):
    path, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    at = lambda s: None if s is None else T0 + timedelta(seconds=s)
    event = lambda m, k, f, q, s, o, v: (m, k, f, q, at(s), o, v)
    batches = [
        # Names that would meet if they were joined, missing ones, huge values.
        [event("m", "a", "b", 2**60 + 1, 10, "incr", 1), event("m", "ab", "", 2**60 + 1, 10, "incr", 2), event("m", "a", None, 3, 10, "incr", 4),
         event(None, "a", "b", 3, 10, "incr", 8), event("m", "s", "f", -5, 10, "set", 7), event("m", "s", "f", -4, 11, "incr", 2**62)],
        [event("m", "a", "b", 2**60, 9, "set", 100), event("m", "a", None, 4, 12, "set", 50), event("m", "s", "f", -3, 200, "incr", 2**62),
         event("m", "s", "f", -5, 10, "set", 7), event("m", "n", "f", 1, 15, "set", 3), event("m", "n", "f", 2**60 + 2, None, "incr", 5)],
        # The first is later than the watermark; what it has passed stays counted.
        [event("m", "a", "b", 1, 20, "set", 9), event("m", "a", "b", 2**60 + 2, 201, "incr", 16), event("m", "s", "f", -2, 201, "incr", -(2**62)),
         event("m", "n", "f", 2**60 + 1, 202, "set", 7), event("m", "n", "f", 2**60 + 3, 203, "incr", 2**60 + 1)],
        [event("m", "n", "f", 2**60 + 4, 300, "incr", 1)],
    ]
    seen = []
    for batch in batches:
        rows(NAMED, *batch).coalesce(1).write.mode("append").parquet(path)
        ran(state.counters(counted(landing.read_landing(spark, path, NAMED, files_per_batch=1)), "ts", "30 seconds", groups=1), out, mark, "update")
        seen.append({(r.series and r.series.replace("\x02k\x01", "."), r.field): r.value for r in landing.latest(spark.read.parquet(out), ["series", "field"]).collect()})
    first = {("m.a", "b"): 1, ("m.ab", ""): 2, ("m.a", None): 4, (None, "b"): 8, ("m.s", "f"): 2**62 + 7}
    second = first | {("m.a", "b"): 101, ("m.a", None): 50, ("m.s", "f"): None, ("m.n", "f"): 8}
    third = second | {("m.a", "b"): 117, ("m.s", "f"): 2**62 + 7, ("m.n", "f"): 7 + 5 + 2**60 + 1}
    assert seen == [first, second, third, third | {("m.n", "f"): 7 + 5 + 2**60 + 2}]


def test_counter_events_land_in_quarters_of_many_files(spark, tmp_path):
    from pathlib import Path

    from gaugeloom.queries import QUERIES

    scratch, name = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")), "spark.sql.shuffle.partitions"
    held, before = spark.conf.get(name), set(scratch.iterdir())
    spark.range(400).selectExpr("id AS event_id", "CAST(timestamp_seconds(id) AS TIMESTAMP_NTZ) AS ts", "id % 5 AS user_id", "if(id % 9 = 0, 'purchase', 'view') AS event_type",
                                "1D AS value", "concat('{\"k\": ', id % 10, '}') AS props").write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set(name, "10")
    try:
        got = {(r.user_tag, r.field): r.value for r in QUERIES["stream_counters"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set(name, held)
    assert got == {(r.user_tag, r.field): r.value for r in QUERIES["counter_stat"](spark, str(tmp_path)).collect()}
    files = {kind: [f for d in set(scratch.iterdir()) - before if d.name.startswith(kind) and not d.name.startswith(f"{kind}-checkpoint") for f in d.glob(part)]
             for kind, part in (("stream-events", "part-*"), ("stream-counters", "batch=*"))}
    assert len(files["stream-events"]) == 12 and len(files["stream-counters"]) == 4


def test_gate_runs_on_the_default_state_store(spark, tmp_path, default_store):
    path, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    big = 2**60 + 1
    land_at = lambda *data: spark.createDataFrame([(k, T0 + timedelta(microseconds=us)) for k, us in data], "server bigint, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    second = 1_000_000
    land_at((big, 0), (big, 60 * second - 1), (big, 60 * second), (big + 1, 5), (big + 1, 6), (big + 2, 60 * second + 1), (None, 0))
    df = state.slow_interval(landing.read_landing(spark, path, "server bigint, ts timestamp", files_per_batch=1), 60, "ts", "30 seconds")
    ran(df, out, mark)
    # The watermark ends at 60 s: the snapshot at it is reported, the one a microsecond later waits.
    land_at((big + 3, 90 * second), (big + 1, 70 * second))
    ran(df, out, mark)
    got = lambda: sorted((r.server - big, r.us) for r in spark.read.parquet(out).select("server", F.expr("unix_micros(first_ts)").alias("us")).collect())
    zero = int(T0.timestamp()) * second
    reported = [(0, zero), (0, zero + 60 * second), (1, zero + 5)]
    assert got() == reported
    land_at((big + 2, 60 * second + 1_000), (big + 3, 110 * second))
    ran(df, out, mark)
    assert got() == reported + [(1, zero + 70 * second), (2, zero + 60 * second + 1)]


def test_scratch_folder_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_incremental_runs_move_the_cursor(spark, rows, tmp_path):
    from gaugeloom.plans import database as db
    from gaugeloom.streaming.cursor import load_cursors, run_incremental
    from test_jobs import history

    out, mark = str(tmp_path / "out"), str(tmp_path / "cursor")
    tables = history(spark)
    all_statements = tables["statements_history"]
    for landed, total in ((all_statements.filter("timer_end < 36e12"), 2), (all_statements, 3), (all_statements, 3)):
        run_incremental(spark, lambda c, landed=landed: db.statements(tables | {"statements_history": landed}, cursors=c), out, mark)
        assert spark.read.parquet(out).count() == total
    assert load_cursors(spark, mark).first().end_time.timestamp() == T0.timestamp() - 60


def test_a_broken_run_is_repeated_without_duplicates(spark, tmp_path, monkeypatch):
    from gaugeloom.plans import database as db
    from gaugeloom.streaming import cursor
    from test_jobs import history

    out, mark = str(tmp_path / "out"), str(tmp_path / "cursor")
    tables = history(spark)

    def run():
        cursor.run_incremental(spark, lambda c: db.statements(tables, cursors=c), out, mark)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(cursor, "save_cursors", lost)
        with pytest.raises(OSError):
            run()
    for _ in range(3):
        run()
        assert spark.read.parquet(out).count() == 3
    (tmp_path / "torn").write_text("no table")
    with pytest.raises(Exception, match="(?i)parquet"):
        cursor.load_cursors(spark, str(tmp_path / "torn")).collect()


def test_every_batch_reports_what_it_gathered(spark, rows, tmp_path):
    from gaugeloom.streaming import selfmetrics

    path, out, kept = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "self")
    land(rows, path, (1, 0, "a", 1), (2, 1, "b", 2))
    land(rows, path, (3, 2, "a", 3))
    seen = []
    save = selfmetrics.to_folder(spark, kept)
    listener = selfmetrics.GatherListener(lambda *counts: (seen.append(counts), save(*counts)))
    spark.streams.addListener(listener)
    try:
        df = selfmetrics.watched(as_points(landing.read_landing(spark, path, EVENTS, files_per_batch=1)), "events")
        dropped = normalise(df, InputConfig(filter=FilterSpec(name_drop=["b"])))
        landing.write_stream(dropped, out, str(tmp_path / "mark"), name="watched").awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert [(run, batch, gathered, errors) for run, batch, gathered, errors in seen if gathered] == [("watched", 0, {"events": 2}, 0), ("watched", 1, {"events": 1}, 0)]
    assert spark.read.parquet(out).count() == 2
    got = spark.read.parquet(kept).where("measurement = 'internal_agent'").selectExpr("run", "batch", "fields.metrics_gathered.i AS n").collect()
    assert sorted(map(tuple, got)) == [("watched", 0, 2), ("watched", 1, 1)]
