from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators import reshape, stats
from helpers import T0, points

DDL = "seq bigint, measurement string, field string, tags map<string,string>, ts timestamp, op string, v bigint"


def events(rows, *spec, measurement="queue", field="jobs", tags=None):
    return rows(DDL, *[(i, measurement, field, tags or {"host": "w7"}, T0 + timedelta(seconds=s), op, v)
                       for i, (s, op, v) in enumerate(spec)])


def test_counter(rows):
    def total(*spec):
        return stats.counter_stats(events(rows, *spec)).first().value

    assert total((0, "incr", 0)) == 0
    assert total(*[(0, "incr", n) for n in range(9)]) == 36
    assert total((0, "set", 44), (0, "incr", 3), (0, "set", 6)) == 6
    assert total((0, "incr", 50), (0, "set", -4), (0, "incr", 9), (0, "incr", -1)) == 4
    assert total((0, "incr", 2**62), (0, "incr", 2**62)) is None
    assert total((0, "incr", 2**62), (0, "incr", 2**62), (0, "incr", -1)) == 2**63 - 1


@pytest.mark.parametrize("gap", [1, 999, 86_400_000_000])
def test_a_busy_series_is_merged_run_by_run(spark, gap):
    """Dense and sparse sequence numbers: the state merges over every level."""
    df = spark.range(150_000).select(
        (F.col("id") * gap - 70_000 * gap).alias("seq"), F.lit("m").alias("measurement"), F.lit("f").alias("field"), F.expr("map('h', 'x')").alias("tags"),
        F.when(F.col("id").isin(7, 100_000), "set").otherwise("incr").alias("op"), F.lit(1).cast("bigint").alias("v"))
    out = stats.counter_stats(df)
    assert out.first().value == 50_000
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning(") == 4


def test_a_set_wins_over_increments_of_its_number(rows):
    data = [(5, "incr", 3), (5, "set", 9), (6, "incr", 1), (None, "set", 77), (7, "other", 5), (8, "incr", None)]
    df = rows(DDL, *[(q, "m", "f", {"a": "b"}, T0, op, v) for q, op, v in data])
    assert [r.value for r in stats.counter_stats(df).collect()] == [10]


def test_timing(rows):
    df = events(rows, (1, "incr", 9), (4, "incr", 4), (21, "set", 30), (33, "incr", -4), (38, "incr", -5))
    means = stats.timing_stats(df, 10)
    assert [r.mean for r in means.orderBy("slot").collect()] == [6, 30, -4]
    start = int(T0.timestamp())
    reads = rows("field string, slot bigint", *[("jobs", start + s) for s in (-10, 0, 10, 20, 30, 40)]).withColumns(
        {"measurement": F.lit("queue"), "pairs": F.map_entries(F.create_map(F.lit("host"), F.lit("w7")))})
    assert [r.value for r in stats.fill_reads(means, reads).orderBy("slot").collect()] == [0, 6, 6, 30, -4, -4]


def test_regroup(rows):
    spec = [("eu", "sent", 3), ("eu", "lost", 0), ("us", "sent", 8), ("us", "sent", 11), ("us", "late", 2), ("asia", "late", 6)]
    df = rows(DDL, *[(i, "relay", f, {"zone": z}, T0, "incr", v) for i, (z, f, v) in enumerate(spec)])
    assert points(stats.regroup(stats.counter_stats(df))) == [
        ("internal_relay", {"zone": "asia"}, {"late": 6}),
        ("internal_relay", {"zone": "eu"}, {"lost": 0, "sent": 3}),
        ("internal_relay", {"zone": "us"}, {"late": 2, "sent": 19})]


def test_series_do_not_collide(rows):
    a = rows(DDL, (0, "m", "f", {"a": "bc"}, T0, "incr", 1), (1, "m", "f", {"ab": "c"}, T0, "incr", 2))
    assert stats.counter_stats(a).count() == 2


def test_self_points(rows):
    pts = rows("source string", ("x",), ("x",), ("y",))
    errors = rows("message string", ("bad",))
    out = stats.self_points(pts, errors, F.lit(T0))
    assert points(out) == [
        ("internal_agent", {}, {"gather_errors": 1, "metrics_gathered": 3}),
        ("internal_gather", {"input": "x"}, {"metrics_gathered": 2}),
        ("internal_gather", {"input": "y"}, {"metrics_gathered": 1})]
    none = stats.self_points(pts.filter("false"), errors.filter("false"), F.lit(T0))
    assert points(none) == [("internal_agent", {}, {"gather_errors": 0, "metrics_gathered": 0})]


def test_ordered_rank_is_the_same_for_any_slice(rows):
    data = [("hot", p) for p in range(0, 300, 3)] + [("cold", p) for p in (5, 7)]
    df = rows("g string, p bigint", *data)
    want = {(g, p): i for g in ("hot", "cold") for i, p in enumerate(sorted(x for h, x in data if h == g))}
    for size in (7, 10_000):
        got = {(r.g, r.p): r.rank for r in reshape.ordered_rank(df, ["g"], "p", slice_rows=size).collect()}
        assert got == want


def test_carry_forward_crosses_slices(rows):
    df = rows("g string, p bigint, m string", *[("a", p, {1: "x", 25: "y"}.get(p)) for p in range(40)], ("b", 3, None))
    for size in (4, 10_000):
        got = {(r.g, r.p): r.s for r in reshape.carry_forward(df, ["g"], "p", "m", "s", slice_rows=size).collect()}
        assert got == {("a", p): None if p < 1 else "x" if p < 25 else "y" for p in range(40)} | {("b", 3): None}


def test_sparse_positions_are_cut_into_even_slices(spark):
    """Microseconds, most of them in one burst: slices follow the rows, not the values."""
    df = spark.range(200_000, numPartitions=8).select(
        F.lit("g").alias("g"), F.when(F.col("id") < 190_000, F.col("id") * 3 + 10**15).otherwise(F.col("id") * 10**9).alias("p"))
    cut = reshape._cut(df, ["g"], "p", 5000)[0].groupBy("_slice").count().collect()
    assert len(cut) > reshape.SLICES * 0.9 and max(r["count"] for r in cut) < 3 * 200_000 / reshape.SLICES
    ranks = reshape.ordered_rank(df, ["g"], "p", slice_rows=5000)
    wrong = ranks.join(df.selectExpr("p", "row_number() OVER (ORDER BY p) - 1 AS want"), "p").where("rank <> want")
    assert wrong.isEmpty() and ranks.count() == 200_000


def test_top_rows_beyond_the_group_limit(spark):
    df = spark.range(40_000, numPartitions=8).select(F.when(F.col("id") % 10 == 0, "a").otherwise("hot").alias("g"), (F.col("id") * 7919 % 40_009).alias("v"), "id")
    out = reshape.top_rows(df, ["g"], [F.desc("v"), F.asc("id")], 6000)
    want = df.selectExpr("*", "row_number() OVER (PARTITION BY g ORDER BY v DESC, id) AS n").where("n <= 6000").drop("n")
    assert out.exceptAll(want).isEmpty() and out.count() == want.count() == 10_000
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in text
