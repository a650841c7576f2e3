"""Self-statistics: counters, averaged timings, regrouping by series, gathered and error counts.

Events are rows of ``measurement, field, tags, seq, ts, op (incr or set), v``. Timings are first
reduced to one row per series and interval with partial aggregation; counter events are merged run by run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeloom.functions.values import int_field

PREFIX = "internal_"


#: A series is its name and its tags in key order. Unlike a map, the ordered pairs can be a grouping key.
SERIES = ["measurement", "pairs"]
#: Bits of ``seq`` that one level of merging takes away: a group merges at most 2**16 sequence numbers or slices.
LEVEL_BITS = 16


def _paired(events: DataFrame) -> DataFrame:
    return events.withColumn("pairs", F.sort_array(F.map_entries("tags"))).drop("tags")


def _tagged(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.map_from_entries("pairs"))


def _merged(states: Column) -> Column:
    """One state out of states in order: from the last reset on, the totals add up."""
    def step(sofar: Column, s: Column) -> Column:
        total = F.when(s["reset"], s["total"]).otherwise((sofar["total"] + s["total"]).cast("decimal(38,0)"))
        return F.struct((sofar["reset"] | s["reset"]).alias("reset"), total.alias("total"))

    return F.aggregate(F.sort_array(states), F.expr("named_struct('reset', false, 'total', CAST(0 AS DECIMAL(38,0)))"), step)


def counter_stats(events: DataFrame) -> DataFrame:
    """Current value per series and field: the last set value plus the increments after it.

    A run of events in order of ``seq`` amounts to whether it holds a set, and to the last set's value plus the increments after
    it; runs next to each other merge into such a state again. Runs of ``2 ** LEVEL_BITS`` sequence numbers are merged first, then
    runs of as many runs, so a busy series is merged by many tasks and no step holds more than that. At the same ``seq``
    a set comes after increments. A value beyond 64 bits is NULL; events without ``seq``, or with another ``op``, are left out.
    """
    key = [*SERIES, "field"]
    rows = _paired(events).where("op IN ('set', 'incr') AND seq IS NOT NULL AND v IS NOT NULL").select(
        *key, F.col("seq").cast("bigint").alias("_at"), (F.col("op") == "set").alias("reset"), F.col("v").cast("decimal(38,0)").alias("total"))
    for left in range(64 - LEVEL_BITS, -1, -LEVEL_BITS):
        state = F.struct(F.col("_at").alias("at"), "reset", "total")
        group = [*key, F.shiftright("_at", LEVEL_BITS).alias("_at")] if left else key
        rows = rows.groupBy(*group).agg(_merged(F.collect_list(state)).alias("_s")).select(*key, *(["_at"] if left else []), "_s.*")
    return _tagged(rows.select(*key, F.col("total").try_cast("bigint").alias("value")))


def timing_stats(events: DataFrame, interval_seconds: int) -> DataFrame:
    """Truncated mean per series, field and interval that saw events; setting counts as another sample."""
    slot = F.call_function("div", F.unix_seconds("ts"), F.lit(interval_seconds)) * interval_seconds
    sums = (_paired(events).withColumn("slot", slot).groupBy(*SERIES, "field", "slot")
            .agg(F.try_sum("v").alias("total"), F.count(F.lit(1)).alias("n")))
    return _tagged(sums.withColumn("mean", F.call_function("div", F.col("total"), F.col("n"))))


def fill_reads(means: DataFrame, reads: DataFrame) -> DataFrame:
    """Value at each read slot: the latest mean at or before it, 0 before the first event.

    ``reads`` has ``measurement, pairs, field, slot`` rows. The merge is a union and a window over interval rows.
    """
    key = [*SERIES, "field", "slot"]
    merged = (means.select(*key, "mean", F.lit(False).alias("read"))
              .unionByName(reads.select(*key, F.lit(None).cast("bigint").alias("mean"), F.lit(True).alias("read")))
              .groupBy(*key).agg(F.max("mean").alias("mean"), F.max("read").alias("read")))
    upto = Window.partitionBy(*SERIES, "field").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce(F.last("mean", ignorenulls=True).over(upto), F.lit(0))
    return _tagged(merged.withColumn("value", value).filter("read").select(*key, "value"))


def regroup(stats: DataFrame) -> DataFrame:
    """One row per series with all its fields in a map; series names get the self-statistic prefix."""
    fields = F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", int_field(F.col("value")).alias("v")))))
    rows = stats if "pairs" in stats.columns else _paired(stats)
    return _tagged(rows.groupBy(*SERIES).agg(fields.alias("fields"))).select(
        F.concat(F.lit(PREFIX), F.col("measurement")).alias("measurement"), "tags", "fields")


def gathered(points: DataFrame, tag: str = "source") -> DataFrame:
    """Points gathered per input, counted before any filter."""
    return points.groupBy(F.col(tag).alias("input")).agg(F.count(F.lit(1)).alias("metrics_gathered"))


def gather_errors(errors: DataFrame) -> DataFrame:
    return errors.agg(F.count(F.lit(1)).alias("gather_errors"))


def self_points(points: DataFrame, errors: DataFrame, ts) -> DataFrame:
    """Engine self-metrics as points: gathered per input and in total, and the error count."""
    from gaugeloom.operators.points import make_point

    per_input = gathered(points)
    inputs = make_point(per_input, PREFIX + "gather", {"input": F.col("input")},
                        {"metrics_gathered": F.col("metrics_gathered")}, ts, source="internal")
    totals = per_input.agg(F.coalesce(F.sum("metrics_gathered"), F.lit(0)).alias("metrics_gathered"))
    failed = gather_errors(errors)
    null = F.lit(None).cast("bigint")
    both = (totals.select("metrics_gathered", null.alias("gather_errors"))
            .unionByName(failed.select(null.alias("metrics_gathered"), "gather_errors"))
            .agg(F.max("metrics_gathered").alias("metrics_gathered"), F.max("gather_errors").alias("gather_errors")))
    agent = make_point(both, PREFIX + "agent", {}, {
        "metrics_gathered": F.col("metrics_gathered"), "gather_errors": F.col("gather_errors")}, ts, source="internal")
    return inputs.unionByName(agent)


def run_points(spark: SparkSession, gathered: dict[str, int], errors: int, ts: Column) -> DataFrame:
    """``self_points`` from what a write has counted: one row an input and one in total, nothing is read again."""
    from gaugeloom.operators.points import make_point

    rows = spark.createDataFrame(
        [("gather", name, n, None) for name, n in gathered.items()] + [("agent", None, sum(gathered.values()), errors)],
        "part string, input string, metrics_gathered bigint, gather_errors bigint")
    return make_point(rows, F.concat(F.lit(PREFIX), "part"), {"input": F.col("input")},
                      {"metrics_gathered": F.col("metrics_gathered"), "gather_errors": F.col("gather_errors")}, ts, source="internal")
