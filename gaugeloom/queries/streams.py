"""Streaming runs over the landed events table, read back when the stream has caught up."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom.functions.times import utc
from gaugeloom.operators.filters import FilterSpec
from gaugeloom.operators.inputs import InputConfig, normalise
from gaugeloom.operators.points import make_point
from gaugeloom.plans import database as db
from gaugeloom.queries.common import K, joined, k_of, load, num, query, tag
from gaugeloom.queries.database import _HISTORY_SQL, LAST_REPORT_SQL, _history
from gaugeloom.queries.points import STAT_SQL, stat_events
from gaugeloom.session import scratch_dir
from gaugeloom.streaming import landing, state


def _stream(spark, d):
    schema = load(spark, d, "events").schema
    raw = landing.read_landing(spark, f"{d}/events.parque[t]", schema)
    return raw.withColumns({"ts": utc(F.col("ts")), "k": k_of()})


@query("stream_points", f"""
SELECT 's_' || event_type AS measurement, CAST(user_id AS VARCHAR) AS user_tag, 'eu' AS dc, value,
  (epoch_us(ts) + 500000) // 1000000 * 1000000000 AS time_ns FROM events WHERE event_type <> 'view'""")
def stream_points(spark, d):
    df = _stream(spark, d)
    pts = make_point(df, F.col("event_type"), {"user": F.col("user_id")}, {"value": F.col("value"), "k": F.col("k")}, F.col("ts"), source="events")
    cfg = InputConfig(name_prefix="s_", tags={"dc": "eu"}, filter=FilterSpec(name_drop=["s_view"], field_drop=["k"]), precision_ns=10**9)
    out = landing.drained(spark, normalise(pts, cfg), "stream-points")
    return out.select("measurement", tag("user").alias("user_tag"), tag("dc").alias("dc"), num("value"), "time_ns")


@query("stream_dedup", "SELECT event_id, epoch_us(ts) AS us FROM events")
def stream_dedup(spark, d):
    df = _stream(spark, d).select("event_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    return landing.drained(spark, state.dedup(df, ["event_id"], "ts", "60 days"), "stream-dedup").select("event_id", F.unix_micros("ts").alias("us"))


@query("stream_sums", f"""
SELECT event_type AS measurement, 'k' || ({K} % 3) AS field, CAST(sum({K}) AS BIGINT) AS value FROM events GROUP BY ALL""")
def stream_sums(spark, d):
    df = _stream(spark, d).select(F.col("event_type").alias("measurement"), F.expr("map()").cast("map<string,string>").alias("tags"),
                                  joined("k", F.col("k") % 3).alias("field"), F.col("k").alias("v"))
    out = landing.drained(spark, state.sums(df), "stream-sums", mode="update")
    last = landing.latest(out, ["series", "field"])
    return last.select(F.regexp_replace("series", "\x02", "").alias("measurement"), "field", "value")


@query("stream_counters", STAT_SQL + "SELECT CAST(user_id AS VARCHAR) AS user_tag, field, value FROM c")
def stream_counters(spark, d):
    """The counters of ``counter_stat`` from a stream whose events arrive out of order, a quarter at a time."""
    landed = scratch_dir(spark, "stream-events")
    dealt = stat_events(spark, d)
    # Many files a quarter: one is read by few tasks, however large it is.
    dealt.repartition(4 * -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 4), F.xxhash64("seq")).write.parquet(landed)
    files = len(spark.read.schema(dealt.schema).parquet(landed).inputFiles())
    df = landing.read_landing(spark, landed, dealt.schema, files_per_batch=-(-files // 4))
    out = landing.drained(spark, state.counters(df, "ts", "60 days"), "stream-counters", mode="update")
    last = landing.latest(out, ["series", "field"])
    return last.select(F.regexp_extract("series", "\x01(.*)", 1).alias("user_tag"), "field", "value")


@query("stream_timing", f"""
WITH w AS (SELECT event_type AS series, epoch_us(ts) // 86400000000 * 86400000000 AS slot, CAST(sum({K}) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY ALL)
SELECT series, slot, n, total // n AS value FROM w WHERE slot + 86400000000 <= (SELECT max(epoch_us(ts)) - 3600000000 FROM events)""")
def stream_timing(spark, d):
    df = _stream(spark, d).select("event_type", "ts", F.col("k").alias("v"))
    sums = state.interval_sums(df, "1 day", "ts", "1 hour", F.col("event_type"))
    folder = landing.drain(spark, sums, "stream-interval-sums")
    out = landing.drained(spark, state.carried_means(landing.read_landing(spark, folder, sums.schema)), "stream-timing")
    return out.select("series", F.unix_micros("slot").alias("slot"), "n", "value")


@query("stream_slow_interval", f"""
WITH RECURSIVE {LAST_REPORT_SQL} SELECT user_id AS server, us AS first_us FROM r WHERE us <= (SELECT max(epoch_us(ts)) - 3600000000 FROM events)""")
def stream_slow_interval(spark, d):
    df = _stream(spark, d).select(F.col("user_id").alias("server"), "ts")
    out = landing.drained(spark, state.slow_interval(df, 21600, "ts", "1 hour"), "stream-slow")
    return out.select("server", F.unix_micros("first_ts").alias("first_us"))


@query("stream_statements", _HISTORY_SQL + """
SELECT 's' || sn AS server, event_id, thread_id, start_us + 500000 AS end_us, c_name AS user_name
FROM st JOIN customer ON c_custkey = thread_id WHERE has_text AND o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW' AND c_mktsegment <> 'MACHINERY'""")
def stream_statements(spark, d):
    """Statements land as a stream, twice; users and uptimes are tables."""
    landed = landing.read_landing(spark, f"{d}/orders.parque[t]", load(spark, d, "orders").schema)
    twice = landed.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    table = db.statements(_history(spark, d, orders=twice)).table
    once = state.dedup(table, ["server", "thread_id", "event_id"], "end_time", "30 days")
    out = landing.drained(spark, once, "stream-statements")
    return out.select("server", "event_id", "thread_id", F.unix_micros("end_time").alias("end_us"), F.col("processlist_user").alias("user_name"))
