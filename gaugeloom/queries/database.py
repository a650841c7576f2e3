"""Database reports over system tables derived from the provided ones."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from gaugeloom.functions.times import utc
from gaugeloom.model import to_long
from gaugeloom.functions.maps import shown
from gaugeloom.functions.values import field_text
from gaugeloom.operators.reshape import field_chunks
from gaugeloom.plans import database as db
from gaugeloom.queries.common import events, joined, load, num, query, stamp, tag
from gaugeloom.sources.landing import IO_OPS, LOCK_MODES, USER_COUNTERS, table_or_empty

DEC = "decimal(20,0)"


def at(df, server, ts=None):
    return df.withColumns({"server": server, "collected_at": ts if ts is not None else stamp()})


def _texts():
    return shown(F.transform_values("fields", lambda _, v: field_text(v)))


def _status(spark, d):
    key = F.col("c_custkey")
    name = F.element_at(F.array(*[F.concat(F.lit(p), F.lower("c_mktsegment")) for p in ("Com_", "Aria__", "Aria_", "wsrep_", "Slow_")],
                                F.lit("Queries"), F.lit("Uptime"), F.lit("Syncs")), (key % 8 + 1).cast("int"))
    value = F.when(key % 5 == 0, "junk").otherwise(key.cast("string"))
    rows = load(spark, d, "customer").select(key.alias("pos"), name.alias("name"), value.alias("value"), (F.floor(key / 20)).alias("n"))
    return {"global_status": at(rows, joined("db", F.col("n")))}


_STATUS_SQL = """
WITH r AS (SELECT c_custkey AS pos, 'db' || (c_custkey // 20) AS server, c_custkey % 8 AS m, lower(c_mktsegment) AS seg,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS v FROM customer)
"""


@query("status_prefix_map", _STATUS_SQL + """
, f AS (SELECT server, pos, CASE m WHEN 0 THEN 'commands_' || seg WHEN 1 THEN 'aria_' || seg WHEN 3 THEN 'wsrep_' || seg WHEN 4 THEN 'slow_' || seg
    WHEN 5 THEN 'queries' WHEN 6 THEN 'uptime' WHEN 7 THEN 'syncs' END AS field, CASE WHEN m < 5 THEN coalesce(v, 0) ELSE v END AS v FROM r),
l AS (SELECT server, field, max_by(v, pos) AS v FROM f WHERE field IS NOT NULL AND v IS NOT NULL GROUP BY ALL)
SELECT server, string_agg(field || '=' || v, ',' ORDER BY field) AS fields FROM l GROUP BY server""")
def status_prefix_map(spark, d):
    return db.global_status(_status(spark, d)).metrics.select(tag("server").alias("server"), _texts().alias("fields"))


@query("status_errors", _STATUS_SQL + """
SELECT server, CASE m WHEN 5 THEN 'Queries' WHEN 6 THEN 'Uptime' ELSE 'Syncs' END AS name, count(*) AS n FROM r WHERE m >= 5 AND v IS NULL GROUP BY ALL""")
def status_errors(spark, d):
    errors = db.global_status(_status(spark, d)).errors
    return errors.groupBy("server", F.regexp_extract("message", r"parsing (\S+) ", 1).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("status_lower_case", _STATUS_SQL + """
, f AS (SELECT server, pos, CASE m WHEN 0 THEN 'com_' || seg WHEN 1 THEN 'aria__' || seg WHEN 2 THEN 'aria_' || seg WHEN 3 THEN 'wsrep_' || seg WHEN 4 THEN 'slow_' || seg
    WHEN 5 THEN 'queries' WHEN 6 THEN 'uptime' ELSE 'syncs' END AS field, coalesce(CAST(v AS VARCHAR), 'junk') AS v FROM r),
l AS (SELECT server, field, max_by(v, pos) AS v FROM f GROUP BY ALL)
SELECT server, string_agg(field || '=' || v, ',' ORDER BY field) AS fields FROM l GROUP BY server""")
def status_lower_case(spark, d):
    out = db.global_status(_status(spark, d), db.DatabaseConfig(metric_version=2)).metrics
    return out.select(tag("server").alias("server"), _texts().alias("fields"))


@query("field_chunks", """
WITH r AS (SELECT 'p' || (p_partkey // 70) AS server, p_partkey, row_number() OVER (PARTITION BY p_partkey // 70 ORDER BY p_partkey) - 1 AS rn
  FROM part WHERE p_size % 9 <> 0)
SELECT server, rn // 20 AS chunk, count(*) AS n, min(p_partkey) AS lo, max(p_partkey) AS hi FROM r GROUP BY ALL""")
def field_chunks_query(spark, d):
    rows = load(spark, d, "part").select(
        joined("p", F.floor(F.col("p_partkey") / 70)).alias("server"), F.col("p_partkey").alias("pos"), F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("name"),
        F.when(F.col("p_size") % 9 != 0, F.col("p_partkey")).alias("v"))
    out = field_chunks(rows, ["server"], "pos", "name", "v")
    return out.select("server", "chunk", F.size("fields").cast("bigint").alias("n"), F.array_min(F.map_values("fields")).alias("lo"),
                      F.array_max(F.map_values("fields")).alias("hi"))


@query("innodb_chunks", """
WITH r AS (SELECT 'p' || (p_partkey // 70) AS server, p_partkey, row_number() OVER (PARTITION BY p_partkey // 70 ORDER BY p_partkey) - 1 AS rn
  FROM part WHERE p_type <> 'PROMO')
SELECT server, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS total FROM r GROUP BY server, rn // 20""")
def innodb_chunks(spark, d):
    rows = load(spark, d, "part").select(
        F.col("p_partkey").alias("pos"), joined("M", F.col("p_partkey")).alias("name"), F.col("p_partkey").cast("string").alias("count"),
        F.when(F.col("p_type") == "PROMO", "disabled").otherwise("enabled").alias("status"))
    out = db.innodb_metrics({"innodb_metrics": at(rows, joined("p", F.floor(F.col("pos") / 70)))}).metrics
    total = F.aggregate(F.map_values("fields"), F.lit(0).cast("bigint"), lambda a, v: a + v["f"].cast("bigint"))
    return out.select(tag("server").alias("server"), F.size("fields").cast("bigint").alias("n"), total.alias("total"))


@query("variables_report", """
WITH r AS (SELECT 'p' || (p_partkey // 50) AS server, p_partkey, CASE WHEN p_partkey % 50 = 3 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS v,
  p_partkey % 50 = 3 AS version FROM part WHERE p_size % 9 <> 0 OR p_partkey % 50 = 3),
n AS (SELECT *, row_number() OVER (PARTITION BY server ORDER BY p_partkey) - 1 AS rn FROM r),
t AS (SELECT server, 'server=' || server || coalesce(max(',version=' || v) FILTER (version), '') AS tags FROM r GROUP BY server)
SELECT tags, count(*) AS n, CAST(coalesce(sum(try_cast(v AS BIGINT)) FILTER (NOT version), 0) AS BIGINT) AS total FROM n JOIN t USING (server) GROUP BY server, tags, rn // 20""")
def variables_report(spark, d):
    version = F.col("p_partkey") % 50 == 3
    rows = load(spark, d, "part").select(
        F.col("p_partkey").alias("pos"), F.when(version, "Version").otherwise(joined("V", F.col("p_partkey"))).alias("name"),
        F.when(version, F.col("p_brand")).when(F.col("p_size") % 9 == 0, "").otherwise(F.col("p_size").cast("string")).alias("value"))
    out = db.global_variables({"global_variables": at(rows, joined("p", F.floor(F.col("pos") / 50)))}).metrics
    total = F.aggregate(F.map_values("fields"), F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v["f"].cast("bigint"), F.lit(0)))
    return out.select(shown(F.col("tags")).alias("tags"), F.size("fields").cast("bigint").alias("n"), total.alias("total"))


@query("replication_unpivot", """
SELECT s_name AS server, 'slave_master_host' AS field, 's' AS kind, 'm' || s_nationkey AS value FROM supplier
UNION ALL SELECT s_name, 'slave_seconds_behind_master', 'i', CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_nationkey > 3
UNION ALL SELECT s_name, 'slave_slave_io_running', 'i', CASE WHEN s_acctbal > 0 THEN '1' ELSE '0' END FROM supplier""")
def replication_unpivot(spark, d):
    rows = at(load(spark, d, "supplier").select(
        "s_name", F.when(F.col("s_acctbal") > 0, "Yes").otherwise("No").alias("Slave_IO_Running"), joined("m", F.col("s_nationkey")).alias("Master_Host"),
        F.when(F.col("s_nationkey") > 3, F.col("s_nationkey").cast("string")).alias("Seconds_Behind_Master")), F.col("s_name")).drop("s_name")
    out = to_long(db.replication({"slave_status": rows}, db.DatabaseConfig(metric_version=2)).metrics)
    return out.select(tag("server").alias("server"), "field", "kind", F.coalesce(F.col("i").cast("string"), "s").alias("value"))


@query("log_totals", """
SELECT o_orderpriority AS server, epoch_us(o_orderdate) AS us, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS bytes, count(*) AS files FROM orders GROUP BY ALL
UNION ALL SELECT n_name, 0, 0, 0 FROM nation""")
def log_totals(spark, d):
    orders = load(spark, d, "orders")
    logs = at(orders.select(F.round(F.col("o_totalprice") * 100).cast(DEC).alias("size"), "o_orderpriority", "o_orderdate"), F.col("o_orderpriority"), utc(F.col("o_orderdate")))
    servers = logs.select("server", "collected_at").distinct().unionByName(
        load(spark, d, "nation").select(F.col("n_name").alias("server"), F.timestamp_micros(F.lit(0)).alias("collected_at")))
    table = db.binary_logs({"binary_logs": logs.select("server", "collected_at", "size"), "servers": servers}).table
    return table.select("server", F.unix_micros("collected_at").alias("us"), F.col("binary_size_bytes").cast("bigint").alias("bytes"), F.col("binary_files_count").alias("files"))


_STATES = ("sending data", "Updating_", "update", "Waiting for table metadata lock", "", "strange", "Sending_Data", "System lock")


def _processlist(spark, d):
    df = events(spark, d)
    state = F.element_at(F.array(*map(F.lit, _STATES)), (F.col("k") % 8 + 1).cast("int"))
    command = (F.when(F.col("event_type") == "click", "Sleep").when(F.col("event_type") == "view", "Query")
               .when(F.col("event_type") == "error", "Binlog Dump").otherwise("Connect"))
    rows = df.select(F.col("event_id").alias("id"), F.col("event_type").alias("user"), command.alias("command"), state.alias("state"), "user_id", "ts")
    micros = F.unix_micros("ts")
    day = F.timestamp_micros(micros - F.pmod(micros, F.lit(86_400_000_000)))
    return {"processlist": at(rows, F.col("user_id").cast("string"), day).drop("user_id", "ts")}


@query("thread_state_pivot", """
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS server, epoch_us(date_trunc('day', ts)) AS us, event_type AS t, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 8 AS m FROM events WHERE event_id <> 7),
s AS (SELECT server, us, CASE WHEN m IN (0, 6) THEN 'sending data' WHEN m = 2 THEN 'updating' WHEN m IN (3, 7) THEN 'waiting for lock'
  WHEN t = 'click' AND m = 4 THEN 'idle' WHEN t = 'view' THEN 'executing' WHEN t = 'error' THEN 'replication master' ELSE 'other' END AS st FROM e)
SELECT server, us, count(*) FILTER (st = 'sending data') AS sending, count(*) FILTER (st = 'updating') AS updating, count(*) FILTER (st = 'waiting for lock') AS locked,
  count(*) FILTER (st = 'idle') AS idle, count(*) FILTER (st = 'executing') AS executing, count(*) FILTER (st = 'replication master') AS master,
  count(*) FILTER (st = 'other') AS other, 0::BIGINT AS init, 51 AS states FROM s GROUP BY ALL""")
def thread_state_pivot(spark, d):
    out = db.process_list(_processlist(spark, d), db.DatabaseConfig(own_connection=7)).points()
    names = {"sending": "sending_data", "updating": "updating", "locked": "waiting_for_lock", "idle": "idle", "executing": "executing",
             "master": "replication_master", "other": "other", "init": "init"}
    return out.select(tag("server").alias("server"), F.unix_micros("ts").alias("us"), *[F.col("fields")[f"threads_{n}"]["i"].alias(a) for a, n in names.items()],
                      F.size("fields").alias("states"))


@query("user_connections", """
SELECT CAST(user_id AS VARCHAR) AS server, event_type AS "user", epoch_us(date_trunc('day', ts)) AS us, count(*) AS connections FROM events GROUP BY ALL""")
def user_connections(spark, d):
    table = db.user_connections(_processlist(spark, d)).table
    return table.select("server", "user", F.unix_micros("collected_at").alias("us"), "connections")


@query("user_stats", """
SELECT c_mktsegment AS server, c_name AS "user", c_custkey AS first_counter, c_custkey + 20 AS last_counter, 21 AS n FROM customer""")
def user_stats(spark, d):
    one = load(spark, d, "customer").select(F.col("c_name").alias("user"), "c_mktsegment", *[(F.col("c_custkey") + i).alias(c) for i, c in enumerate(USER_COUNTERS)])
    rows = at(one.unionByName(one), F.col("c_mktsegment")).drop("c_mktsegment")
    pts = db.user_statistics({"user_statistics": rows}).points()
    return pts.select(tag("server").alias("server"), tag("user").alias("user"), F.col("fields")[USER_COUNTERS[0]]["i"].alias("first_counter"),
                      F.col("fields")[USER_COUNTERS[-1]]["i"].alias("last_counter"), F.size("fields").alias("n"))


@query("autoinc_ceiling", """
WITH t AS (SELECT 't' || o_orderkey AS table_name, o_orderkey + 1 AS auto_increment FROM orders WHERE o_orderstatus <> 'P'),
c AS (SELECT 't' || l_orderkey AS table_name, 'c' || l_linenumber AS column_name, CASE l_linenumber WHEN 1 THEN 7 WHEN 2 THEN 15 WHEN 3 THEN 23 WHEN 4 THEN 31 WHEN 5 THEN 63 END
  + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS bits FROM lineitem WHERE l_linestatus = 'O')
SELECT table_name, column_name, auto_increment, CASE WHEN bits > 63 THEN '18446744073709551615' WHEN bits IS NOT NULL THEN CAST((1::HUGEINT << bits::INT) - 1 AS VARCHAR) END AS ceiling
FROM t JOIN c USING (table_name)""")
def autoinc_ceiling(spark, d):
    tables = at(load(spark, d, "orders").select(
        F.lit("shop").alias("table_schema"), joined("t", F.col("o_orderkey")).alias("table_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") + 1).cast(DEC).alias("auto_increment")), F.lit("s1"))
    kind = F.element_at(F.array(*map(F.lit, ("tinyint", "smallint", "mediumint", "int", "bigint", "text", "text", "text"))), F.col("l_linenumber"))
    columns = at(load(spark, d, "lineitem").select(
        F.lit("shop").alias("table_schema"), joined("t", F.col("l_orderkey")).alias("table_name"), joined("c", F.col("l_linenumber")).alias("column_name"),
        kind.alias("data_type"), F.when(F.col("l_returnflag") == "R", F.concat(kind, F.lit(" unsigned"))).otherwise(kind).alias("column_type"),
        F.when(F.col("l_linestatus") == "O", "auto_increment").alias("extra")), F.lit("s1"))
    table = db.auto_increment({"tables": tables, "columns": columns}).table
    return table.select("table_name", "column_name", F.col("auto_increment").cast("bigint").alias("auto_increment"), F.col("auto_increment_max").cast("string").alias("ceiling"))


def _io(spark, d, *extra):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    df = load(spark, d, "lineitem")
    schema = F.when(F.col("l_returnflag") == "A", "mysql").otherwise(F.col("l_returnflag"))
    keys = [schema.alias("object_schema"), joined("t", F.col("l_suppkey")).alias("object_name"), *extra]
    sums = df.groupBy(*keys).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.sum(cents).alias("c"))
    rows = sums.select("object_schema", "object_name", *(["index_name"] if extra else []),
                       *[(F.col("q") + i).cast("double").alias(f"count_{op}") for i, op in enumerate(IO_OPS)],
                       *[((F.col("c") + i).cast("double") * 1e9).alias(f"sum_timer_{op}") for i, op in enumerate(IO_OPS)])
    return at(rows, F.lit("s1"))


_CENTS = "CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT)"


@query("io_waits_table", f"""
SELECT l_returnflag AS schema, 't' || l_suppkey AS name, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS fetches,
  CAST(sum(CAST(l_quantity AS BIGINT)) + 3 AS DOUBLE) AS deletes, ({_CENTS} + 1)::DOUBLE * 1e9 / 1e12 AS insert_seconds FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL""")
def io_waits_table(spark, d):
    pts = db.table_io_waits({"table_io_waits": _io(spark, d)}).points()
    return pts.select(tag("schema").alias("schema"), tag("name").alias("name"), F.col("fields")["table_io_waits_total_fetch"]["f"].alias("fetches"),
                      F.col("fields")["table_io_waits_total_delete"]["f"].alias("deletes"), F.col("fields")["table_io_waits_seconds_total_insert"]["f"].alias("insert_seconds"))


@query("io_waits_index", f"""
SELECT l_returnflag AS schema, 't' || l_suppkey AS name, CASE WHEN l_linenumber = 1 THEN 'NONE' ELSE 'ix' || l_linenumber END AS index_name, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS fetches,
  CASE WHEN l_linenumber = 1 THEN CAST(sum(CAST(l_quantity AS BIGINT)) + 3 AS DOUBLE) END AS deletes, CASE WHEN l_linenumber = 1 THEN ({_CENTS} + 2)::DOUBLE * 1e9 / 1e12 END AS update_seconds,
  CASE WHEN l_linenumber = 1 THEN 8 ELSE 2 END AS n FROM lineitem WHERE l_returnflag <> 'A' GROUP BY l_returnflag, l_suppkey, l_linenumber""")
def io_waits_index(spark, d):
    index = F.when(F.col("l_linenumber") != 1, joined("ix", F.col("l_linenumber"))).alias("index_name")
    pts = db.index_io_waits({"index_io_waits": _io(spark, d, index)}).points()
    return pts.select(tag("schema").alias("schema"), tag("name").alias("name"), tag("index").alias("index_name"),
                      *[F.try_element_at("fields", F.lit(f"index_io_waits_{n}"))["f"].alias(a) for a, n in (
                          ("fetches", "total_fetch"), ("deletes", "total_delete"), ("update_seconds", "seconds_total_update"))], F.size("fields").alias("n"))


_PERF = [("sql_lock_waits_total", 1, 0), ("external_lock_waits_total", 1, 1), ("sql_lock_waits_seconds_total", 2, 0), ("external_lock_waits_seconds_total", 2, 1)]


def _lock_sql() -> str:
    def col(mode, factor, external):
        if mode in ("read", "write"):
            at_, here = LOCK_MODES.index(f"{mode}_external"), external
        else:
            at_, here = LOCK_MODES.index(mode), not external
        value = f"CAST(p_partkey + {at_} AS DOUBLE)" if factor == 1 else f"CAST(p_size + {at_} AS DOUBLE) * 1e11 / 1e12"
        return f"{value if here else 'CAST(NULL AS DOUBLE)'} AS {mode}"

    modes = [m for m in LOCK_MODES if not m.endswith("_external")] + ["read", "write"]
    return " UNION ALL ".join(
        f"SELECT p_brand AS schema, p_partkey AS id, '{name}' AS perf_query, {', '.join(col(m, factor, ext) for m in modes)} FROM part" for name, factor, ext in _PERF)


@query("lock_waits_unpivot", _lock_sql())
def lock_waits_unpivot(spark, d):
    rows = load(spark, d, "part").select(
        F.col("p_brand").alias("object_schema"), F.col("p_partkey").cast("string").alias("object_name"),
        *[(F.col("p_partkey") + i).cast("double").alias(f"count_{m}") for i, m in enumerate(LOCK_MODES)],
        *[((F.col("p_size") + i).cast("double") * 1e11).alias(f"sum_timer_{m}") for i, m in enumerate(LOCK_MODES)])
    table = db.lock_waits({"table_lock_waits": at(rows, F.lit("s1"))}).table
    modes = [m for m in LOCK_MODES if not m.endswith("_external")] + ["read", "write"]
    return table.select(F.col("object_schema").alias("schema"), F.col("object_name").cast("bigint").alias("id"), "perf_query", *modes)


@query("lock_waits_optional", """
SELECT 'there' AS version, p_brand AS schema, count(*) * 4 AS points FROM part GROUP BY p_brand""")
def lock_waits_optional(spark, d):
    """Lock waits of two server versions: one has the table, the other doesn't."""
    rows = at(load(spark, d, "part").select(F.col("p_brand").alias("object_schema"), F.col("p_partkey").cast("string").alias("object_name"),
                                            *[F.lit(1.0).alias(f"{part}_{m}") for part in ("count", "sum_timer") for m in LOCK_MODES]), F.lit("s1"))
    rows.createOrReplaceTempView("landed_lock_waits")
    parts = [db.lock_waits({"table_lock_waits": table_or_empty(spark, name, "table_lock_waits")}).table.select(
        F.lit(version).alias("version"), F.col("object_schema").alias("schema")) for version, name in (("there", "landed_lock_waits"), ("none", "no_such_lock_waits"))]
    return parts[0].unionByName(parts[1]).groupBy("version", "schema").agg(F.count(F.lit(1)).alias("points"))


@query("event_wait_seconds", "SELECT p_partkey AS id, p_size::DOUBLE AS waits, p_size::DOUBLE * 1e11 / 1e12 AS seconds FROM part")
def event_wait_seconds(spark, d):
    rows = load(spark, d, "part").select(F.col("p_partkey").cast("string").alias("event_name"), F.col("p_size").cast("double").alias("count_star"),
                                         (F.col("p_size").cast("double") * 1e11).alias("sum_timer_wait"))
    table = db.event_waits({"event_waits": at(rows, F.lit("s1"))}).table
    return table.select(F.col("event_name").cast("bigint").alias("id"), F.col("events_waits_total").alias("waits"), F.col("events_waits_seconds_total").alias("seconds"))


@query("file_events_unpivot", """
SELECT p_partkey AS id, 'misc' AS mode, p_size + 2.0::DOUBLE AS total, (p_size + 2)::DOUBLE * 1e11 / 1e12 AS seconds, CAST(NULL AS DOUBLE) AS bytes FROM part
UNION ALL SELECT p_partkey, 'read', p_size, p_size::DOUBLE * 1e11 / 1e12, p_retailprice FROM part
UNION ALL SELECT p_partkey, 'write', p_size + 1, (p_size + 1)::DOUBLE * 1e11 / 1e12, p_retailprice FROM part""")
def file_events_unpivot(spark, d):
    size = F.col("p_size").cast("double")
    rows = load(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("event_name"), *[(size + i).alias(f"count_{m}") for i, m in enumerate(("read", "write", "misc"))],
        *[((size + i) * 1e11).alias(f"sum_timer_{m}") for i, m in enumerate(("read", "write", "misc"))],
        *[F.col("p_retailprice").alias(f"sum_number_of_bytes_{m}") for m in ("read", "write")])
    pts = db.file_events({"file_events": at(rows, F.lit("s1"))}).points()
    return pts.select(tag("event_name").cast("bigint").alias("id"), tag("mode").alias("mode"), *[
        F.try_element_at("fields", F.lit(f"file_events_{n}"))["f"].alias(a) for a, n in (("total", "total"), ("seconds", "seconds_total"), ("bytes", "bytes_totals"))])


def _tables(spark, d):
    size = F.col("p_size").cast("double")
    rows = load(spark, d, "part").select(
        F.when(F.col("p_brand") == "Brand#1", "mysql").otherwise(F.col("p_brand")).alias("table_schema"), F.col("p_partkey").cast("string").alias("table_name"),
        F.lit("BASE TABLE").alias("table_type"), F.when(F.col("p_size") % 2 == 0, "InnoDB").alias("engine"), F.lit("Compact").alias("row_format"),
        F.lit(None).cast("string").alias("create_options"), F.lit(10.0).alias("version"), size.alias("table_rows"), F.col("p_retailprice").alias("data_length"),
        F.when(F.col("p_size") % 3 == 0, size).alias("index_length"), F.lit(None).cast("double").alias("data_free"))
    return {"tables": at(rows, F.lit("s1"))}


@query("table_size_unpivot", """
WITH p AS (SELECT p_partkey AS id, p_brand, p_size, p_retailprice FROM part WHERE p_brand <> 'Brand#1')
SELECT id, 'info_schema_table_rows' AS measurement, p_size::DOUBLE AS value, NULL AS component, NULL AS engine FROM p
UNION ALL SELECT id, 'info_schema_table_size_data_length', p_retailprice, 'data_length', NULL FROM p
UNION ALL SELECT id, 'info_schema_table_size_index_length', CASE WHEN p_size % 3 = 0 THEN p_size ELSE 0 END, 'index_length', NULL FROM p
UNION ALL SELECT id, 'info_schema_table_size_data_free', 0, 'data_free', NULL FROM p
UNION ALL SELECT id, 'info_schema_table_version', 10, NULL, CASE WHEN p_size % 2 = 0 THEN 'InnoDB' ELSE 'NONE' END FROM p""")
def table_size_unpivot(spark, d):
    pts = db.table_sizes(_tables(spark, d)).points()
    return pts.select(tag("table").cast("bigint").alias("id"), "measurement", num("value"), *[F.try_element_at("tags", F.lit(t)).alias(t) for t in ("component", "engine")])


@query("table_size_newer_names", """
WITH p AS (SELECT p_partkey AS id, p_size, p_retailprice FROM part WHERE p_brand IN ('Brand#2', 'Brand#3'))
SELECT id, 'mysql_table_schema' AS measurement, 'rows' AS field, p_size::DOUBLE AS value FROM p
UNION ALL SELECT id, 'mysql_table_schema', 'data_length', p_retailprice FROM p
UNION ALL SELECT id, 'mysql_table_schema', 'index_length', CASE WHEN p_size % 3 = 0 THEN p_size ELSE 0 END FROM p
UNION ALL SELECT id, 'mysql_table_schema', 'data_free', 0 FROM p
UNION ALL SELECT id, 'mysql_table_schema_version', 'table_version', 10 FROM p""")
def table_size_newer_names(spark, d):
    cfg = db.DatabaseConfig(metric_version=2, databases=("Brand#2", "Brand#3"))
    out = to_long(db.table_sizes(_tables(spark, d), cfg).points())
    return out.select(tag("table").cast("bigint").alias("id"), "measurement", "field", F.col("f").alias("value"))


@query("digest_topk", """
SELECT server, digest, left('select ' || o_orderpriority, 9) AS digest_text, wait / 1e12 AS seconds FROM (
  SELECT *, row_number() OVER (PARTITION BY server ORDER BY wait DESC, digest) AS rn FROM (
    SELECT 's' || (o_custkey % 50) AS server, CAST(o_orderkey AS VARCHAR) AS digest, o_orderpriority, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) * 1e10 AS wait
    FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate > TIMESTAMP '1998-08-01' - INTERVAL 1000 DAY) q) r WHERE rn <= 5""")
def digest_topk(spark, d):
    orders = load(spark, d, "orders")
    ones = [F.lit(1.0).alias(c) for c in ("count_star", "sum_errors", "sum_warnings", "sum_rows_affected", "sum_rows_sent", "sum_rows_examined",
                                          "sum_created_tmp_disk_tables", "sum_created_tmp_tables", "sum_sort_merge_passes", "sum_sort_rows", "sum_no_index_used")]
    rows = orders.select(
        joined("s", F.col("o_custkey") % 50).alias("server"), F.lit("1998-08-01 00:00:00").cast("timestamp_ntz").alias("c"),
        F.when(F.col("o_orderstatus") == "F", "mysql").otherwise("shop").alias("schema_name"), F.col("o_orderkey").cast("string").alias("digest"),
        joined("select ", F.col("o_orderpriority")).alias("digest_text"), utc(F.col("o_orderdate")).alias("last_seen"),
        (F.round(F.col("o_totalprice") * 100).cast("bigint").cast("double") * 1e10).alias("sum_timer_wait"), *ones)
    rows = rows.withColumn("collected_at", utc(F.col("c"))).drop("c")
    cfg = db.DatabaseConfig(digest_text_limit=9, digest_limit=5, digest_time_limit=1000 * 86400)
    table = db.statement_digests({"statement_digests": rows}, cfg).table
    return table.select("server", "digest", "digest_text", F.col("events_statements_seconds_total").alias("seconds"))


def _history(spark, d, orders=None):
    nations = load(spark, d, "nation")
    uptime = at(nations.select("n_nationkey", (F.col("n_nationkey") + 86400).cast("double").alias("uptime_seconds")), joined("s", F.col("n_nationkey"))).drop("n_nationkey")
    owners = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    orders = load(spark, d, "orders") if orders is None else orders
    start = (F.col("o_orderkey") % 80000) * 1000003 * 1000000
    rows = at(orders.select(
        F.col("o_custkey").alias("thread_id"), F.col("o_orderkey").alias("event_id"), start.alias("timer_start"), (start + 5 * 10**11).alias("timer_end"),
        F.lit(5 * 10**11).alias("timer_wait"), F.when(F.col("o_orderpriority") == "5-LOW", "statement/com/Ping").otherwise("statement/sql/select").alias("event_name"),
        F.when(F.col("o_orderstatus") == "F", "mysql").otherwise("shop").alias("current_schema"), joined("select ", F.col("o_orderkey")).alias("sql_text"),
        F.when(F.col("o_orderkey") % 11 != 0, "select ?").alias("digest_text"), F.col("o_orderstatus").alias("digest")), joined("s", F.col("thread_id") % 25))
    threads = at(load(spark, d, "customer").select(
        F.col("c_custkey").alias("thread_id"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("processlist_user"),
        joined("h", F.col("c_nationkey")).alias("processlist_host"), F.lit("shop").alias("processlist_db")), joined("s", F.col("thread_id") % 25))
    stages = at(load(spark, d, "lineitem").join(owners, "l_orderkey").select(
        F.col("o_custkey").alias("thread_id"), F.col("l_orderkey").alias("nesting_event_id"), F.when(F.col("l_returnflag") != "N", F.col("l_linenumber").cast("bigint")).alias("timer_wait"),
        joined("stage/", F.col("l_linenumber")).alias("event_name")), joined("s", F.col("thread_id") % 25))
    return {"statements_history": rows, "threads": threads, "uptime": uptime, "stages_history": stages}


_HISTORY_SQL = """
WITH base AS (SELECT epoch_us(TIMESTAMP '2024-02-01') AS now_us),
st AS (SELECT o_orderkey AS event_id, o_custkey AS thread_id, o_custkey % 25 AS sn, now_us - (86400 + o_custkey % 25) * 1000000 + (o_orderkey % 80000) * 1000003 AS start_us,
  o_orderkey % 11 <> 0 AS has_text, o_orderstatus, o_orderpriority FROM orders, base)
"""


@query("statement_history", _HISTORY_SQL + """
SELECT 's' || sn AS server, event_id, thread_id, start_us, start_us + 500000 AS end_us, 500000000000 AS execution_time, 'select ' || event_id AS sql_text, c_name AS user_name
FROM st JOIN customer ON c_custkey = thread_id WHERE has_text AND o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW' AND c_mktsegment <> 'MACHINERY'""")
def statement_history(spark, d):
    table = db.statements(_history(spark, d)).table
    return table.select("server", "event_id", "thread_id", F.unix_micros("start_time").alias("start_us"), F.unix_micros("end_time").alias("end_us"),
                        "execution_time", "sql_text", F.col("processlist_user").alias("user_name"))


@query("stage_history", _HISTORY_SQL + """
SELECT 's' || sn AS server, event_id, thread_id, start_us + 500000 AS end_us, 'stage/' || l_linenumber AS event_name, l_linenumber::BIGINT AS stage_time
FROM st JOIN lineitem ON l_orderkey = event_id WHERE has_text AND l_returnflag <> 'N'""")
def stage_history(spark, d):
    table = db.stages(_history(spark, d)).table
    return table.select("server", "event_id", "thread_id", F.unix_micros("end_time").alias("end_us"), "event_name", "stage_time")


#: Reports of each user at least six hours after the last one, out of the distinct times in ``t``.
LAST_REPORT_SQL = """
t AS (SELECT DISTINCT user_id, epoch_us(ts) AS us FROM events),
r AS (
  SELECT user_id, min(us) AS us FROM t GROUP BY user_id
  UNION ALL SELECT r.user_id, min(t.us) FROM r JOIN t ON t.user_id = r.user_id AND t.us >= r.us + 21600000000 GROUP BY r.user_id, r.us)
"""


@query("slow_interval", f"""
WITH RECURSIVE {LAST_REPORT_SQL} SELECT event_id FROM events JOIN r ON r.user_id = events.user_id AND r.us = epoch_us(ts)""")
def slow_interval(spark, d):
    rows = events(spark, d).select("event_id", F.col("user_id").alias("server"), F.col("ts").alias("collected_at"))
    return db.slow_snapshots(rows, 21600).select("event_id")


@query("cursor_batch", """
WITH c AS (SELECT user_id, min(ts) + INTERVAL 10 DAY AS cur FROM events WHERE user_id % 3 <> 0 GROUP BY user_id)
SELECT e.user_id AS server, count(*) AS n, epoch_us(max(e.ts)) AS next_us FROM events e LEFT JOIN c ON e.user_id = c.user_id
WHERE e.ts > coalesce(cur, TIMESTAMP '2024-01-20') GROUP BY e.user_id""")
def cursor_batch(spark, d):
    rows = events(spark, d).select("event_id", F.col("user_id").alias("server"), F.col("ts").alias("end_time"))
    cursors = rows.filter(F.col("server") % 3 != 0).groupBy("server").agg((F.min("end_time") + F.expr("INTERVAL 10 DAYS")).alias("end_time"))
    new = db.after_cursor(rows, cursors, start=datetime(2024, 1, 20, tzinfo=timezone.utc))
    counts = new.groupBy("server").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(db.next_cursor(new), "server").select("server", "n", F.unix_micros("end_time").alias("next_us"))
