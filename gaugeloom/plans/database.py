"""Database server reports over landed system tables.

One plan covers all servers and all collection times: ``server`` and ``collected_at`` are part of every key.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.functions.lookups import (
    STATUS_PICKS, SYSTEM_SCHEMAS, THREAD_STATES, auto_increment_max, status_name, thread_state,
)
from gaugeloom.functions.maps import last_wins
from gaugeloom.functions.text import dsn_server, namespace
from gaugeloom.functions.times import newer_than, seconds, wall_clock
from gaugeloom.functions.values import int_field, parse_value, strict_int, string_field
from gaugeloom.model import Report, Result, error_rows, no_errors
from gaugeloom.operators.gates import elapsed_gate
from gaugeloom.operators.points import make_point, map_point
from gaugeloom.operators.reshape import collect_fields, field_chunks, first_row, top_rows, unpivot
from gaugeloom.sources.landing import DIGEST_TOTALS, IO_OPS, LOCK_MODES, USER_COUNTERS

SOURCE = "mysql"
KEYS = ["server", "collected_at"]
Tables = Mapping[str, DataFrame]

# The statement kinds that are reported.
STATEMENT_EVENTS = (
    "statement/sql/select", "statement/sql/update", "statement/sql/insert", "statement/sql/delete")


@dataclass(frozen=True)
class DatabaseConfig:
    metric_version: int = 1
    server_is_dsn: bool = False
    own_connection: int | None = None
    databases: tuple[str, ...] = ()
    digest_text_limit: int = 120
    digest_limit: int = 250
    digest_time_limit: int = 86400
    slow_interval_seconds: int = 0
    stage_join_by_event_only: bool = False


def _table(tables: Tables, name: str, cfg: DatabaseConfig) -> DataFrame:
    df = tables[name]
    return df.withColumn("server", dsn_server(F.col("server"))) if cfg.server_is_dsn else df


def _not_system(col: str, schemas=SYSTEM_SCHEMAS) -> Column:
    """SQL NOT IN: rows without a schema are left out as well."""
    return ~F.col(col).isin(*schemas)


def _perf_name(v1: str, v2: str, cfg: DatabaseConfig) -> str:
    return v1 if cfg.metric_version < 2 else v2


def _server_tag(df: DataFrame) -> Column:
    return F.create_map(F.lit("server"), F.col("server"))


def _atoi(text: Column) -> Column:
    """Whole number, clamped to 64 bits; anything else is 0."""
    whole = text.rlike(r"\A[+-]?[0-9]+\z")
    clamped = F.when(text.startswith("-"), F.lit(-(2 ** 63))).otherwise(F.lit(2 ** 63 - 1))
    return F.when(whole, F.coalesce(strict_int(text), clamped)).otherwise(F.lit(0))


def status_fields(status: DataFrame, cfg: DatabaseConfig) -> DataFrame:
    """Status rows with the exported ``field`` name and its ``parsed`` value; both NULL when not exported."""
    name, value = F.col("name"), F.col("value")
    if cfg.metric_version >= 2:
        return status.withColumns({"field": F.lower(name), "parsed": parse_value(value, 2)})
    mapped = status_name(name)
    picked = name.isin(*STATUS_PICKS)
    return status.withColumns({
        "field": F.coalesce(mapped, F.when(picked, F.lower(name))),
        "parsed": F.when(mapped.isNotNull(), int_field(_atoi(value))).when(picked, int_field(strict_int(value)))})


def global_status(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Result:
    rows = status_fields(_table(tables, "global_status", cfg), cfg)
    points = collect_fields(rows, KEYS, "pos", "field", "parsed")
    bad = rows.filter(F.col("field").isNotNull() & F.col("parsed").isNull())
    if cfg.metric_version >= 2:
        bad = bad.filter(F.lit(False))
    errors = error_rows(bad, SOURCE, F.concat(
        F.lit("parsing "), F.col("name"), F.lit(" int value: "), F.coalesce(F.col("value"), F.lit("null"))),
        server=F.col("server"), endpoint=F.lit("global_status"), ts=F.col("collected_at"))
    return Result(map_point(points, "mysql", _server_tag(points), F.col("fields"), F.col("collected_at"),
                            source=SOURCE), errors)


def slow_snapshots(df: DataFrame, interval_seconds: int, ts: str = "collected_at") -> DataFrame:
    """Keep a server's first snapshot and each one at least the interval after the last kept; all its rows stay."""
    return elapsed_gate(df, interval_seconds, ts)


def global_variables(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Result:
    """Variables in points of 20; version texts are fields and also tags of all the snapshot's points."""
    rows = _table(tables, "global_variables", cfg)
    if cfg.slow_interval_seconds >= 1:
        rows = slow_snapshots(rows, cfg.slow_interval_seconds)
    field = F.lower("name")
    version = field.contains("version")
    named = rows.withColumns({
        "field": field, "version": version,
        "parsed": F.coalesce(parse_value(F.col("value"), cfg.metric_version), F.when(version, string_field(F.col("value"))))})
    chunks = field_chunks(named, KEYS, "pos", "field", "parsed")
    versions = named.filter("version").groupBy(*KEYS).agg(last_wins(F.sort_array(F.collect_list(
        F.struct("pos", F.col("field").alias("k"), F.col("value").alias("v"))))).alias("_versions"))
    joined = chunks.join(versions, KEYS, "left")
    tags = F.map_concat(_server_tag(joined), F.coalesce("_versions", F.expr("map()").cast("map<string,string>")))
    return Result(map_point(joined, "mysql_variables", tags, F.col("fields"), F.col("collected_at"), source=SOURCE),
                  no_errors(rows.sparkSession))


def replication(tables: Tables, cfg: DatabaseConfig = DatabaseConfig(), order: str | None = None) -> Result:
    """The first replication row of a snapshot; every column is a field, found at run time."""
    rows = _table(tables, "slave_status", cfg)
    columns = [c for c in rows.columns if c not in KEYS and c != order]
    # Without a position every column orders the rows, so that the same one is taken in each run.
    one = first_row(rows, KEYS, [F.col(f"`{c}`") for c in ([order] if order else columns)])
    fields = {f"slave_{c.lower()}": parse_value(F.col(f"`{c}`").cast("string"), cfg.metric_version) for c in columns}
    points = make_point(one, "mysql", {"server": F.col("server")}, fields, F.col("collected_at"), source=SOURCE)
    return Result(points, no_errors(rows.sparkSession))


def binary_logs(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """Bytes and number of log files; a snapshot listed in ``servers`` without any file gets zeros."""
    logs = _table(tables, "binary_logs", cfg)
    totals = logs.groupBy(*KEYS).agg(
        F.least(F.sum("size"), F.lit(str(2**64 - 1)).cast("decimal(20,0)")).cast("decimal(20,0)").alias("binary_size_bytes"), F.count(F.lit(1)).alias("binary_files_count"))
    if "servers" in tables:
        totals = _table(tables, "servers", cfg).select(*KEYS).join(totals, KEYS, "left")
    zero = F.lit(0).cast("decimal(20,0)")
    totals = totals.withColumns({
        "binary_size_bytes": F.coalesce("binary_size_bytes", zero),
        "binary_files_count": F.coalesce("binary_files_count", F.lit(0))})
    return Report("mysql", totals, {"server": "server"},
                  {c: c for c in ("binary_size_bytes", "binary_files_count")}, SOURCE)


def _connections(tables: Tables, cfg: DatabaseConfig) -> DataFrame:
    return _table(tables, "processlist", cfg)


def process_list(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """Threads per state, one row per snapshot with all states, zeros included.

    The collector's own thread is counted as none rather than left out, and snapshots listed in ``servers`` get a row without any
    thread, so an idle server is reported too.
    """
    rows = _connections(tables, cfg)
    counts = F.lit(True) if cfg.own_connection is None else F.col("id").isNull() | (F.col("id") != cfg.own_connection)
    counted = rows.groupBy(*KEYS, "command", "state").agg(F.count_if(counts).alias("n"))
    mapped = counted.withColumn("thread_state", thread_state(F.col("command"), F.col("state")))
    names = {s: f"threads_{s.replace(' ', '_')}" for s in THREAD_STATES}
    wide = mapped.groupBy(*KEYS).agg(*[
        F.coalesce(F.sum(F.when(F.col("thread_state") == s, F.col("n"))), F.lit(0)).alias(n) for s, n in names.items()])
    if "servers" in tables:
        wide = _table(tables, "servers", cfg).select(*KEYS).distinct().join(wide, KEYS, "left").fillna(0, list(names.values()))
    return Report(_perf_name("mysql_info_schema", "mysql_process_list", cfg), wide, {"server": "server"},
                  {n: n for n in names.values()}, SOURCE)


def user_connections(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    rows = _connections(tables, cfg).groupBy(*KEYS, "user").agg(F.count(F.lit(1)).alias("connections"))
    return Report("mysql_users", rows, {"server": "server", "user": "user"}, {"connections": "connections"}, SOURCE)


def user_statistics(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """One row per user; emitted once even when both user reports are asked for."""
    rows = _table(tables, "user_statistics", cfg).groupBy(*KEYS, "user").agg(
        *[F.first(c).alias(c) for c in USER_COUNTERS])
    return Report("mysql_user_stats", rows, {"server": "server", "user": "user"}, {c: c for c in USER_COUNTERS}, SOURCE)


def auto_increment(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """Auto-increment counters and their type's ceiling."""
    names = ["server", "collected_at", "table_schema", "table_name"]
    counters = _table(tables, "tables", cfg).filter(F.col("auto_increment").isNotNull()).select(*names, "auto_increment")
    columns = _table(tables, "columns", cfg).filter(F.col("extra") == "auto_increment").select(
        *names, "column_name", auto_increment_max(F.col("data_type"), F.col("column_type")).alias("auto_increment_max"))
    rows = counters.join(columns, names)
    return Report(
        _perf_name("mysql_info_schema", "mysql_table_schema", cfg), rows,
        {"server": "server", "schema": "table_schema", "table": "table_name", "column": "column_name"},
        {"auto_increment_column": "auto_increment", "auto_increment_column_max": "auto_increment_max"}, SOURCE)


def innodb_metrics(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Result:
    rows = _table(tables, "innodb_metrics", cfg).filter(F.col("status") == "enabled").select(
        *KEYS, "pos", F.lower("name").alias("field"), parse_value(F.col("count"), cfg.metric_version).alias("parsed"))
    chunks = field_chunks(rows, KEYS, "pos", "field", "parsed")
    return Result(map_point(chunks, "mysql_innodb", _server_tag(chunks), F.col("fields"), F.col("collected_at"),
                            source=SOURCE), no_errors(rows.sparkSession))


def table_io_waits(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    rows = _table(tables, "table_io_waits", cfg).filter(_not_system("object_schema", SYSTEM_SCHEMAS[:2]))
    out = rows.select(
        *KEYS, "object_schema", "object_name",
        *[F.col(f"count_{op}").alias(f"table_io_waits_total_{op}") for op in IO_OPS],
        *[seconds(F.col(f"sum_timer_{op}")).alias(f"table_io_waits_seconds_total_{op}") for op in IO_OPS])
    return Report("mysql_perf_schema", out, {"server": "server", "schema": "object_schema", "name": "object_name"},
                  {c: c for c in out.columns[4:]}, SOURCE)


def index_io_waits(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """Fetches of every index; writes only for the row that stands for no index."""
    rows = _table(tables, "index_io_waits", cfg).filter(_not_system("object_schema", SYSTEM_SCHEMAS[:2]))
    index = F.coalesce("index_name", F.lit("NONE"))

    def shown(op: str, value: Column) -> Column:
        return value if op == "fetch" else F.when(index == "NONE", value)

    out = rows.select(
        *KEYS, "object_schema", "object_name", index.alias("index_name"),
        *[shown(op, F.col(f"count_{op}")).alias(f"index_io_waits_total_{op}") for op in IO_OPS],
        *[shown(op, seconds(F.col(f"sum_timer_{op}"))).alias(f"index_io_waits_seconds_total_{op}") for op in IO_OPS])
    return Report("mysql_perf_schema", out, {
        "server": "server", "schema": "object_schema", "name": "object_name", "index": "index_name"},
        {c: c for c in out.columns[5:]}, SOURCE)


def lock_waits(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """Four rows per table: counts and seconds of SQL locks and of external locks."""
    rows = _table(tables, "table_lock_waits", cfg).filter(_not_system("object_schema"))
    inner = [m for m in LOCK_MODES if not m.endswith("_external")]
    timed = rows.select(*KEYS, "object_schema", "object_name", *[f"count_{m}" for m in LOCK_MODES],
                        *[seconds(F.col(f"sum_timer_{m}")).alias(f"seconds_{m}") for m in LOCK_MODES])
    shape = {}
    for suffix, prefix in (("total", "count"), ("seconds_total", "seconds")):
        shape[f"sql_lock_waits_{suffix}"] = {m: f"{prefix}_{m}" for m in inner}
        shape[f"external_lock_waits_{suffix}"] = {
            "read": f"{prefix}_read_external", "write": f"{prefix}_write_external"}
    out = unpivot(timed, [*KEYS, "object_schema", "object_name"], "perf_query", shape)
    return Report("mysql_perf_schema", out, {
        "server": "server", "schema": "object_schema", "table": "object_name", "perf_query": "perf_query"},
        {c: c for c in [*inner, "read", "write"]}, SOURCE)


def event_waits(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    out = _table(tables, "event_waits", cfg).select(
        *KEYS, "event_name", F.col("count_star").alias("events_waits_total"),
        seconds(F.col("sum_timer_wait")).alias("events_waits_seconds_total"))
    return Report("mysql_perf_schema", out, {"server": "server", "event_name": "event_name"},
                  {c: c for c in out.columns[3:]}, SOURCE)


def file_events(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """Three rows per event: read, write and misc; only the first two have bytes."""
    modes = ("misc", "read", "write")
    rows = _table(tables, "file_events", cfg).withColumns(
        {f"seconds_{m}": seconds(F.col(f"sum_timer_{m}")) for m in modes})
    shape = {m: {"file_events_total": f"count_{m}", "file_events_seconds_total": f"seconds_{m}"} for m in modes}
    for m in modes[1:]:
        shape[m]["file_events_bytes_totals"] = f"sum_number_of_bytes_{m}"
    out = unpivot(rows, [*KEYS, "event_name"], "mode", shape)
    return Report("mysql_perf_schema", out, {"server": "server", "event_name": "event_name", "mode": "mode"},
                  {c: c for c in out.columns[4:]}, SOURCE)


def statement_digests(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """The slowest statement digests of every snapshot seen within the time limit."""
    recent = _table(tables, "statement_digests", cfg).filter(
        _not_system("schema_name") & newer_than(F.col("last_seen"), F.col("collected_at"), cfg.digest_time_limit))
    top = top_rows(recent, KEYS, [F.desc("sum_timer_wait"), F.asc("schema_name"), F.asc("digest")], cfg.digest_limit)
    names = {
        "count_star": "total", "sum_errors": "errors_total", "sum_warnings": "warnings_total",
        "sum_rows_affected": "rows_affected_total", "sum_rows_sent": "rows_sent_total",
        "sum_rows_examined": "rows_examined_total", "sum_created_tmp_tables": "tmp_tables_total",
        "sum_created_tmp_disk_tables": "tmp_disk_tables_total",
        "sum_sort_merge_passes": "sort_merge_passes_total", "sum_sort_rows": "sort_rows_total",
        "sum_no_index_used": "no_index_used_total", "sum_timer_wait": "seconds_total"}
    out = top.select(
        *KEYS, F.coalesce("schema_name", F.lit("NONE")).alias("schema_name"), "digest",
        F.left("digest_text", F.lit(cfg.digest_text_limit)).alias("digest_text"),
        *[(seconds(F.col(c)) if c == "sum_timer_wait" else F.col(c)).alias(f"events_statements_{names[c]}")
          for c in DIGEST_TOTALS])
    return Report("mysql_perf_schema", out, {
        "server": "server", "schema": "schema_name", "digest": "digest", "digest_text": "digest_text"},
        {c: c for c in out.columns[5:]}, SOURCE)


def table_sizes(tables: Tables, cfg: DatabaseConfig = DatabaseConfig()) -> Report:
    """Five rows per table: row count, three sizes and the table version with its own tags."""
    rows = _table(tables, "tables", cfg)
    if cfg.databases:
        rows = rows.filter(F.col("table_schema").isin(*cfg.databases))
    elif "schemata" in tables:
        listed = _table(tables, "schemata", cfg).filter(_not_system("schema_name"))
        rows = rows.join(listed.select(*KEYS, F.col("schema_name").alias("table_schema")),
                         [*KEYS, "table_schema"], "left_semi")
    else:
        rows = rows.filter(_not_system("table_schema"))
    parts = ("table_rows", "data_length", "index_length", "data_free", "version")
    filled = rows.select(
        *KEYS, "table_schema", "table_name", "table_type",
        *[F.coalesce(c, F.lit("NONE")).alias(c) for c in ("engine", "row_format", "create_options")],
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in parts])
    v1 = cfg.metric_version < 2
    field_of_part = {p: ("value" if v1 else {"table_rows": "rows", "version": "table_version"}.get(p, p)) for p in parts}
    out = unpivot(filled, [*KEYS, "table_schema", "table_name", "table_type", "engine", "row_format", "create_options"],
                  "part", {p: {field_of_part[p]: p} for p in parts})
    part = F.col("part")
    if v1:
        name = (F.when(part == "table_rows", namespace("info_schema", "table_rows"))
                .when(part == "version", namespace("info_schema", "table_version"))
                .otherwise(namespace("info_schema", "table_size", part)))
    else:
        name = F.when(part == "version", "mysql_table_schema_version").otherwise("mysql_table_schema")
    component = F.when(part.isin("data_length", "index_length", "data_free"), part) if v1 else F.lit(None).cast("string")
    versioned = {c: F.when(part == "version", F.col(c)) for c in ("table_type", "engine", "row_format", "create_options")}
    out = out.withColumns({"measurement": name, "component": component, **versioned})
    return Report(F.col("measurement"), out, {
        "server": "server", "schema": "table_schema", "table": "table_name", "component": "component",
        "type": "table_type", "engine": "engine", "row_format": "row_format", "create_options": "create_options"},
        {f: f for f in dict.fromkeys(field_of_part.values())}, SOURCE)


def _timed_statements(tables: Tables, cfg: DatabaseConfig) -> DataFrame:
    """Statement history with wall-clock start and end times, which are NULL where no uptime landed. One uptime counts for a snapshot."""
    rows = _table(tables, "statements_history", cfg)
    uptime = _table(tables, "uptime", cfg).groupBy(*KEYS).agg(F.max("uptime_seconds").alias("uptime_seconds"))
    clock = {new: wall_clock(F.col("collected_at"), F.col("uptime_seconds"), F.col(old))
             for new, old in (("start_time", "timer_start"), ("end_time", "timer_end"))}
    return rows.join(uptime, KEYS, "left").withColumns(clock)


def _without_uptime(timed: DataFrame) -> DataFrame:
    return error_rows(timed.filter(F.col("uptime_seconds").isNull()), SOURCE, F.lit("no uptime for the snapshot"),
                      server=F.col("server"), ts=F.col("collected_at"))


def after_cursor(df: DataFrame, cursors: DataFrame | None, start=None) -> DataFrame:
    """Rows that ended after their server's cursor; servers without one use ``start``, or keep all rows."""
    floor = F.lit(start).cast("timestamp")
    if cursors is None:
        return df if start is None else df.filter(F.col("end_time") > floor)
    joined = df.join(cursors.select("server", F.col("end_time").alias("_cursor")), "server", "left")
    limit = F.coalesce(F.col("_cursor"), floor)
    return joined.filter(limit.isNull() | (F.col("end_time") > limit)).drop("_cursor")


def next_cursor(df: DataFrame, cursors: DataFrame | None = None) -> DataFrame:
    """Latest end time per server, never moving back."""
    seen = df.select("server", "end_time")
    if cursors is not None:
        seen = seen.unionByName(cursors.select("server", "end_time"))
    return seen.groupBy("server").agg(F.max("end_time").alias("end_time"))


def _time_text(name: str) -> Column:
    """Microsecond text in the session's zone, which is UTC unless it was changed."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def statements(tables: Tables, cfg: DatabaseConfig = DatabaseConfig(), cursors: DataFrame | None = None,
               start=None) -> Report:
    """Finished data statements with the user, host and database of their thread."""
    wanted = _timed_statements({**tables, "statements_history": tables["statements_history"].filter(
        F.col("digest_text").isNotNull() & _not_system("current_schema") & F.col("event_name").isin(*STATEMENT_EVENTS))}, cfg)
    threads = _table(tables, "threads", cfg).select(
        *KEYS, "thread_id", "processlist_user", "processlist_host", "processlist_db")
    joined = (after_cursor(wanted.filter(F.col("uptime_seconds").isNotNull()), cursors, start).join(threads, [*KEYS, "thread_id"], "left")
              .filter(F.col("processlist_user").isNotNull()))
    out = joined.select(
        *KEYS, "thread_id", "event_id", "start_time", "end_time", "current_schema", F.col("timer_wait").alias("execution_time"),
        "digest_text", "digest", "sql_text", "processlist_user", "processlist_host", "processlist_db",
        _time_text("start_time").alias("start_text"), _time_text("end_time").alias("end_text"))
    fields = ["server", "current_schema", "thread_id", "event_id", "execution_time", "digest_text", "digest",
              "sql_text", "processlist_user", "processlist_host", "processlist_db"]
    return Report("eventStatement", out, {}, {
        "start_time": "start_text", "end_time": "end_text", **{c: c for c in fields}}, SOURCE, _without_uptime(wanted))


def stages(tables: Tables, cfg: DatabaseConfig = DatabaseConfig(), cursors: DataFrame | None = None,
           start=None) -> Report:
    """Statement stages. Event numbers are per thread, so the thread is part of the join unless told otherwise."""
    wanted = _timed_statements({**tables, "statements_history": tables["statements_history"].filter(
        F.col("digest_text").isNotNull() & F.col("current_schema").isNotNull())}, cfg)
    on = [*KEYS, "event_id"] if cfg.stage_join_by_event_only else [*KEYS, "thread_id", "event_id"]
    stage = _table(tables, "stages_history", cfg).select(
        *KEYS, "thread_id", F.col("nesting_event_id").alias("event_id"), F.col("event_name").alias("stage_name"),
        F.col("timer_wait").alias("stage_time"))
    if cfg.stage_join_by_event_only:
        stage = stage.drop("thread_id")
    joined = (after_cursor(wanted.filter(F.col("uptime_seconds").isNotNull()), cursors, start).join(stage, on, "left")
              .filter(F.col("stage_name").isNotNull() & F.col("stage_time").isNotNull()))
    out = joined.select(
        *KEYS, "thread_id", "event_id", "start_time", "end_time", F.col("timer_wait").alias("sql_time"),
        "digest_text", "digest", F.col("stage_name").alias("event_name"), "stage_time",
        _time_text("start_time").alias("start_text"), _time_text("end_time").alias("end_text"),
        F.lit("event_stage").alias("measurements"))
    fields = ["server", "measurements", "thread_id", "event_id", "sql_time", "digest_text", "digest", "event_name", "stage_time"]
    return Report("eventStage", out, {}, {
        "start_time": "start_text", "end_time": "end_text", **{c: c for c in fields}}, SOURCE, _without_uptime(wanted))


#: Report name to job. Each runs on its own; ``gather`` in the registry joins the chosen ones.
REPORTS = {
    "global_status": global_status, "global_variables": global_variables, "statements": statements,
    "stages": stages, "binary_logs": binary_logs, "process_list": process_list,
    "user_connections": user_connections, "user_statistics": user_statistics, "replication": replication,
    "auto_increment": auto_increment, "innodb_metrics": innodb_metrics, "table_io_waits": table_io_waits,
    "index_io_waits": index_io_waits, "lock_waits": lock_waits, "event_waits": event_waits,
    "file_events": file_events, "statement_digests": statement_digests, "table_sizes": table_sizes,
}
