"""Schemas and readers of landed data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SNAPSHOT = "source string, server string, endpoint string, collected_at timestamp, payload string"
_KEYS = "server string, collected_at timestamp"

USER_COUNTERS = (
    "total_connections", "concurrent_connections", "connected_time", "busy_time", "cpu_time",
    "bytes_received", "bytes_sent", "binlog_bytes_written", "rows_fetched", "rows_updated",
    "table_rows_read", "select_commands", "update_commands", "other_commands",
    "commit_transactions", "rollback_transactions", "denied_connections", "lost_connections",
    "access_denied", "empty_queries", "total_ssl_connections",
)
IO_OPS = ("fetch", "insert", "update", "delete")
LOCK_MODES = (
    "read_normal", "read_with_shared_locks", "read_high_priority", "read_no_insert",
    "read_external", "write_allow_write", "write_concurrent_insert", "write_low_priority",
    "write_normal", "write_external",
)
DIGEST_TOTALS = (
    "count_star", "sum_timer_wait", "sum_errors", "sum_warnings", "sum_rows_affected",
    "sum_rows_sent", "sum_rows_examined", "sum_created_tmp_disk_tables", "sum_created_tmp_tables",
    "sum_sort_merge_passes", "sum_sort_rows", "sum_no_index_used",
)


def _doubles(names) -> str:
    return ", ".join(f"{n} double" for n in names)


_IO = _doubles([f"{p}_{op}" for p in ("count", "sum_timer") for op in IO_OPS])

#: Landed table name to its schema. Every table also has ``server`` and ``collected_at``.
TABLES = {name: f"{_KEYS}, {cols}" for name, cols in {
    "global_status": "pos bigint, name string, value string",
    "global_variables": "pos bigint, name string, value string",
    "binary_logs": "file string, size decimal(20,0)",
    "processlist": "id bigint, user string, command string, state string",
    "user_statistics": "user string, " + ", ".join(f"{c} bigint" for c in USER_COUNTERS),
    "tables": "table_schema string, table_name string, table_type string, engine string, row_format string, "
              "create_options string, version double, table_rows double, data_length double, "
              "index_length double, data_free double, auto_increment decimal(20,0)",
    "columns": "table_schema string, table_name string, column_name string, data_type string, "
               "column_type string, extra string",
    "schemata": "schema_name string",
    "innodb_metrics": "pos bigint, name string, count string, status string",
    "table_io_waits": f"object_schema string, object_name string, {_IO}",
    "index_io_waits": f"object_schema string, object_name string, index_name string, {_IO}",
    "table_lock_waits": "object_schema string, object_name string, "
                        + _doubles([f"{p}_{m}" for p in ("count", "sum_timer") for m in LOCK_MODES]),
    "statement_digests": "schema_name string, digest string, digest_text string, last_seen timestamp, "
                         + _doubles(DIGEST_TOTALS),
    "event_waits": "event_name string, count_star double, sum_timer_wait double",
    "file_events": "event_name string, count_read double, sum_timer_read double, sum_number_of_bytes_read double, "
                   "count_write double, sum_timer_write double, sum_number_of_bytes_write double, "
                   "count_misc double, sum_timer_misc double",
    "statements_history": "thread_id bigint, event_id bigint, timer_start bigint, timer_end bigint, "
                          "timer_wait bigint, event_name string, current_schema string, sql_text string, "
                          "digest_text string, digest string",
    "stages_history": "thread_id bigint, nesting_event_id bigint, timer_wait bigint, event_name string",
    "threads": "thread_id bigint, processlist_user string, processlist_host string, processlist_db string",
    "uptime": "uptime_seconds double",
}.items()}
TABLES |= {
    "broker_offsets": f"{_KEYS}, topic string, partition int, oldest boolean, offset bigint, err int",
    "topic_partitions": f"{_KEYS}, topic string, partition int, leader int, replicas array<int>, "
                        "isr array<int>, topic_err int, partition_err int",
    "group_offsets": f"{_KEYS}, group string, topic string, partition int, offset bigint, err int",
}

# Where the database keeps each landed table.
CATALOG = {
    "global_status": "performance_schema.global_status",
    "global_variables": "performance_schema.global_variables",
    "processlist": "information_schema.processlist",
    "user_statistics": "information_schema.user_statistics",
    "tables": "information_schema.tables",
    "columns": "information_schema.columns",
    "schemata": "information_schema.schemata",
    "innodb_metrics": "information_schema.innodb_metrics",
    "table_io_waits": "performance_schema.table_io_waits_summary_by_table",
    "index_io_waits": "performance_schema.table_io_waits_summary_by_index_usage",
    "table_lock_waits": "performance_schema.table_lock_waits_summary_by_table",
    "statement_digests": "performance_schema.events_statements_summary_by_digest",
    "event_waits": "performance_schema.events_waits_summary_global_by_event_name",
    "file_events": "performance_schema.file_summary_by_event_name",
    "statements_history": "performance_schema.events_statements_history_long",
    "stages_history": "performance_schema.events_stages_history_long",
    "threads": "performance_schema.threads",
}


def read_snapshots(
    spark: SparkSession, path: str, *, source: str | None = None, endpoint: str | None = None,
    since=None, until=None, fmt: str = "parquet",
) -> DataFrame:
    """Snapshot rows; the conditions prune partitions and reach the scan."""
    df = spark.read.format(fmt).schema(SNAPSHOT).load(path)
    if source is not None:
        df = df.filter(F.col("source") == source)
    if endpoint is not None:
        df = df.filter(F.col("endpoint") == endpoint)
    if since is not None:
        df = df.filter(F.col("collected_at") >= F.lit(since))
    if until is not None:
        df = df.filter(F.col("collected_at") < F.lit(until))
    return df


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A landed system table with its declared schema."""
    return spark.read.format(fmt).schema(TABLES[name]).load(path)


def jdbc_table(spark: SparkSession, url: str, name: str, server: str, collected_at, **options: str) -> DataFrame:
    """A system table straight from the database; needs its JDBC driver on the class path.

    Filters and column lists reach the database; pass partitioning options to read in parallel.
    """
    df = spark.read.format("jdbc").option("url", url).option("dbtable", CATALOG[name]).options(**options).load()
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.withColumns({"server": F.lit(server), "collected_at": F.lit(collected_at)})


def table_or_empty(spark: SparkSession, table: str, name: str) -> DataFrame:
    """A catalog table, or no rows of the declared schema when the server does not have it."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], TABLES[name])


def write_points(df: DataFrame, path: str, mode: str = "append") -> None:
    """Points as Parquet, laid out by source and day so later reads prune.

    Rows are rebalanced first: small folders get one file, and a source with most of the points is split over
    many tasks.
    """
    (df.withColumn("day", F.to_date("ts")).hint("rebalance", "source", "day")
     .write.mode(mode).partitionBy("source", "day").parquet(path))
