"""Fixed tables of the collectors and the expressions that read them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The thread states a process list is counted by.
THREAD_STATES = (
    "after create", "altering table", "analyzing", "checking permissions", "checking table",
    "cleaning up", "closing tables", "converting heap to myisam", "copying to tmp table",
    "creating sort index", "creating table", "creating tmp table", "deleting", "executing",
    "execution of init_command", "end", "freeing items", "flushing tables",
    "fulltext initialization", "idle", "init", "killed", "waiting for lock", "logging slow query",
    "login", "manage keys", "opening tables", "optimizing", "preparing", "reading from net",
    "removing duplicates", "removing tmp table", "reopen tables", "repair by sorting",
    "repair done", "repair with keycache", "replication master", "rolling back",
    "searching rows for update", "sending data", "sorting for group", "sorting for order",
    "sorting index", "sorting result", "statistics", "updating", "waiting for tables",
    "waiting for table flush", "waiting on cond", "writing to net", "other",
)

# Other states and the counted state each belongs to.
STATE_ALIASES = {
    "user sleep": "idle",
    "creating index": "altering table",
    "committing alter table to storage engine": "altering table",
    "discard or import tablespace": "altering table",
    "rename": "altering table",
    "setup": "altering table",
    "renaming result table": "altering table",
    "preparing for alter table": "altering table",
    "copying to group table": "copying to tmp table",
    "copy to tmp table": "copying to tmp table",
    "query end": "end",
    "update": "updating",
    "updating main table": "updating",
    "updating reference tables": "updating",
    "system lock": "waiting for lock",
    "user lock": "waiting for lock",
    "table lock": "waiting for lock",
    "deleting from main table": "deleting",
    "deleting from reference tables": "deleting",
}

# Status-name prefixes that are exported. The exported prefix is the lower-cased one,
# but for the three listed below.
STATUS_PREFIXES = (
    "Aborted_", "Bytes_", "Com_", "Created_", "Handler_", "Innodb_", "Key_", "Open_", "Opened_",
    "Qcache_", "Table_", "Tokudb_", "Threads_", "Access_", "Aria__", "Binlog__", "Busy_",
    "Connection_", "Delayed_", "Empty_", "Executed_", "Feature_", "Flush_", "Last_", "Master_",
    "Max_", "Memory_", "Not_", "Performance_", "Prepared_", "Rows_", "Rpl_", "Select_", "Slave_",
    "Slow_", "Sort_", "Subquery_", "Tc_", "Threadpool_", "wsrep_", "Uptime_",
)
STATUS_RENAMED = {"Com_": "commands_", "Aria__": "aria_", "Binlog__": "binlog_"}

# Status names exported on their own.
STATUS_PICKS = ("Queries", "Questions", "Slow_queries", "Connections", "Syncs", "Uptime")

# Largest auto-increment value by integer type, signed and unsigned.
INT_BITS = {"tinyint": 7, "smallint": 15, "mediumint": 23, "int": 31, "bigint": 63}

# Cluster health colours.
HEALTH_CODES = {"green": 1, "yellow": 2, "red": 3}

SYSTEM_SCHEMAS = ("mysql", "performance_schema", "information_schema")


def literal_map(pairs: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def thread_state(command: Column, state: Column) -> Column:
    """The counted state of a thread, from its command and raw state."""
    cmd = F.replace(F.lower(F.coalesce(command, F.lit(""))), F.lit("_"), F.lit(" "))
    st = F.replace(F.lower(F.coalesce(state, F.lit(""))), F.lit("_"), F.lit(" "))
    known = {s: s for s in THREAD_STATES} | STATE_ALIASES
    rule = (F.when(st.contains("waiting for") & st.contains("lock"), "waiting for lock")
            .when((cmd == "sleep") & (st == ""), "idle")
            .when(cmd == "query", "executing")
            .when(cmd == "binlog dump", "replication master")
            .otherwise("other"))
    return F.coalesce(F.try_element_at(literal_map(known), st), rule)


def status_name(name: Column) -> Column:
    """Exported name of a status variable by prefix rule, or NULL.

    Every rule's prefix ends at the first underscore, or at a double one for two of them, so the rules
    are two literal lookups instead of one test per rule.
    """
    rules = literal_map({p: STATUS_RENAMED.get(p, p.lower()) for p in STATUS_PREFIXES})
    prefix = F.regexp_extract(name, r"\A([^_]*__)", 1)
    single = F.regexp_extract(name, r"\A([^_]*_)", 1)

    def applied(p: Column) -> Column:
        return F.concat(F.try_element_at(rules, p), F.substring(name, F.length(p) + 1, F.length(name)))

    return F.coalesce(applied(prefix), applied(single))


def auto_increment_max(data_type: Column, column_type: Column) -> Column:
    """Largest value of an integer column: ``2^(bits + unsigned) - 1``, exact; NULL for other types."""
    unsigned = column_type.endswith(" unsigned")
    out = F.lit(None).cast("decimal(20,0)")
    for name, bits in INT_BITS.items():
        limit = F.when(unsigned, F.lit(str(2 ** (bits + 1) - 1))).otherwise(F.lit(str(2 ** bits - 1)))
        out = F.when(data_type == name, limit.cast("decimal(20,0)")).otherwise(out)
    return out


def health_code(status: Column) -> Column:
    low = F.lower(status)
    out = F.lit(0)
    for colour, code in HEALTH_CODES.items():
        out = F.when(low == colour, F.lit(code)).otherwise(out)
    return out
