"""Application server reports over landed XML status replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.functions.maps import once
from gaugeloom.functions.text import unquote
from gaugeloom.functions.values import int_field
from gaugeloom.model import Report, Result, error_rows
from gaugeloom.operators.points import map_point

SOURCE = "tomcat"
KEYS = ["server", "collected_at"]

_POOL = "_name: string, _type: string, _usageInit: bigint, _usageCommitted: bigint, _usageMax: bigint, _usageUsed: bigint"
_THREADS = "_maxThreads: bigint, _currentThreadCount: bigint, _currentThreadsBusy: bigint"
_REQUESTS = ("_maxTime: bigint, _processingTime: bigint, _requestCount: bigint, _errorCount: bigint, "
             "_bytesReceived: bigint, _bytesSent: bigint")
STATUS = (f"jvm struct<memory: struct<_free: bigint, _total: bigint, _max: bigint>, memorypool: array<struct<{_POOL}>>>, "
          f"connector array<struct<_name: string, threadInfo: struct<{_THREADS}>, requestInfo: struct<{_REQUESTS}>>>, "
          "_bad string")

# Connector field names and the attributes they come from.
CONNECTOR_FIELDS = {
    "max_threads": "threadInfo._maxThreads", "current_thread_count": "threadInfo._currentThreadCount",
    "current_threads_busy": "threadInfo._currentThreadsBusy", "max_time": "requestInfo._maxTime",
    "processing_time": "requestInfo._processingTime", "request_count": "requestInfo._requestCount",
    "error_count": "requestInfo._errorCount", "bytes_received": "requestInfo._bytesReceived",
    "bytes_sent": "requestInfo._bytesSent",
}


def _number(path: str) -> Column:
    return F.coalesce(path, F.lit(0))


def _parsed(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = once(snapshots, _d=F.from_xml("payload", STATUS, {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("_d").isNull() | F.col("_d._bad").isNotNull()
    errors = error_rows(rows.filter(bad), SOURCE, F.lit("invalid status reply"), server=F.col("server"),
                        endpoint=F.col("endpoint"), ts=F.col("collected_at"))
    return rows.filter(~bad), errors


def memory(snapshots: DataFrame) -> Report:
    good, errors = _parsed(snapshots)
    table = good.select(*KEYS, *[_number(f"_d.jvm.memory._{c}").alias(c) for c in ("free", "total", "max")])
    return Report("tomcat_jvm_memory", table, {}, {c: c for c in ("free", "total", "max")}, SOURCE, errors)


def memory_pools(snapshots: DataFrame) -> Report:
    good, _ = _parsed(snapshots)
    rows = good.select(*KEYS, F.explode("_d.jvm.memorypool").alias("p"))
    table = rows.select(
        *KEYS, F.col("p._name").alias("name"), F.col("p._type").alias("type"),
        *[_number(f"p._usage{c.capitalize()}").alias(c) for c in ("init", "committed", "max", "used")])
    return Report("tomcat_jvm_memorypool", table, {"name": "name", "type": "type"},
                  {c: c for c in ("init", "committed", "max", "used")}, SOURCE)


def connectors(snapshots: DataFrame) -> Report:
    good, _ = _parsed(snapshots)
    rows = good.select(*KEYS, F.explode("_d.connector").alias("c"))
    table = rows.select(*KEYS, unquote(F.col("c._name")).alias("name"),
                        *[_number(f"c.{path}").alias(out) for out, path in CONNECTOR_FIELDS.items()])
    return Report("tomcat_connector", table, {"name": "name"}, {c: c for c in CONNECTOR_FIELDS}, SOURCE)


def status(snapshots: DataFrame) -> Result:
    """All three kinds of points from one pass over the replies."""
    good, errors = _parsed(snapshots)
    no_tags = F.expr("map()").cast("map<string,string>")

    def point(name: str, tags: dict[str, Column], numbers: dict[str, Column]) -> Column:
        labels = F.create_map(*[x for k, c in tags.items() for x in (F.lit(k), c)]) if tags else no_tags
        fields = F.create_map(*[x for k, c in numbers.items() for x in (F.lit(k), int_field(F.coalesce(c, F.lit(0))))])
        return F.struct(F.lit(name).alias("name"), labels.alias("tags"), fields.alias("fields"))

    def at(base: Column, path: str) -> Column:
        for part in path.split("."):
            base = base[part]
        return base

    memory_point = point("tomcat_jvm_memory", {}, {c: F.col(f"_d.jvm.memory._{c}") for c in ("free", "total", "max")})
    pools = F.transform("_d.jvm.memorypool", lambda p: point(
        "tomcat_jvm_memorypool", {"name": p["_name"], "type": p["_type"]},
        {c: p[f"_usage{c.capitalize()}"] for c in ("init", "committed", "max", "used")}))
    connected = F.transform("_d.connector", lambda c: point(
        "tomcat_connector", {"name": unquote(c["_name"])}, {out: at(c, path) for out, path in CONNECTOR_FIELDS.items()}))
    alone = F.array(memory_point)
    none = F.slice(alone, 1, 0)
    rows = good.select("collected_at", F.explode(F.concat(alone, F.coalesce(pools, none), F.coalesce(connected, none))).alias("p"))
    return Result(map_point(rows, F.col("p.name"), F.col("p.tags"), F.col("p.fields"), F.col("collected_at"), source=SOURCE), errors)
