"""Search cluster reports over landed JSON replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.functions.jsonflat import flatten_json
from gaugeloom.functions.lookups import health_code
from gaugeloom.functions.maps import last_wins, once
from gaugeloom.functions.values import bool_field, int_field, string_field
from gaugeloom.model import Report, Result, error_rows
from gaugeloom.operators.points import map_point

SOURCE = "elasticsearch"
KEYS = ["server", "collected_at"]

# Node sections and health counters, in the reply's own names.
SECTIONS = ("indices", "os", "process", "jvm", "thread_pool", "fs", "transport", "http", "breakers")
CLUSTER_COUNTS = ("number_of_nodes", "number_of_data_nodes", "active_primary_shards", "active_shards",
                  "relocating_shards", "initializing_shards", "unassigned_shards")
INDEX_COUNTS = ("number_of_shards", "number_of_replicas", "active_primary_shards", "active_shards",
                "relocating_shards", "initializing_shards", "unassigned_shards")

_NODE = "host string, name string, attributes map<string,string>, " + ", ".join(f"{s} string" for s in SECTIONS)
_NODES = f"cluster_name string, nodes map<string,struct<{_NODE}>>, _bad string"
_INDEX = "status string, " + ", ".join(f"{c} bigint" for c in INDEX_COUNTS)
_HEALTH = ("cluster_name string, status string, timed_out boolean, "
           + ", ".join(f"{c} bigint" for c in CLUSTER_COUNTS) + f", indices map<string,struct<{_INDEX}>>, _bad string")
_CLUSTER = "node_name string, cluster_name string, status string, indices string, nodes string, _bad string"


def decode(df: DataFrame, ddl: str, into: str = "_doc") -> tuple[DataFrame, DataFrame]:
    """Parse the payload; replies that are not valid JSON are returned as error rows."""
    parsed = once(df, **{into: F.from_json("payload", ddl, {"columnNameOfCorruptRecord": "_bad"})})
    bad = F.col(into).isNull() | F.col(f"{into}._bad").isNotNull()
    errors = error_rows(parsed.filter(bad), SOURCE, F.concat(F.lit("invalid reply from "), F.col("server")),
                        server=F.col("server"), endpoint=F.col("endpoint"), ts=F.col("collected_at"))
    return parsed.filter(~bad), errors


def _nodes(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    parsed, errors = decode(snapshots, _NODES)
    return parsed.select(*KEYS, F.col("_doc.cluster_name").alias("cluster_name"),
                         F.explode("_doc.nodes").alias("node_id", "node")), errors


def node_stats(snapshots: DataFrame, sections: tuple[str, ...] = ()) -> Result:
    """One point per node and section, with every number in the section as a field."""
    nodes, errors = _nodes(snapshots)
    chosen = [s for s in SECTIONS if not sections or s in sections]
    parts = F.filter(F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"node.{s}").alias("body")) for s in chosen]),
                     lambda p: p["body"].isNotNull())
    rows = nodes.select(*KEYS, "cluster_name", "node_id", "node.host", "node.name", "node.attributes",
                        F.explode(parts).alias("part"))
    own = F.create_map(F.lit("node_id"), F.col("node_id"), F.lit("node_host"), F.col("host"),
                       F.lit("node_name"), F.col("name"), F.lit("cluster_name"), F.col("cluster_name"))
    labels = last_wins(F.transform(F.map_entries(F.coalesce("attributes", F.expr("map()").cast("map<string,string>"))), lambda e: F.struct(
        F.concat(F.lit("node_attribute_"), e["key"]).alias("k"), e["value"].alias("v"))))
    flat = rows.select("collected_at", F.concat(F.lit("elasticsearch_"), F.col("part.section")).alias("name"),
                       F.map_concat(own, labels).alias("tags"), flatten_json(F.col("part.body")).alias("fields"))
    return Result(map_point(flat, F.col("name"), F.col("tags"), F.col("fields"), F.col("collected_at"), source=SOURCE),
                  errors)


def _zero(path: str) -> Column:
    return F.coalesce(path, F.lit(0))


def health(snapshots: DataFrame) -> Report:
    """Cluster health, one row per cluster. Absent counters are 0."""
    parsed, errors = decode(snapshots, _HEALTH)
    status = F.coalesce("_doc.status", F.lit(""))
    cluster = parsed.select(
        *KEYS, F.col("_doc.cluster_name").alias("name"), status.alias("status"), health_code(status).alias("status_code"),
        F.coalesce("_doc.timed_out", F.lit(False)).alias("timed_out"),
        *[_zero(f"_doc.{c}").alias(c) for c in CLUSTER_COUNTS])
    return Report("elasticsearch_cluster_health", cluster, {"name": "name"},
                  {c: c for c in ("status", "status_code", "timed_out", *CLUSTER_COUNTS)}, SOURCE, errors)


def index_health(snapshots: DataFrame) -> Report:
    """Health of every index a cluster reply lists."""
    parsed, _ = decode(snapshots, _HEALTH)
    rows = parsed.select(*KEYS, F.explode("_doc.indices").alias("index", "h"))
    state = F.coalesce("h.status", F.lit(""))
    index = rows.select(*KEYS, "index", state.alias("status"), health_code(state).alias("status_code"),
                        *[_zero(f"h.{c}").alias(c) for c in INDEX_COUNTS])
    return Report("elasticsearch_indices", index, {"index": "index"},
                  {c: c for c in ("status", "status_code", *INDEX_COUNTS)}, SOURCE)


def health_points(snapshots: DataFrame) -> Result:
    """Cluster and index health as points, from one pass over the replies."""
    parsed, errors = decode(snapshots, _HEALTH)

    def point(name: str, tag: str, label: Column, h: Column, counts: tuple[str, ...], more: dict[str, Column]) -> Column:
        state = F.coalesce(h["status"], F.lit(""))
        fields = {"status": string_field(state), "status_code": int_field(health_code(state)), **more,
                  **{c: int_field(F.coalesce(h[c], F.lit(0))) for c in counts}}
        return F.struct(F.lit(name).alias("name"), F.create_map(F.lit(tag), label).alias("tags"),
                        F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)]).alias("fields"))

    doc = F.col("_doc")
    cluster = F.array(point("elasticsearch_cluster_health", "name", doc["cluster_name"], doc, CLUSTER_COUNTS, {
        "timed_out": bool_field(F.coalesce(doc["timed_out"], F.lit(False)))}))
    index = F.transform(F.map_entries(doc["indices"]), lambda e: point(
        "elasticsearch_indices", "index", e["key"], e["value"], INDEX_COUNTS, {}))
    rows = parsed.select("collected_at", F.explode(F.concat(cluster, F.coalesce(index, F.slice(cluster, 1, 0)))).alias("p"))
    return Result(map_point(rows, F.col("p.name"), F.col("p.tags"), F.col("p.fields"), F.col("collected_at"), source=SOURCE), errors)


def masters(snapshots: DataFrame) -> DataFrame:
    """Master node of every server and time: the first word of the reply."""
    return snapshots.select(*KEYS, F.split("payload", " ")[0].alias("node_id"))


def master_servers(node_snapshots: DataFrame, master_snapshots: DataFrame) -> DataFrame:
    """Servers whose own node is the master."""
    nodes, _ = _nodes(node_snapshots)
    return nodes.select(*KEYS, "node_id").join(masters(master_snapshots), [*KEYS, "node_id"], "left_semi").select(*KEYS).distinct()


def cluster_stats(snapshots: DataFrame, node_snapshots: DataFrame, master_snapshots: DataFrame) -> Result:
    """Cluster statistics with texts and flags, only from servers that are the master."""
    gated = snapshots.join(master_servers(node_snapshots, master_snapshots), KEYS, "left_semi")
    parsed, errors = decode(gated, _CLUSTER)
    parts = F.filter(F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"_doc.{s}").alias("body"))
                               for s in ("nodes", "indices")]), lambda p: p["body"].isNotNull())
    rows = parsed.select("collected_at", "_doc.node_name", "_doc.cluster_name", "_doc.status", F.explode(parts).alias("part"))
    tags = F.create_map(*[x for c in ("node_name", "cluster_name", "status") for x in (F.lit(c), F.col(c))])
    flat = rows.select("collected_at", F.concat(F.lit("elasticsearch_clusterstats_"), F.col("part.section")).alias("name"),
                       tags.alias("tags"), flatten_json(F.col("part.body"), strings=True, bools=True).alias("fields"))
    return Result(map_point(flat, F.col("name"), F.col("tags"), F.col("fields"), F.col("collected_at"), source=SOURCE),
                  errors)
