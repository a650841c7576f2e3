"""Collector jobs over reply texts built from table rows, and the log broker reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom.functions.maps import shown
from gaugeloom.functions.values import field_text
from gaugeloom.operators.filters import FilterSpec
from gaugeloom.operators.inputs import InputConfig
from gaugeloom.plans import amqp, appserver, cache, coord, logbroker, registry, search
from gaugeloom.queries.common import joined, load, num, query, snapshots, stamp, tag


def _tag(name):
    return F.try_element_at("tags", F.lit(name))


def _texts():
    return shown(F.transform_values("fields", lambda _, v: field_text(v)))


def _colour(col):
    return F.element_at(F.array(*map(F.lit, ("green", "Yellow", "RED", "odd"))), (col % 4 + 1).cast("int"))


_COLOUR_SQL = "['green', 'Yellow', 'RED', 'odd'][{0} % 4 + 1]"
_CODE_SQL = "[1, 2, 3, 0][{0} % 4 + 1]"


@query("cluster_health", f"""
SELECT 'cluster' AS kind, c_name AS name, {_COLOUR_SQL.format('c_nationkey')} AS status, {_CODE_SQL.format('c_nationkey')} AS code, c_nationkey::BIGINT AS active_shards, 0::BIGINT AS unassigned_shards,
  c_nationkey % 2 = 0 AS timed_out FROM customer
UNION ALL SELECT 'index', 'i' || c_custkey, {_COLOUR_SQL.format('(c_nationkey + 1)')}, {_CODE_SQL.format('(c_nationkey + 1)')}, c_custkey, 0, NULL FROM customer""")
def cluster_health(spark, d):
    n, key = F.col("c_nationkey"), F.col("c_custkey")
    doc = joined('{"cluster_name":"', F.col("c_name"), '","status":"', _colour(n), '","timed_out":', n % 2 == 0, ',"active_shards":', n, ',"unassigned_shards":null,"indices":{"i', key,
                 '":{"status":"', _colour(n + 1), '","active_shards":', key, '}}}')
    pts = search.health_points(snapshots(load(spark, d, "customer"), F.col("c_name"), doc)).metrics
    return pts.select(F.when(F.col("measurement") == "elasticsearch_indices", "index").otherwise("cluster").alias("kind"), F.coalesce(_tag("name"), _tag("index")).alias("name"),
                      num("status", "s"), F.col("fields")["status_code"]["i"].cast("int").alias("code"), num("active_shards", "i"), num("unassigned_shards", "i"), num("timed_out", "b"))


def _node_docs(spark, d):
    key, size = F.col("p_partkey"), F.col("p_size")
    doc = joined('{"cluster_name":"', F.col("p_brand"), '","nodes":{"n', key, '":{"host":"h', size, '","name":"', F.col("p_name"), '","attributes":{"rack":"r', size % 3,
                 '"},"jvm":{"mem":{"used":', key, ',"pools":[{"max":', size, '}]},"version":"8"},"http":{"note":"x"},"os":null,"fs":{"total":', F.col("p_retailprice"), '}},"m', key, '":{"host":"o","fs":{"total":1}}}}')
    return snapshots(load(spark, d, "part"), key.cast("string"), doc)


@query("node_sections", """
SELECT 'elasticsearch_jvm' AS measurement, 'n' || p_partkey AS node_id, 'h' || p_size AS host, p_name AS name, p_brand AS cluster, 'r' || p_size % 3 AS rack,
  p_partkey::DOUBLE AS mem_used, p_size::DOUBLE AS mem_pools_0_max, NULL::DOUBLE AS total, 2 AS n FROM part
UNION ALL SELECT 'elasticsearch_fs', 'n' || p_partkey, 'h' || p_size, p_name, p_brand, 'r' || p_size % 3, NULL, NULL, p_retailprice, 1 FROM part
UNION ALL SELECT 'elasticsearch_fs', 'm' || p_partkey, 'o', NULL, p_brand, NULL, NULL, NULL, 1, 1 FROM part""")
def node_sections(spark, d):
    pts = search.node_stats(_node_docs(spark, d), ("jvm", "fs", "http", "os")).metrics
    return pts.select("measurement", tag("node_id").alias("node_id"), tag("node_host").alias("host"), _tag("node_name").alias("name"), tag("cluster_name").alias("cluster"),
                      _tag("node_attribute_rack").alias("rack"), num("mem_used"), num("mem_pools_0_max"), num("total"), F.size("fields").alias("n"))


@query("master_gate", """
SELECT CAST(p_partkey AS VARCHAR) AS node_name, 'elasticsearch_clusterstats_' || part AS measurement, CASE part WHEN 'indices' THEN 'count=' || p_size || ',open=true' ELSE 'os_0=' || p_brand END AS fields
FROM part, (VALUES ('indices'), ('nodes')) v(part) WHERE p_size % 3 < 2""")
def master_gate(spark, d):
    key, size = F.col("p_partkey"), F.col("p_size")
    part = load(spark, d, "part")
    doc = joined('{"node_name":"', key, '","cluster_name":"c","status":"green","indices":{"count":', size, ',"open":true},"nodes":{"os":["', F.col("p_brand"), '"]}}')
    master = snapshots(part, key.cast("string"), joined(F.when(size % 3 == 0, "n").when(size % 3 == 1, "m").otherwise("x"), key, " 10.0.0.1 10.0.0.1 node\n"))
    out = search.cluster_stats(snapshots(part, key.cast("string"), doc), _node_docs(spark, d), master).metrics
    return out.select(tag("node_name").alias("node_name"), "measurement", _texts().alias("fields"))


@query("amqp_overview", """
SELECT c_name AS url, c_custkey AS messages, 0::BIGINT AS messages_ready, c_custkey + 1 AS messages_unacked, c_nationkey::BIGINT AS queues, c_custkey * 2 AS messages_acked,
  2::BIGINT AS amqp_listeners, 1::BIGINT AS clustering_listeners, 14 AS n FROM customer WHERE c_nationkey % 4 <> 1""")
def amqp_overview(spark, d):
    key, n = F.col("c_custkey"), F.col("c_nationkey")
    doc = joined('{"object_totals":{"queues":', n, '},"queue_totals":{"messages":', key, ',"messages_unacknowledged":', key + 1, '}',
                 F.when(n % 4 == 1, "").otherwise(joined(',"message_stats":{"ack":', key * 2, '}')), ',"listeners":[{"protocol":"amqp"},{"protocol":"clustering"},{"protocol":"amqp"},{"port":1}]}')
    pts = amqp.overview(snapshots(load(spark, d, "customer"), F.col("c_name"), doc)).points()
    return pts.select(tag("url").alias("url"), *[num(c, "i") for c in ("messages", "messages_ready", "messages_unacked", "queues", "messages_acked", "amqp_listeners", "clustering_listeners")],
                      F.size("fields").alias("n"))


@query("amqp_errors", "SELECT c_name AS server, 'wrong answer, probably an auth issue' AS message FROM customer WHERE c_nationkey % 4 = 1")
def amqp_errors(spark, d):
    n = F.col("c_nationkey")
    doc = joined('{"object_totals":{},"queue_totals":{}', F.when(n % 4 == 1, "").otherwise(',"message_stats":{}'), ',"listeners":[]}')
    return amqp.overview(snapshots(load(spark, d, "customer"), F.col("c_name"), doc)).errors.select("server", "message")


@query("amqp_nodes", """
SELECT c_name AS url, 'a' || c_custkey AS node, c_custkey AS disk_free, 1::BIGINT AS running, 0::BIGINT AS mem_used FROM customer
UNION ALL SELECT c_name, c_mktsegment, 0, 0, c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def amqp_nodes(spark, d):
    key = F.col("c_custkey")
    cust = load(spark, d, "customer")
    doc = joined('[{"name":"a', key, '","disk_free":', key, ',"running":true},{"name":"', F.col("c_mktsegment"), '","mem_used":', key, '}]')
    table = amqp.nodes(snapshots(cust, F.col("c_name"), doc)).table.filter(F.col("node") != "MACHINERY")
    return table.select("url", "node", "disk_free", "running", "mem_used")


@query("amqp_queues", """
SELECT c_name AS url, 'q' || c_custkey AS queue, '/' AS vhost, 'true' AS durable, 'false' AS auto_delete, c_custkey AS messages, c_acctbal AS messages_ack_rate, 0.5::DOUBLE AS consumer_utilisation, c_mktsegment AS idle_since
FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT LIKE '%7'""")
def amqp_queues(spark, d):
    key = F.col("c_custkey")
    doc = joined('[{"name":"q', key, '","vhost":"/","durable":true,"messages":', key, ',"consumer_utilisation":0.5,"idle_since":"', F.col("c_mktsegment"),
                 '","message_stats":{"ack_details":{"rate":', F.col("c_acctbal"), '}}},{"name":"other","messages":1}]')
    cfg = amqp.BrokerConfig(queues=("q*",), queue_exclude=("*7",))
    table = amqp.queues(snapshots(load(spark, d, "customer"), F.col("c_name"), doc), cfg).table
    return table.select("url", "queue", "vhost", "durable", "auto_delete", "messages", "messages_ack_rate", "consumer_utilisation", "idle_since")


@query("amqp_queues_off", "SELECT c_name AS url, 'q' || c_custkey AS queue, 'on' AS mode FROM customer")
def amqp_queues_off(spark, d):
    doc = joined('[{"name":"q', F.col("c_custkey"), '"}]')
    rows = snapshots(load(spark, d, "customer"), F.col("c_name"), doc)
    on, off = (amqp.queues(rows, amqp.BrokerConfig(queue_exclude=e)).table.select("url", "queue", F.lit(m).alias("mode")) for m, e in (("on", ("a",)), ("off", ("a", "*"))))
    return on.unionByName(off)


@query("amqp_bad_replies", """
SELECT c_custkey % 3 AS kind, count(*) FILTER (WHERE c_custkey % 3 = 0) AS points, count(*) FILTER (WHERE c_custkey % 3 <> 0) AS errors FROM customer GROUP BY ALL""")
def amqp_bad_replies(spark, d):
    """Arrays, lone error objects and truncated text, a third each: points of the first, errors of the others."""
    kind = F.col("c_custkey") % 3
    doc = F.when(kind == 0, F.lit('[{"name":"n"}]')).when(kind == 1, F.lit('{"error":"not_authorised","reason":"Login failed"}')).otherwise(F.lit('[{"name":"n'))
    report = amqp.nodes(snapshots(load(spark, d, "customer"), kind.cast("string"), doc))
    both = report.table.select("server", F.lit(1).alias("p"), F.lit(0).alias("e")).unionByName(report.errors.select("server", F.lit(0).alias("p"), F.lit(1).alias("e")))
    return both.groupBy(F.col("server").cast("bigint").alias("kind")).agg(F.sum("p").alias("points"), F.sum("e").alias("errors"))


@query("amqp_exchanges", """
SELECT c_name AS url, c_mktsegment AS exchange, 'direct' AS type, 'false' AS internal, 'true' AS durable, c_custkey AS publish_in, 0::BIGINT AS publish_out
FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')""")
def amqp_exchanges(spark, d):
    doc = joined('[{"name":"', F.col("c_mktsegment"), '","type":"direct","durable":true,"message_stats":{"publish_in":', F.col("c_custkey"), '}},{"name":"x"}]')
    cfg = amqp.BrokerConfig(exchanges=("BUILDING", "HOUSEHOLD"))
    pts = amqp.exchanges(snapshots(load(spark, d, "customer"), F.col("c_name"), doc), cfg).points()
    return pts.select(*[tag(t).alias(t) for t in ("url", "exchange", "type", "internal", "durable")], F.col("fields")["messages_publish_in"]["i"].alias("publish_in"),
                      F.col("fields")["messages_publish_out"]["i"].alias("publish_out"))


@query("xml_status", """
SELECT 'tomcat_jvm_memory' AS measurement, NULL AS name, c_custkey AS a, c_custkey + 1 AS b, 0::BIGINT AS c FROM customer
UNION ALL SELECT 'tomcat_jvm_memorypool', c_mktsegment, c_custkey, c_nationkey, 0 FROM customer
UNION ALL SELECT 'tomcat_jvm_memorypool', 'Old', 7, 0, c_custkey FROM customer
UNION ALL SELECT 'tomcat_connector', 'http-' || c_custkey, c_custkey, c_nationkey, 0 FROM customer""")
def xml_status(spark, d):
    key, n = F.col("c_custkey"), F.col("c_nationkey")
    doc = joined('<status><jvm><memory free="', key, '" total="', key + 1, '"/><memorypool name="', F.col("c_mktsegment"), '" type="Heap" usageInit="', key, '" usageMax="', n,
                 '"/><memorypool name="Old" usageInit="7" usageUsed="', key, '"/></jvm><connector name="&quot;http-', key, '&quot;"><threadInfo maxThreads="', key,
                 '"/><requestInfo errorCount="', n, '"/></connector></status>')
    pts = appserver.status(snapshots(load(spark, d, "customer"), F.col("c_name"), doc)).metrics

    def pick(*names):
        return F.coalesce(*[F.try_element_at("fields", F.lit(x))["i"] for x in names])

    return pts.select("measurement", _tag("name").alias("name"), pick("free", "init", "max_threads").alias("a"), pick("total", "error_count", "max").alias("b"),
                      F.when(F.col("measurement") == "tomcat_jvm_memory", pick("max")).when(F.col("measurement") == "tomcat_jvm_memorypool", pick("used"))
                      .otherwise(pick("bytes_sent")).alias("c"))


def _mntr(spark, d):
    key, n = F.col("c_custkey"), F.col("c_nationkey")
    text = joined("zk_version\t3.4.", n, "-", key, ", built on 08/23/2016\nzk_avg_latency\t", key, "\n", F.when(n % 5 == 0, "stray line\n").otherwise(""),
                  "zk_server_state\t", F.when(n % 2 == 0, "leader").otherwise("follower"), "\nzk_znode_count\t", n, "\n")
    return coord.mntr(snapshots(load(spark, d, "customer"), F.when(n % 3 == 0, joined("h", key)).otherwise(joined("h", key, ":99")), text))


@query("mntr_parse", """
SELECT 'h' || c_custkey AS server, CASE WHEN c_nationkey % 3 = 0 THEN '2181' ELSE '99' END AS port, CASE WHEN c_nationkey % 2 = 0 THEN 'leader' ELSE 'follower' END AS state,
  '3.4.' || c_nationkey || '-' || c_custkey AS version, c_custkey AS avg_latency, c_nationkey::BIGINT AS znode_count, 3 AS n FROM customer WHERE c_nationkey % 5 <> 0""")
def mntr_parse(spark, d):
    return _mntr(spark, d).metrics.select(*[tag(t).alias(t) for t in ("server", "port", "state")], num("version", "s"), num("avg_latency", "i"), num("znode_count", "i"), F.size("fields").alias("n"))


@query("mntr_errors", "SELECT 'unexpected line in mntr response: stray line' AS message, count(*) AS n FROM customer WHERE c_nationkey % 5 = 0")
def mntr_errors(spark, d):
    return _mntr(spark, d).errors.groupBy("message").agg(F.count(F.lit(1)).alias("n"))


def _info(spark, d):
    key, n = F.col("c_custkey"), F.col("c_nationkey")
    text = joined("# Server\r\nredis_version:3.2.", n, "\r\nos:Linux\r\nuptime_in_seconds:", key, "\r\n\r\n# Clients\r\nconnected_clients:", n, "\r\n# Memory\r\nused_memory_human:1M\r\nmem_allocator:x\r\n",
                  "ratio:", n, ".5\r\n# Persistence\r\nrdb_last_save_time:", F.lit(1706745600) - key, "\r\n# Stats\r\nkeyspace_hits:", key, "\r\nkeyspace_misses:", n * 0 + F.when(n % 2 == 0, key).otherwise(F.lit(0)),
                  "\r\n# Replication\r\nrole:", F.when(n % 2 == 0, "master").otherwise("slave"), "\r\nmaster_replid2:abc\r\n# Keyspace\r\ndb0:keys=", key, ",expires=", n, ",avg_ttl=x\r\ndb1:keys=1\r\ndbx:none\r\n")
    return snapshots(load(spark, d, "customer"), joined("tcp://h", key, ":6379"), text)


@query("info_parse", """
SELECT 'h' || c_custkey AS server, '6379' AS port, CASE WHEN c_nationkey % 2 = 0 THEN 'master' ELSE 'slave' END AS role, '3.2.' || c_nationkey AS redis_version, c_custkey AS uptime,
  c_nationkey::BIGINT AS clients, c_nationkey + 0.5::DOUBLE AS ratio, c_custkey AS elapsed, 9 AS n FROM customer""")
def info_parse(spark, d):
    pts = cache.info(_info(spark, d)).metrics
    return pts.select(tag("server").alias("server"), tag("port").alias("port"), tag("replication_role").alias("role"), num("redis_version", "s"), num("uptime", "i"), num("clients", "i"), num("ratio"),
                      F.col("fields")["rdb_last_save_time_elapsed"]["i"].alias("elapsed"), F.size("fields").alias("n"))


@query("hit_ratio", """
SELECT 'h' || c_custkey AS server, CASE WHEN c_custkey = 0 THEN 0.0::DOUBLE WHEN c_nationkey % 2 = 0 THEN 0.5 ELSE 1.0 END AS rate FROM customer""")
def hit_ratio(spark, d):
    return cache.info(_info(spark, d)).metrics.select(tag("server").alias("server"), F.col("fields")["keyspace_hitrate"]["f"].alias("rate"))


@query("info_keyspace", """
SELECT 'h' || c_custkey AS server, CASE WHEN c_nationkey % 2 = 0 THEN 'master' ELSE 'slave' END AS role, 'db0' AS database, c_custkey AS keys, c_nationkey::BIGINT AS expires, 2 AS n FROM customer
UNION ALL SELECT 'h' || c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'master' ELSE 'slave' END, 'db1', 1, NULL, 1 FROM customer""")
def info_keyspace(spark, d):
    pts = cache.keyspace(_info(spark, d)).metrics
    return pts.select(tag("server").alias("server"), tag("replication_role").alias("role"), tag("database").alias("database"), num("keys", "i"), num("expires", "i"), F.size("fields").alias("n"))


def _broker(spark, d):
    """Parts are topics with 1 to 3 partitions; line items carry the offsets."""
    part = load(spark, d, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    parts = part.select(F.lit("c1").alias("server"), stamp().alias("collected_at"), joined(F.col("p_type"), "-", key).alias("topic"), "p_size",
                        F.explode(F.sequence(F.lit(0), (size % 3).cast("int"))).alias("partition"))
    parts = parts.select("server", "collected_at", "topic", "partition", F.when(F.col("p_size") % 7 == 0, F.lit(-1)).otherwise(F.col("partition") + 1).alias("leader"),
                         F.array(F.lit(1), F.lit(2), F.lit(3)).alias("replicas"), F.array(F.col("partition")).alias("isr"),
                         F.when(F.col("p_size") == 11, 3).otherwise(0).alias("topic_err"), F.when(F.col("p_size") % 7 == 0, 5).otherwise(0).alias("partition_err"))
    items = load(spark, d, "lineitem").join(part.select(key.alias("l_partkey"), "p_type"), "l_partkey").select(
        F.lit("c1").alias("server"), stamp().alias("collected_at"), joined(F.col("p_type"), "-", F.col("l_partkey")).alias("topic"),
        (F.col("l_linenumber") % 3).cast("int").alias("partition"), "l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber")
    offsets = items.select("server", "collected_at", "topic", "partition", (F.col("l_linestatus") == "O").alias("oldest"), F.col("l_orderkey").alias("offset"),
                           F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("err"))
    groups = items.select("server", "collected_at", joined("g", F.col("l_suppkey") % 10).alias("group"), "topic", "partition",
                          F.when(F.col("l_returnflag") == "N", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("offset"), F.when(F.col("l_linenumber") == 1, 9).otherwise(0).alias("err"))
    return {"topic_partitions": parts, "broker_offsets": offsets, "group_offsets": groups}


@query("partition_offsets", """
SELECT p_type || '-' || p_partkey AS topic, (l_linenumber % 3)::INT AS partition, l_linestatus = 'O' AS oldest, l_orderkey AS "offset", 1706745600000 AS "timestamp", (p_size % 3 + 1)::BIGINT AS partitions
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE (p_type LIKE 'ECO%' OR p_type LIKE '%O') AND l_linenumber % 3 <= p_size % 3 AND p_size % 7 <> 0 AND l_returnflag <> 'A'""".replace(
    "p_type LIKE '%O'", "p_type LIKE 'PRO%'"))
def partition_offsets(spark, d):
    table = logbroker.offsets(_broker(spark, d), ["ECO*", "PR*O-*"]).table
    return table.select("topic", "partition", "oldest", "offset", "timestamp", F.col("topicPartitionCount").alias("partitions"))


@query("partition_offset_errors", """
SELECT CASE WHEN l_linenumber % 3 > p_size % 3 OR p_size % 7 = 0 THEN 'topic leader error' ELSE 'error in offset' END AS kind, count(*) AS n
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber % 3 > p_size % 3 OR p_size % 7 = 0 OR l_returnflag = 'A' GROUP BY 1""")
def partition_offset_errors(spark, d):
    errors = logbroker.offsets(_broker(spark, d), ["*"]).errors
    return errors.groupBy(F.regexp_extract("message", "^(topic leader error|error in offset)", 1).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("partition_metadata", """
SELECT p_type || '-' || p_partkey AS topic, i::BIGINT AS partition, (p_size % 3 + 1)::BIGINT AS partitions, i + 1 AS leader, '[1 2 3]' AS replicas, '[' || i || ']' AS isr
FROM (SELECT *, unnest(range(p_size % 3 + 1)) AS i FROM part) WHERE p_size % 7 <> 0 AND p_size <> 11""")
def partition_metadata(spark, d):
    pts = logbroker.metadata(_broker(spark, d), ["*"]).points()
    return pts.select(num("topic", "s"), num("partition", "i"), F.col("fields")["topicPartitionCount"]["i"].alias("partitions"), num("leader", "i"), num("replicas", "s"),
                      F.col("fields")["Isr"]["s"].alias("isr"))


@query("group_offsets", """
SELECT 'g' || (l_suppkey % 10) AS "group", p_type || '-' || p_partkey AS topic, (l_linenumber % 3)::INT AS partition, l_orderkey AS "offset"
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_suppkey % 10 IN (1, 7) AND l_linenumber % 3 <= p_size % 3 AND l_returnflag <> 'N' AND l_linenumber <> 1""")
def group_offsets(spark, d):
    return logbroker.groups(_broker(spark, d), ["g1", "*7"]).table.select("group", "topic", "partition", "offset")


@query("gather_reports", """
SELECT 'p_zookeeper' AS measurement, count(*) AS n, sum(c_custkey)::BIGINT AS total FROM customer WHERE c_nationkey % 5 <> 0
UNION ALL SELECT 'redis_keyspace', 2 * count(*), sum(c_custkey + 1)::BIGINT FROM customer
UNION ALL SELECT 'redis', count(*), NULL FROM customer""")
def gather_reports(spark, d):
    info = _info(spark, d).withColumns({"source": F.lit("cache"), "endpoint": F.lit("info")})
    key, n = F.col("c_custkey"), F.col("c_nationkey")
    mntr = snapshots(load(spark, d, "customer"), joined("h", key), joined("zk_keys\t", key, F.when(n % 5 == 0, "\nstray").otherwise(""))).withColumns(
        {"source": F.lit("coord"), "endpoint": F.lit("mntr")})
    tables = {"snapshots": info.unionByName(mntr)}
    out = registry.gather_once(tables, [
        registry.Wanted("coord.mntr", config=InputConfig(name_prefix="p_")),
        registry.Wanted("cache.status", config=InputConfig(filter=FilterSpec(field_pass=["key*"])))]).result.metrics
    return out.groupBy("measurement").agg(F.count(F.lit(1)).alias("n"), F.sum(F.try_element_at("fields", F.lit("keys"))["i"]).alias("total"))
