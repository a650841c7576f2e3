from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators.filters import FilterSpec
from gaugeloom.operators.inputs import InputConfig
from gaugeloom.plans import amqp, appserver, cache, coord, database as db, logbroker, registry, search
from gaugeloom.sources.landing import DIGEST_TOTALS, LOCK_MODES, TABLES, USER_COUNTERS
from helpers import T0, only, points, snap

V2 = db.DatabaseConfig(metric_version=2)


def table(spark, name, *data):
    """Rows given as dicts; ``server`` and ``collected_at`` are filled in, absent columns are NULL."""
    from pyspark.sql import Row
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(TABLES[name])
    full = [tuple(({"server": "s1", "collected_at": T0} | d).get(f) for f in schema.names) for d in data]
    return {name: spark.createDataFrame(full, schema)}


def names(*pairs):
    return [{"pos": i, "name": n, "value": v} for i, (n, v) in enumerate(pairs)]


def test_global_status(spark):
    t = table(spark, "global_status", *names(
        ("Com_select", "5"), ("Bytes_sent", "junk"), ("Queries", "7"), ("Uptime", "bad"), ("Unknown", "1"), ("Com_select", "6")))
    out = db.global_status(t)
    assert only(out.metrics) == ("mysql", {"server": "s1"}, {"commands_select": 6, "bytes_sent": 0, "queries": 7})
    assert "Uptime" in out.errors.first().message
    t = table(spark, "global_status", *names(("Com_select", "5"), ("Flag", "ON"), ("Empty", ""), ("Name", "x")))
    assert only(db.global_status(t, V2).metrics)[2] == {"com_select": 5, "flag": 1, "name": "x"}


def test_status_number_out_of_range_is_clamped(spark):
    t = table(spark, "global_status", *names(("Com_x", "99999999999999999999")))
    assert only(db.global_status(t).metrics)[2] == {"commands_x": 2**63 - 1}


def test_global_variables_in_chunks(spark):
    t = table(spark, "global_variables", *names(
        ("version", "5.6.34"), ("protocol_version", "10"), *[(f"V{i:02}", str(i)) for i in range(40)], ("text", "abc")))
    got = points(db.global_variables(t).metrics)
    assert [len(p[2]) for p in sorted(got, key=lambda p: -len(p[2]))] == [20, 20, 2]
    assert all(p[1] == {"server": "s1", "version": "5.6.34", "protocol_version": "10"} for p in got)
    every = {k: v for p in got for k, v in p[2].items()}
    assert every["version"] == "5.6.34" and every["protocol_version"] == 10.0 and "text" not in every and every["v39"] == 39.0


def test_slow_interval_counts_from_the_last_report(spark):
    t = table(spark, "global_variables", *[
        {"collected_at": T0 + timedelta(seconds=s), **r} for s in (59, 61, 118, 119, 178.5, 179.5) for r in names(("a", "1"), ("b", "2"))])
    out = db.global_variables(t, db.DatabaseConfig(slow_interval_seconds=60))
    assert sorted((r.ts - T0.replace(tzinfo=None)).total_seconds() for r in out.metrics.collect()) == [59, 119, 179.5]


def test_replication_first_row(spark, rows):
    df = rows("server string, collected_at timestamp, pos int, Slave_IO_Running string, Seconds_Behind_Master string",
              ("s1", T0, 2, "No", "9"), ("s1", T0, 1, "Yes", None))
    out = db.replication({"slave_status": df}, order="pos")
    assert only(out.metrics) == ("mysql", {"server": "s1"}, {"slave_slave_io_running": 1.0})


def test_binary_logs(spark, rows):
    big = Decimal(2**64 - 1)
    t = table(spark, "binary_logs", {"file": "a", "size": Decimal(5)}, {"file": "b", "size": Decimal(6)},
              {"server": "s2", "file": "c", "size": big})
    t["servers"] = rows("server string, collected_at timestamp", ("s1", T0), ("s2", T0), ("s3", T0))
    assert points(db.binary_logs(t).points()) == [
        ("mysql", {"server": s}, {"binary_size_bytes": n, "binary_files_count": c})
        for s, n, c in (("s1", 11, 2), ("s2", 2**63 - 1, 1), ("s3", 0, 0))]


def test_process_list_and_users(spark):
    t = table(spark, "processlist", {"id": 1, "user": "a", "command": "Query", "state": "update"},
              {"id": 2, "user": "a", "command": "Query", "state": "updating"}, {"id": 3, "user": "b", "command": "Sleep", "state": ""},
              {"id": 4, "user": "b", "command": None, "state": None})
    name, tags, fields = only(db.process_list(t, db.DatabaseConfig(own_connection=4)).points())
    assert name == "mysql_info_schema" and len(fields) == 51
    assert {k: v for k, v in fields.items() if v} == {"threads_updating": 2, "threads_idle": 1}
    assert only(db.process_list(t, V2).points())[0] == "mysql_process_list"
    assert [(p[1]["user"], p[2]) for p in points(db.user_connections(t).points())] == [("a", {"connections": 2}), ("b", {"connections": 2})]


def test_user_statistics(spark):
    row = {"user": "a", **{c: i for i, c in enumerate(USER_COUNTERS)}}
    assert only(db.user_statistics(table(spark, "user_statistics", row, row)).points())[2] == {c: i for i, c in enumerate(USER_COUNTERS)}


def test_auto_increment(spark):
    key = {"table_schema": "d", "table_name": "t"}
    t = table(spark, "tables", {**key, "auto_increment": Decimal(9)}, {"table_schema": "d", "table_name": "u"}) | table(
        spark, "columns", {**key, "column_name": "id", "data_type": "bigint", "column_type": "bigint(20) unsigned", "extra": "auto_increment"},
        {**key, "column_name": "x", "data_type": "int", "column_type": "int", "extra": ""})
    assert only(db.auto_increment(t).points()) == (
        "mysql_info_schema", {"server": "s1", "schema": "d", "table": "t", "column": "id"},
        {"auto_increment_column": 9, "auto_increment_column_max": 2**63 - 1})


def test_innodb(spark):
    t = table(spark, "innodb_metrics", *[{"pos": i, "name": f"M{i}", "count": str(i), "status": "enabled" if i % 2 else "disabled"} for i in range(50)])
    got = points(db.innodb_metrics(t).metrics)
    assert sorted(len(p[2]) for p in got) == [5, 20] and all(p[0] == "mysql_innodb" for p in got)


def test_io_waits(spark):
    counts = {f"{p}_{op}": v for p, v in (("count", 3.0), ("sum_timer", 2e12)) for op in ("fetch", "insert", "update", "delete")}
    t = table(spark, "table_io_waits", {"object_schema": "d", "object_name": "t", **counts}, {"object_schema": "mysql", "object_name": "t", **counts},
              {"object_schema": None, "object_name": "t", **counts})
    name, tags, fields = only(db.table_io_waits(t).points())
    assert tags == {"server": "s1", "schema": "d", "name": "t"} and fields["table_io_waits_seconds_total_insert"] == 2.0 and len(fields) == 8
    t = table(spark, "index_io_waits", {"object_schema": "d", "object_name": "t", **counts}, {"object_schema": "d", "object_name": "t", "index_name": "i", **counts})
    got = {p[1]["index"]: p[2] for p in points(db.index_io_waits(t).points())}
    assert len(got["NONE"]) == 8 and got["i"] == {"index_io_waits_total_fetch": 3.0, "index_io_waits_seconds_total_fetch": 2.0}


def test_lock_waits(spark):
    row = {"object_schema": "d", "object_name": "t"} | {f"count_{m}": float(i) for i, m in enumerate(LOCK_MODES)} | {
        f"sum_timer_{m}": i * 1e12 for i, m in enumerate(LOCK_MODES)}
    got = {p[1]["perf_query"]: p[2] for p in points(db.lock_waits(table(spark, "table_lock_waits", row)).points())}
    assert sorted(len(f) for f in got.values()) == [2, 2, 8, 8]
    assert got["external_lock_waits_total"] == {"read": 4.0, "write": 9.0} == got["external_lock_waits_seconds_total"]
    assert got["sql_lock_waits_total"]["write_normal"] == 8.0


def test_event_waits_and_file_events(spark):
    t = table(spark, "event_waits", {"event_name": "e", "count_star": 2.0, "sum_timer_wait": 5e11})
    assert only(db.event_waits(t).points())[2] == {"events_waits_total": 2.0, "events_waits_seconds_total": 0.5}
    t = table(spark, "file_events", {"event_name": "e", "count_read": 1.0, "count_write": 2.0, "count_misc": 3.0, "sum_timer_read": 1e12,
                                     "sum_timer_write": 2e12, "sum_timer_misc": 3e12, "sum_number_of_bytes_read": 10.0, "sum_number_of_bytes_write": 20.0})
    assert {p[1]["mode"]: p[2] for p in points(db.file_events(t).points())} == {
        "misc": {"file_events_total": 3.0, "file_events_seconds_total": 3.0},
        "read": {"file_events_total": 1.0, "file_events_seconds_total": 1.0, "file_events_bytes_totals": 10.0},
        "write": {"file_events_total": 2.0, "file_events_seconds_total": 2.0, "file_events_bytes_totals": 20.0}}


def test_statement_digests(spark):
    def digest(n, wait, schema="d", age=0):
        return {"schema_name": schema, "digest": n, "digest_text": "select " * 30, "last_seen": T0 - timedelta(seconds=age)} | {
            c: 1.0 for c in DIGEST_TOTALS} | {"sum_timer_wait": wait * 1e12, "sum_created_tmp_tables": 7.0}

    t = table(spark, "statement_digests", digest("a", 1), digest("b", 3), digest("c", 2), digest("old", 9, age=100), digest("sys", 9, "mysql"), digest("null", 9, None))
    got = points(db.statement_digests(t, db.DatabaseConfig(digest_limit=2, digest_time_limit=60, digest_text_limit=10)).points())
    assert [(p[1]["digest"], p[1]["digest_text"], p[2]["events_statements_seconds_total"]) for p in got] == [("b", "select sel", 3.0), ("c", "select sel", 2.0)]
    assert got[0][2]["events_statements_tmp_tables_total"] == 7.0 and got[0][2]["events_statements_tmp_disk_tables_total"] == 1.0 and len(got[0][2]) == 12


def test_table_sizes(spark, rows):
    row = {"table_schema": "d", "table_name": "t", "table_type": "BASE TABLE", "engine": "InnoDB", "version": 10.0, "table_rows": 5.0, "data_length": 6.0}
    t = table(spark, "tables", row, {**row, "table_schema": "mysql"})
    got = points(db.table_sizes(t).points())
    assert [p[0] for p in got] == ["info_schema_table_rows", "info_schema_table_size_data_free", "info_schema_table_size_data_length",
                                   "info_schema_table_size_index_length", "info_schema_table_version"]
    assert [p[2]["value"] for p in got] == [5.0, 0.0, 6.0, 0.0, 10.0]
    assert got[1][1] == {"server": "s1", "schema": "d", "table": "t", "component": "data_free"}
    assert got[4][1] == {"server": "s1", "schema": "d", "table": "t", "type": "BASE TABLE", "engine": "InnoDB", "row_format": "NONE", "create_options": "NONE"}
    v2 = points(db.table_sizes(t, V2).points())
    assert sorted((p[0], *p[2]) for p in v2) == sorted([("mysql_table_schema", f) for f in ("rows", "data_length", "index_length", "data_free")] + [
        ("mysql_table_schema_version", "table_version")])
    assert db.table_sizes(t, db.DatabaseConfig(databases=("mysql",))).table.count() == 5
    t["schemata"] = rows("server string, collected_at timestamp, schema_name string", ("s1", T0, "mysql"), ("s1", T0, "other"))
    assert db.table_sizes(t).table.count() == 0


def history(spark):
    def statement(thread, event, start, end, **more):
        return {"thread_id": thread, "event_id": event, "timer_start": int(start * 1e12), "timer_end": int(end * 1e12), "timer_wait": int((end - start) * 1e12),
                "event_name": "statement/sql/select", "current_schema": "d", "sql_text": "select 1", "digest_text": "select ?", "digest": "x"} | more

    return table(spark, "statements_history", statement(1, 1, 10, 20), statement(1, 2, 30, 40), statement(2, 1, 30, 35), statement(3, 1, 1, 2),
                 statement(1, 3, 1, 2, digest_text=None), statement(1, 4, 1, 2, current_schema="mysql"), statement(1, 5, 1, 2, event_name="statement/com/Ping")
                 ) | table(spark, "threads", {"thread_id": 1, "processlist_user": "u", "processlist_host": "h", "processlist_db": None},
                           {"thread_id": 2, "processlist_user": "v"}, {"thread_id": 3}) | table(spark, "uptime", {"uptime_seconds": 100.0}) | table(
        spark, "stages_history", {"thread_id": 1, "nesting_event_id": 1, "timer_wait": 7, "event_name": "stage/a"},
        {"thread_id": 1, "nesting_event_id": 1, "timer_wait": None, "event_name": "stage/b"}, {"thread_id": 2, "nesting_event_id": 1, "timer_wait": 8, "event_name": "stage/c"})


def test_statements(spark, rows):
    t = history(spark)
    report = db.statements(t)
    got = points(report.points())
    assert sorted((p[2]["thread_id"], p[2]["event_id"], p[2]["processlist_user"]) for p in got) == [(1, 1, "u"), (1, 2, "u"), (2, 1, "v")]
    first = next(p[2] for p in got if p[2]["event_id"] == 1 and p[2]["thread_id"] == 1)
    assert first["start_time"] == "2018-06-01 11:58:30.000000" and first["execution_time"] == 10 * 10**12 and "processlist_db" not in first
    cursor = db.next_cursor(report.table)
    assert cursor.first().end_time.timestamp() == T0.timestamp() - 60
    assert db.statements(t, cursors=cursor).table.count() == 0
    old = rows("server string, end_time timestamp", ("s1", T0 - timedelta(seconds=80)))
    assert db.statements(t, cursors=old).table.count() == 2
    assert db.next_cursor(db.statements(t, cursors=cursor).table, cursor).first().end_time.timestamp() == T0.timestamp() - 60
    assert db.statements(t, start=T0).table.count() == 0


def test_stages(spark):
    t = history(spark)
    got = points(db.stages(t).points())
    assert sorted((p[2]["thread_id"], p[2]["event_name"], p[2]["stage_time"]) for p in got) == [(1, "stage/a", 7), (2, "stage/c", 8)]
    assert got[0][2]["measurements"] == "event_stage"
    by_event = db.stages(t, db.DatabaseConfig(stage_join_by_event_only=True)).table
    assert by_event.count() == 6


NODES = ('{"cluster_name":"c1","nodes":{"n1":{"host":"h1","name":"node-1","attributes":{"rack":"r1"},'
         '"jvm":{"mem":{"heap_used_percent":40,"pools":{"young":{"used_in_bytes":7}}},"version":"8"},'
         '"fs":{"data":[{"total_in_bytes":10},{"total_in_bytes":20}]},"http":{"note":"x"}}}}')


def test_search_node_stats(spark):
    out = search.node_stats(snap(spark, [NODES, "nope"]))
    tags = {"node_id": "n1", "node_host": "h1", "node_name": "node-1", "cluster_name": "c1", "node_attribute_rack": "r1"}
    assert points(out.metrics) == [
        ("elasticsearch_fs", tags, {"data_0_total_in_bytes": 10.0, "data_1_total_in_bytes": 20.0}),
        ("elasticsearch_jvm", tags, {"mem_heap_used_percent": 40.0, "mem_pools_young_used_in_bytes": 7.0})]
    assert out.errors.count() == 1
    assert [p[0] for p in points(search.node_stats(snap(spark, NODES), ("fs",)).metrics)] == ["elasticsearch_fs"]


def test_search_health(spark):
    doc = '{"cluster_name":"c","status":"Yellow","timed_out":true,"number_of_nodes":3,"indices":{"i1":{"status":"red","number_of_shards":2}}}'
    got = points(search.health_points(snap(spark, doc)).metrics)
    zero = {"active_primary_shards": 0, "active_shards": 0, "relocating_shards": 0, "initializing_shards": 0, "unassigned_shards": 0}
    assert got == [
        ("elasticsearch_cluster_health", {"name": "c"}, {"status": "Yellow", "status_code": 2, "timed_out": True, "number_of_nodes": 3, "number_of_data_nodes": 0, **zero}),
        ("elasticsearch_indices", {"index": "i1"}, {"status": "red", "status_code": 3, "number_of_shards": 2, "number_of_replicas": 0, **zero})]


def test_search_cluster_stats_only_from_master(spark):
    doc = '{"node_name":"n","cluster_name":"c","status":"green","indices":{"count":3,"shards":{"open":true}},"nodes":{"versions":["1.0"]}}'
    stats = snap(spark, doc, "s1").unionByName(snap(spark, doc, "s2"))
    nodes = snap(spark, NODES, "s1").unionByName(snap(spark, NODES.replace("n1", "n2"), "s2"))
    master = snap(spark, "n1 10.0.0.1 10.0.0.1 node-1\n", "s1").unionByName(snap(spark, "n1 10.0.0.1 10.0.0.1 node-1\n", "s2"))
    tags = {"node_name": "n", "cluster_name": "c", "status": "green"}
    assert points(search.cluster_stats(stats, nodes, master).metrics) == [
        ("elasticsearch_clusterstats_indices", tags, {"count": 3.0, "shards_open": True}),
        ("elasticsearch_clusterstats_nodes", tags, {"versions_0": "1.0"})]


OVERVIEW = ('{"message_stats":{"ack":1,"deliver":2,"deliver_get":3,"publish":4},"object_totals":{"channels":5,"connections":6,"queues":9},'
            '"queue_totals":{"messages":10,"messages_unacknowledged":12},"listeners":[{"protocol":"amqp"},{"protocol":"clustering"},{"protocol":"amqp"},{}]}')


def test_amqp_overview(spark):
    report = amqp.overview(snap(spark, [OVERVIEW, '{"object_totals":{},"queue_totals":{},"listeners":[]}', "x"], "http://b"), amqp.BrokerConfig(name="b"))
    assert only(report.points()) == ("rabbitmq_overview", {"url": "http://b", "name": "b"}, {
        "messages": 10, "messages_ready": 0, "messages_unacked": 12, "channels": 5, "connections": 6, "consumers": 0, "exchanges": 0, "queues": 9,
        "messages_acked": 1, "messages_delivered": 2, "messages_delivered_get": 3, "messages_published": 4, "clustering_listeners": 1, "amqp_listeners": 2})
    assert report.errors.count() == 2


def test_amqp_values_of_another_type_are_errors(spark):
    wrong = OVERVIEW.replace('"messages":10', '"messages":"ten"')
    report = amqp.overview(snap(spark, [wrong, OVERVIEW]))
    assert report.table.count() == 1 and report.errors.count() == 1
    lists = snap(spark, ['[{"name":"n","fd_used":"many"}]', "[]", "null", '[{"name":"n"}] x', '[{"name":"n","fd_used":null}]'])
    out = amqp.nodes(lists)
    assert out.table.count() == 1 and out.errors.count() == 3


def test_amqp_lists(spark):
    nodes = snap(spark, '[{"name":"a","disk_free":7,"running":true},{"name":"b"}]')
    got = points(amqp.nodes(nodes).points())
    assert [(p[1]["node"], p[2]["disk_free"], p[2]["running"], len(p[2])) for p in got] == [("a", 7, 1, 12), ("b", 0, 0, 12)]
    assert amqp.nodes(nodes, amqp.BrokerConfig(nodes=("b",))).table.count() == 1
    queues = snap(spark, '[{"name":"q1","vhost":"/","node":"a","durable":true,"messages":3,"message_stats":{"ack":2,"ack_details":{"rate":0.5}},"idle_since":"t"},{"name":"x1"}]')
    name, tags, fields = points(amqp.queues(queues).points())[1]
    assert tags == {"url": "s1", "queue": "q1", "vhost": "/", "node": "a", "durable": "true", "auto_delete": "false"}
    assert len(fields) == 22 and (fields["messages"], fields["messages_ack"], fields["messages_ack_rate"], fields["idle_since"]) == (3, 2, 0.5, "t")
    assert amqp.queues(queues, amqp.BrokerConfig(queues=("q1",))).table.count() == 1
    assert amqp.queues(queues, amqp.BrokerConfig(queue_include=("*1",), queue_exclude=("x*",))).table.count() == 1
    assert amqp.queues(queues, amqp.BrokerConfig(queue_exclude=("*",))).table.count() == 0
    exchanges = snap(spark, '[{"name":"e","type":"direct","vhost":"/","durable":true,"message_stats":{"publish_in":4}}]')
    assert only(amqp.exchanges(exchanges).points()) == ("rabbitmq_exchange", {
        "url": "s1", "exchange": "e", "type": "direct", "vhost": "/", "internal": "false", "durable": "true", "auto_delete": "false"},
        {"messages_publish_in": 4, "messages_publish_out": 0})
    assert amqp.exchanges(snap(spark, "[")).errors.count() == 1


def broker(spark):
    return table(spark, "topic_partitions", *[{"topic": t, "partition": p, "leader": lead, "replicas": [1, 2], "isr": [1], "topic_err": 0, "partition_err": err}
                                              for t, p, lead, err in (("a", 0, 1, 0), ("a", 1, -1, 5), ("b", 0, 2, 0))]) | table(
        spark, "broker_offsets", *[{"topic": t, "partition": p, "oldest": o, "offset": n, "err": e}
                                   for t, p, o, n, e in (("a", 0, True, 5, 0), ("a", 0, False, 9, 0), ("a", 1, True, 1, 0), ("b", 0, True, 3, 6))]) | table(
        spark, "group_offsets", *[{"group": g, "topic": t, "partition": 0, "offset": n, "err": e}
                                  for g, t, n, e in (("g1", "a", 4, 0), ("g1", "b", -1, 0), ("g2", "a", 4, 0), ("g1", "gone", 4, 0), ("g1", "b", 2, 3))])


def test_logbroker(spark):
    t = broker(spark)
    report = logbroker.offsets(t, ["*"])
    stamp = int(T0.timestamp()) * 1000
    assert [p[2] for p in points(report.points())] == [
        {"topic": "a", "partition": 0, "oldest": o, "offset": n, "timestamp": stamp, "topicPartitionCount": 2} for o, n in ((True, 5), (False, 9))]
    assert report.errors.count() == 2
    assert logbroker.offsets(t, []).table.count() == 0
    meta = logbroker.metadata(t, ["a*"])
    assert only(meta.points())[2] == {"topic": "a", "partition": 0, "topicPartitionCount": 2, "leader": 1, "replicas": "[1 2]", "Isr": "[1]", "timestamp": stamp}
    assert meta.errors.count() == 1
    groups = logbroker.groups(t, ["g1"])
    assert only(groups.points())[2] == {"group": "g1", "topic": "a", "partition": 0, "offset": 4, "timestamp": stamp}
    assert groups.errors.count() == 1


INFO = """# Server
redis_version:3.2.1
os:Linux
uptime_in_seconds:100

# Clients
connected_clients:3
# Memory
used_memory_human:1M
mem_fragmentation_ratio:1.5
# Persistence
rdb_last_save_time:1527000000
# Stats
keyspace_hits:3
keyspace_misses:1
# Replication
role:master
master_replid:abc
# Keyspace
db0:keys=2,expires=0,avg_ttl=0
db1:nothing
"""


@pytest.mark.parametrize("text", [INFO, INFO.replace("\n", "\r\n")])
def test_cache_info(spark, text):
    snaps = snap(spark, text, "tcp://localhost:6379")
    tags = {"server": "localhost", "port": "6379", "replication_role": "master"}
    assert only(cache.info(snaps).metrics) == ("redis", tags, {
        "redis_version": "3.2.1", "uptime": 100, "clients": 3, "mem_fragmentation_ratio": 1.5, "rdb_last_save_time": 1527000000,
        "rdb_last_save_time_elapsed": int(T0.timestamp()) - 1527000000, "keyspace_hits": 3, "keyspace_misses": 1, "keyspace_hitrate": 0.75})
    assert only(cache.keyspace(snaps).metrics) == ("redis_keyspace", {**tags, "database": "db0"}, {"keys": 2, "expires": 0, "avg_ttl": 0})


def test_cache_without_sections(spark):
    assert only(cache.info(snap(spark, "a:1\nbad\na:2:x\n#\n", "unix:///s")).metrics) == (
        "redis", {"socket": "/s"}, {"a": "2:x", "keyspace_hitrate": 0.0})


XML = ('<status><jvm><memory free="1" total="2" max="3"/><memorypool name="Eden" type="Heap memory" usageInit="1" usageCommitted="2" usageMax="3" usageUsed="4"/></jvm>'
       '<connector name="&quot;http-8080&quot;"><threadInfo maxThreads="200" currentThreadCount="5" currentThreadsBusy="1"/>'
       '<requestInfo maxTime="9" processingTime="8" requestCount="7" errorCount="6" bytesReceived="5" bytesSent="4"/></connector></status>')


def test_appserver(spark):
    snaps = snap(spark, [XML, "<status><jvm>"])
    report = appserver.status(snaps)
    parts = (appserver.connectors(snaps), appserver.memory(snaps), appserver.memory_pools(snaps))
    assert points(report.metrics) == [p for r in parts for p in points(r.points())]
    assert points(report.metrics) == [
        ("tomcat_connector", {"name": "http-8080"}, {"max_threads": 200, "current_thread_count": 5, "current_threads_busy": 1, "max_time": 9,
                                                     "processing_time": 8, "request_count": 7, "error_count": 6, "bytes_received": 5, "bytes_sent": 4}),
        ("tomcat_jvm_memory", {}, {"free": 1, "total": 2, "max": 3}),
        ("tomcat_jvm_memorypool", {"name": "Eden", "type": "Heap memory"}, {"init": 1, "committed": 2, "max": 3, "used": 4})]
    assert report.errors.count() == 1


MNTR = "zk_version\t3.4.9-1757313, built on 08/23/2016\nzk_avg_latency\t0\nzk_server_state\tleader\nzk_znode_count\t4\n"


def test_coord(spark):
    out = coord.mntr(snap(spark, [MNTR, MNTR + "stray\n"], "zk1"))
    assert only(out.metrics) == ("zookeeper", {"server": "zk1", "port": "2181", "state": "leader"},
                                 {"version": "3.4.9-1757313", "avg_latency": 0, "znode_count": 4})
    assert "stray" in out.errors.first().message
    assert coord.mntr(snap(spark, MNTR, "a:b:c")).errors.count() == 1


def test_gather_joins_inputs_and_normalises(spark):
    t = broker(spark) | {"snapshots": snap(spark, MNTR, "zk1", "coord", "mntr").unionByName(snap(spark, XML, "s", "appserver", "status"))}
    out = registry.gather(t, [
        registry.Wanted("coord.mntr", config=InputConfig(name_prefix="p_", tags={"dc": "x"}, filter=FilterSpec(field_drop=["znode*"]))),
        registry.Wanted("appserver.status"), registry.Wanted("logbroker.groups", {"group_patterns": ["g2"]})])
    got = points(out.metrics)
    assert [p[0] for p in got] == ["brokerOffsets", "p_zookeeper", "tomcat_connector", "tomcat_jvm_memory", "tomcat_jvm_memorypool"]
    assert got[1][1]["dc"] == "x" and "znode_count" not in got[1][2]


def test_gather_once_equals_gather_and_reads_snapshots_once(spark, tmp_path):
    path = str(tmp_path / "landed-snapshots")
    (snap(spark, [MNTR, "stray\n"], "zk1", "coord", "mntr").unionByName(snap(spark, [XML, "no xml"], "s", "appserver", "status"))
     .unionByName(snap(spark, "unasked", "z", "other", "e"))).write.parquet(path)
    t = broker(spark) | {"snapshots": spark.read.parquet(path)}
    wanted = [
        registry.Wanted("coord.mntr", config=InputConfig(name_prefix="p_", filter=FilterSpec(name_drop=["p_zoo*"]))),
        registry.Wanted("appserver.status"), registry.Wanted("coord.mntr"), registry.Wanted("logbroker.groups", {"group_patterns": ["g2"]})]
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run = registry.gather_once(t, wanted)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    plans = [e.physicalPlanDescription() for e in (store.executionsList().apply(i) for i in range(before, store.executionsCount()))]
    assert sum(text.count("landed-snapshots]") for text in plans) == 1
    lazy = registry.gather(t, wanted)
    assert points(run.result.metrics) == points(lazy.metrics)
    shown = lambda df: sorted((r.source, r.server, r.message) for r in df.collect())
    assert shown(run.result.errors) == shown(lazy.errors) and run.errors == lazy.errors.count() == 3
    # Gathered before the filters: the dropped points of the first input count.
    assert run.gathered == {"coord.mntr": 1, "appserver.status": 3, "coord.mntr#2": 1, "logbroker.groups": 1}
    assert run.result.metrics.count() == 5


def test_points_and_errors_are_kinds_of_one_frame(spark):
    result = coord.mntr(snap(spark, [MNTR, "stray\n"], "zk1", "coord", "mntr"))
    rows = registry.tagged(result).collect()
    assert sorted(r.kind for r in rows) == ["error", "point"] and all((r.point is None) == (r.kind == "error") == (r.error is not None) for r in rows)
    assert registry.tagged(registry.Result(result.metrics.limit(0), result.errors.limit(0))).count() == 0


def test_optional_table_and_registration(spark):
    from gaugeloom.sources.landing import table_or_empty

    empty = table_or_empty(spark, "no_such_table", "table_lock_waits")
    assert db.lock_waits({"table_lock_waits": empty}).points().count() == 0
    with pytest.raises(ValueError):
        registry.register("coord.mntr", coord.mntr)


def test_empty_input_gives_empty_output(spark):
    none = snap(spark, MNTR).filter(F.lit(False))
    for job in (coord.mntr, cache.info, cache.keyspace, search.node_stats):
        assert job(none).metrics.count() == 0


def test_one_pass_reports_equal_the_single_ones(spark):
    snaps = snap(spark, INFO, "tcp://localhost:6379")
    assert points(cache.status(snaps).metrics) == points(cache.info(snaps).metrics) + points(cache.keyspace(snaps).metrics)
    docs = snap(spark, ['{"cluster_name":"c","status":"green","indices":{"i1":{"status":"red"},"i2":{}}}', '{"cluster_name":"d"}'])
    both = points(search.health(docs).points()) + points(search.index_health(docs).points())
    assert points(search.health_points(docs).metrics) == both and len(both) == 4


def test_odd_input_does_not_stop_a_job(spark):
    """One bad row among many must not raise: it loses a field, or becomes an error row."""
    from datetime import datetime, timezone

    odd = "# Stats\nkeyspace_hits:9223372036854775807\nkeyspace_misses:9223372036854775807\nrdb_last_save_time:-9223372036854775808\na:1\na:2\n"
    assert only(cache.info(snap(spark, odd, "h:1")).metrics)[2] == {
        "keyspace_hits": 2**63 - 1, "keyspace_misses": 2**63 - 1, "rdb_last_save_time": -(2**63), "a": 2}
    late = snap(spark, MNTR, ts=datetime(9000, 1, 1, tzinfo=timezone.utc))
    assert coord.mntr(late).metrics.first().time_ns is None
    t = table(spark, "global_variables", *names(("Version", "1"), ("version", "2"), ("a", "3"), ("A", "4")))
    name, tags, fields = only(db.global_variables(t).metrics)
    assert tags["version"] == "2" and fields == {"version": 2.0, "a": 4.0}
    twice = NODES.replace('"rack":"r1"', '"rack":"r1","rack":"r2"')
    assert points(search.node_stats(snap(spark, twice)).metrics)[0][1]["node_attribute_rack"] == "r2"
    t = history(spark)
    t["uptime"] = t["uptime"].withColumn("uptime_seconds", F.lit(float("nan")))
    assert db.statements(t).table.filter("start_time is not null").count() == 0
    big = table(spark, "binary_logs", *[{"file": str(i), "size": Decimal(99999999999999999999)} for i in range(3)])
    assert only(db.binary_logs(big).points())[2]["binary_size_bytes"] == 2**63 - 1
