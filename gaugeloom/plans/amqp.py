"""Message broker reports over landed JSON replies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.functions.maps import once
from gaugeloom.functions.values import bool_number, bool_text
from gaugeloom.model import Report, error_rows
from gaugeloom.operators.filters import allow_list, include_exclude

SOURCE = "rabbitmq"
KEYS = ["server", "collected_at"]

_RATES = ", ".join(f"{n}_details: struct<rate: double>" for n in ("ack", "deliver", "deliver_get", "publish", "redeliver"))
_MESSAGES = ("ack: bigint, deliver: bigint, deliver_get: bigint, publish: bigint, redeliver: bigint, "
             f"publish_in: bigint, publish_out: bigint, {_RATES}")
_TOTALS = ("messages", "messages_ready", "messages_unacknowledged", "message_bytes", "message_bytes_ready",
           "message_bytes_unacknowledged", "message_bytes_ram", "message_bytes_persistent")
_TOTALS_DDL = ", ".join(f"{t}: bigint" for t in _TOTALS)
_OBJECTS = ("channels", "connections", "consumers", "exchanges", "queues")
_NODE_COUNTS = ("disk_free", "disk_free_limit", "fd_total", "fd_used", "mem_limit", "mem_used", "proc_total",
                "proc_used", "run_queue", "sockets_total", "sockets_used")

OVERVIEW = (f"message_stats struct<{_MESSAGES}>, object_totals struct<{', '.join(f'{o}: bigint' for o in _OBJECTS)}>, "
            f"queue_totals struct<{_TOTALS_DDL}>, listeners array<struct<protocol: string>>, _bad string")
NODES = f"array<struct<name: string, {', '.join(f'{c}: bigint' for c in _NODE_COUNTS)}, running: boolean>>"
QUEUES = (f"array<struct<{_TOTALS_DDL}, message_stats: struct<{_MESSAGES}>, memory: bigint, consumers: bigint, "
          "consumer_utilisation: double, name: string, node: string, vhost: string, durable: boolean, "
          "auto_delete: boolean, idle_since: string>>")
EXCHANGES = (f"array<struct<name: string, message_stats: struct<{_MESSAGES}>, type: string, internal: boolean, "
             "vhost: string, durable: boolean, auto_delete: boolean>>")


@dataclass(frozen=True)
class BrokerConfig:
    name: str = ""
    nodes: tuple[str, ...] = ()
    exchanges: tuple[str, ...] = ()
    queues: tuple[str, ...] = ()
    queue_include: tuple[str, ...] = ()
    queue_exclude: tuple[str, ...] = ()


def _errors(df: DataFrame, message: str) -> DataFrame:
    return error_rows(df, SOURCE, F.lit(message), server=F.col("server"), endpoint=F.col("endpoint"),
                      ts=F.col("collected_at"))


def _number(path: str) -> Column:
    return F.coalesce(path, F.lit(0))


def _text(path: str) -> Column:
    return F.coalesce(path, F.lit(""))


def overview(snapshots: DataFrame, cfg: BrokerConfig = BrokerConfig()) -> Report:
    """Broker totals; a reply that lacks one of its four sections, or has a value of another type in them, is an error."""
    parsed = once(snapshots, _d=F.from_json("payload", OVERVIEW, {"columnNameOfCorruptRecord": "_bad"}))
    whole = F.col("_d._bad").isNull()
    for part in ("queue_totals", "object_totals", "message_stats", "listeners"):
        whole = whole & F.col(f"_d.{part}").isNotNull()
    good = parsed.filter(whole)

    def listening(protocol: str) -> Column:
        return F.size(F.filter("_d.listeners", lambda x: F.coalesce(x["protocol"] == protocol, F.lit(False)))).cast("bigint")

    table = good.select(
        *KEYS, F.col("server").alias("url"), F.lit(cfg.name).alias("broker_name"),
        _number("_d.queue_totals.messages").alias("messages"),
        _number("_d.queue_totals.messages_ready").alias("messages_ready"),
        _number("_d.queue_totals.messages_unacknowledged").alias("messages_unacked"),
        *[_number(f"_d.object_totals.{o}").alias(o) for o in _OBJECTS],
        _number("_d.message_stats.ack").alias("messages_acked"),
        _number("_d.message_stats.deliver").alias("messages_delivered"),
        _number("_d.message_stats.deliver_get").alias("messages_delivered_get"),
        _number("_d.message_stats.publish").alias("messages_published"),
        listening("clustering").alias("clustering_listeners"), listening("amqp").alias("amqp_listeners"))
    return Report("rabbitmq_overview", table, {"url": "url", "name": "broker_name"},
                  {c: c for c in table.columns[4:]}, SOURCE,
                  _errors(parsed.filter(~whole), "wrong answer, probably an auth issue"))


def _items(snapshots: DataFrame, ddl: str) -> tuple[DataFrame, DataFrame]:
    # An array schema would take a lone object, such as an error reply, for an array of one. As a member of an object, the array
    # has a place beside it for the reply if a value in it is of another type.
    listed = F.when(F.col("payload").rlike(r"\A\s*\["), F.concat(F.lit('{"items":'), F.col("payload"), F.lit("}")))
    parsed = once(snapshots, _d=F.from_json(listed, f"items {ddl}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    good = F.col("_d.items").isNotNull() & F.col("_d._bad").isNull()
    items = parsed.filter(good).select(*KEYS, F.col("server").alias("url"), F.explode("_d.items").alias("x"))
    return items, _errors(parsed.filter(~good), "invalid reply")


def nodes(snapshots: DataFrame, cfg: BrokerConfig = BrokerConfig()) -> Report:
    items, errors = _items(snapshots, NODES)
    table = items.filter(allow_list(F.col("x.name"), list(cfg.nodes))).select(
        *KEYS, "url", _text("x.name").alias("node"), *[_number(f"x.{c}").alias(c) for c in _NODE_COUNTS],
        bool_number(F.col("x.running")).alias("running"))
    return Report("rabbitmq_node", table, {"url": "url", "node": "node"}, {c: c for c in table.columns[4:]}, SOURCE, errors)


def queues(snapshots: DataFrame, cfg: BrokerConfig = BrokerConfig()) -> Report:
    """Queue counters; excluding ``*`` switches the report off, the older list adds to the include list."""
    if "*" in cfg.queue_exclude:
        snapshots = snapshots.filter(F.lit(False))
    items, errors = _items(snapshots, QUEUES)
    name = _text("x.name")
    kept = items.filter(include_exclude(name, [*cfg.queue_include, *cfg.queues], list(cfg.queue_exclude)))
    stats = "x.message_stats"
    table = kept.select(
        *KEYS, "url", name.alias("queue"), _text("x.vhost").alias("vhost"), _text("x.node").alias("node"),
        bool_text(F.col("x.durable")).alias("durable"), bool_text(F.col("x.auto_delete")).alias("auto_delete"),
        _number("x.consumers").alias("consumers"),
        F.coalesce("x.consumer_utilisation", F.lit(0.0)).alias("consumer_utilisation"),
        _text("x.idle_since").alias("idle_since"), _number("x.memory").alias("memory"),
        _number("x.message_bytes").alias("message_bytes"), _number("x.message_bytes_ready").alias("message_bytes_ready"),
        _number("x.message_bytes_unacknowledged").alias("message_bytes_unacked"),
        _number("x.message_bytes_ram").alias("message_bytes_ram"),
        _number("x.message_bytes_persistent").alias("message_bytes_persist"),
        _number("x.messages").alias("messages"), _number("x.messages_ready").alias("messages_ready"),
        _number("x.messages_unacknowledged").alias("messages_unack"),
        *[c for kind in ("ack", "deliver", "deliver_get", "publish", "redeliver") for c in (
            _number(f"{stats}.{kind}").alias(f"messages_{kind}"),
            F.coalesce(f"{stats}.{kind}_details.rate", F.lit(0.0)).alias(f"messages_{kind}_rate"))])
    return Report("rabbitmq_queue", table, {c: c for c in table.columns[2:8]}, {c: c for c in table.columns[8:]},
                  SOURCE, errors)


def exchanges(snapshots: DataFrame, cfg: BrokerConfig = BrokerConfig()) -> Report:
    items, errors = _items(snapshots, EXCHANGES)
    table = items.filter(allow_list(F.col("x.name"), list(cfg.exchanges))).select(
        *KEYS, "url", _text("x.name").alias("exchange"), _text("x.type").alias("type"), _text("x.vhost").alias("vhost"),
        *[bool_text(F.col(f"x.{c}")).alias(c) for c in ("internal", "durable", "auto_delete")],
        _number("x.message_stats.publish_in").alias("messages_publish_in"),
        _number("x.message_stats.publish_out").alias("messages_publish_out"))
    return Report("rabbitmq_exchange", table, {c: c for c in table.columns[2:9]}, {c: c for c in table.columns[9:]},
                  SOURCE, errors)
