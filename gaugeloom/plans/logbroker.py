"""Log broker reports over landed offset and partition tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from gaugeloom.functions.times import epoch_ms
from gaugeloom.model import Report, error_rows
from gaugeloom.operators.filters import match_any

SOURCE = "kafka"
KEYS = ["server", "collected_at"]
NAME = "brokerOffsets"


def _counted(partitions: DataFrame) -> DataFrame:
    """Partitions with the number of partitions of their topic."""
    counts = partitions.groupBy(*KEYS, "topic").agg(F.count(F.lit(1)).alias("topicPartitionCount"))
    return partitions.join(counts, [*KEYS, "topic"])


def _refused(df: DataFrame, message) -> DataFrame:
    return error_rows(df, SOURCE, message, server=F.col("server"), endpoint=F.lit(NAME), ts=F.col("collected_at"))


def _spot(text: str):
    return F.concat(F.lit(f"{text} "), F.col("topic"), F.lit(":"), F.col("partition").cast("string"))


def offsets(tables: Mapping[str, DataFrame], topics: list[str]) -> Report:
    """Oldest and newest offset of every partition of the chosen topics.

    A partition without a leader or with an error code is reported and left out; the others stay.
    """
    parts = tables["topic_partitions"].filter(match_any(F.col("topic"), topics))
    rows = tables["broker_offsets"].filter(match_any(F.col("topic"), topics))
    leaders = _counted(parts).select(*KEYS, "topic", "partition", "leader", "topicPartitionCount")
    placed = rows.join(leaders, [*KEYS, "topic", "partition"], "left")
    led = F.coalesce(F.col("leader") >= 0, F.lit(False))
    good = placed.filter(led & (F.col("err") == 0))
    table = good.select(*KEYS, "topic", "partition", "oldest", "offset",
                        epoch_ms(F.col("collected_at")).alias("timestamp"), "topicPartitionCount")
    errors = _refused(placed.filter(~led), _spot("topic leader error on")).unionByName(
        _refused(placed.filter(led & (F.col("err") != 0)), _spot("error in offset response for")))
    return Report(NAME, table, {}, {c: c for c in table.columns[2:]}, SOURCE, errors)


def metadata(tables: Mapping[str, DataFrame], topics: list[str]) -> Report:
    """Leader, replicas and in-sync replicas of every partition."""
    parts = tables["topic_partitions"].filter(match_any(F.col("topic"), topics))
    good = _counted(parts).filter((F.col("topic_err") == 0) & (F.col("partition_err") == 0))
    table = good.select(*KEYS, "topic", "partition", "topicPartitionCount", "leader", "replicas",
                        F.col("isr").alias("Isr"), epoch_ms(F.col("collected_at")).alias("timestamp"))
    errors = _refused(parts.filter(F.col("topic_err") != 0), F.concat(
        F.lit("cannot get topic metadata "), F.col("topic"))).unionByName(
        _refused(parts.filter((F.col("topic_err") == 0) & (F.col("partition_err") != 0)),
                 _spot("cannot get topic partition metadata")))
    return Report(NAME, table, {}, {c: c for c in table.columns[2:]}, SOURCE, errors)


def groups(tables: Mapping[str, DataFrame], group_patterns: list[str]) -> Report:
    """Committed offsets of the chosen groups, for every topic the cluster has.

    Each group is asked about all partitions of all topics, and an unset offset gives no row. Keeping the
    answers whose partition exists is the same set, so the request product is never built.
    """
    rows = tables["group_offsets"].filter(match_any(F.col("group"), group_patterns))
    asked = rows.join(tables["topic_partitions"].select(*KEYS, "topic", "partition"), [*KEYS, "topic", "partition"], "left_semi")
    table = asked.filter((F.col("err") == 0) & (F.col("offset") != -1)).select(
        *KEYS, "group", "topic", "partition", "offset", epoch_ms(F.col("collected_at")).alias("timestamp"))
    errors = _refused(asked.filter(F.col("err") != 0), F.concat(
        F.lit("cannot get group topic offsets "), F.col("group")))
    return Report(NAME, table, {}, {c: c for c in table.columns[2:]}, SOURCE, errors)
