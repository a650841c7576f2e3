"""Registration and shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeloom.functions.times import utc
from gaugeloom.operators.points import make_point

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A fixed collection time for tables that carry none.
STAMP = "TIMESTAMP_NTZ'2024-02-01 00:00:00'"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stamp() -> Column:
    return utc(F.expr(STAMP))


def k_of(props: str = "props") -> Column:
    """The number in ``{"k": N}``."""
    return F.get_json_object(props, "$.k").cast("bigint")


#: The same number in the comparison SQL.
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").withColumns({"ts": utc(F.col("ts")), "k": k_of()})


def event_points(spark: SparkSession, sf_dir: str, **tags: Column) -> DataFrame:
    """Events as points: the type is the measurement, user and type are tags, value and k are fields."""
    df = events(spark, sf_dir)
    named = {"user": F.col("user_id"), "type": F.col("event_type"), **tags}
    return make_point(df, F.col("event_type"), named, {"value": F.col("value"), "k": F.col("k")}, F.col("ts"),
                      source="events", keep=("event_id",))


def snapshots(df: DataFrame, server: Column, payload: Column, at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(F.lit("q").alias("source"), server.alias("server"), F.lit("e").alias("endpoint"),
                     (at if at is not None else stamp()).alias("collected_at"), payload.alias("payload"), *keep)


def joined(*parts) -> Column:
    """Text of literals and columns in order."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def keys_text(column: str) -> Column:
    return F.array_join(F.sort_array(F.map_keys(column)), ",")


def tag(name: str) -> Column:
    return F.col("tags")[name]


def num(name: str, kind: str = "f") -> Column:
    return F.try_element_at(F.col("fields"), F.lit(name))[kind].alias(name)
