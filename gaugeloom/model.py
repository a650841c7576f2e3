"""The point model: one row per metric point, with tag and field maps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

FIELD = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("i", T.LongType()),
    T.StructField("f", T.DoubleType()),
    T.StructField("s", T.StringType()),
    T.StructField("b", T.BooleanType()),
])
FIELD_DDL = "struct<kind:string,i:bigint,f:double,s:string,b:boolean>"

METRIC = T.StructType([
    T.StructField("measurement", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("fields", T.MapType(T.StringType(), FIELD)),
    T.StructField("ts", T.TimestampType()),
    T.StructField("time_ns", T.LongType()),
    T.StructField("mtype", T.StringType()),
    T.StructField("is_aggregate", T.BooleanType()),
    T.StructField("source", T.StringType()),
])

ERRORS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("message", T.StringType()),
])

#: Point value types.
VALUE_TYPES = ("counter", "gauge", "untyped", "summary", "histogram")

INT64_MAX = 9223372036854775807


@dataclass(frozen=True)
class Result:
    """Points of a job and the rows it refused; both stay distributed."""

    metrics: DataFrame
    errors: DataFrame

    def union(self, other: "Result") -> "Result":
        return Result(self.metrics.unionByName(other.metrics), self.errors.unionByName(other.errors))


@dataclass(frozen=True)
class Report:
    """A job whose output columns are known up front.

    ``table`` is the typed wide table that analytics should read: it prunes columns and pushes filters
    down. ``points()`` turns the same rows into metric points.
    """

    measurement: str | Column
    table: DataFrame
    tags: dict[str, str]
    fields: dict[str, str]
    source: str
    errors: DataFrame | None = None
    keep: Column | None = None
    ts: str = "collected_at"

    def points(self) -> DataFrame:
        from gaugeloom.operators.points import make_point

        rows = self.table if self.keep is None else self.table.filter(self.keep)
        return make_point(
            rows,
            self.measurement,
            {k: F.col(v) for k, v in self.tags.items()},
            {k: F.col(v) for k, v in self.fields.items()},
            ts=F.col(self.ts),
            source=self.source,
        )

    def result(self) -> Result:
        errors = self.errors
        if errors is None:
            errors = no_errors(self.table.sparkSession)
        return Result(self.points(), errors)


def no_errors(spark) -> DataFrame:
    return spark.createDataFrame([], ERRORS)


def error_rows(
    df: DataFrame, source: str, message: Column, *, server: Column | None = None,
    endpoint: Column | None = None, ts: Column | None = None,
) -> DataFrame:
    """Shape refused input rows like ``ERRORS``; credentials in the message are masked."""
    from gaugeloom.functions.text import mask_url

    null = F.lit(None).cast("string")
    return df.select(
        F.lit(source).alias("source"),
        (server if server is not None else null).alias("server"),
        (endpoint if endpoint is not None else null).alias("endpoint"),
        (ts if ts is not None else F.lit(None).cast("timestamp")).alias("ts"),
        mask_url(message).alias("message"),
    )


def series_key(measurement: Column, tags: Column) -> Column:
    """Canonical text of a series: the name, then the tags in key order."""
    pairs = F.transform(F.sort_array(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit("\x01"), e["value"]))
    return F.concat(measurement, F.lit("\x02"), F.array_join(pairs, "\x02"))


def series_id(measurement: Column, tags: Column) -> Column:
    """Stable 64-bit series identity; independent of the order tags were added in."""
    return F.xxhash64(measurement, F.sort_array(F.map_entries(tags)))


def to_long(df: DataFrame) -> DataFrame:
    """One row per field of every point."""
    rest = [c for c in df.columns if c != "fields"]
    return df.select(*rest, F.explode("fields").alias("field", "_v")).select(*rest, "field", "_v.*")


def to_wide(
    df: DataFrame, tags: list[str], fields: dict[str, str], measurement: str | None = None,
) -> DataFrame:
    """Typed columns for one measurement; ``fields`` maps a name to its kind (i, f, s or b). No shuffle."""
    if measurement is not None:
        df = df.filter(F.col("measurement") == measurement)
    return df.select(
        "measurement",
        "ts",
        *[F.col("tags")[t].alias(t) for t in tags],
        *[F.col("fields")[name][kind].alias(name) for name, kind in fields.items()],
    )
