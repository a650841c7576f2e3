"""JSON documents and JSON lines as points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeloom.functions.jsonflat import document_points
from gaugeloom.functions.maps import once
from gaugeloom.functions.values import float_field
from gaugeloom.model import Result, error_rows
from gaugeloom.operators.points import map_point, merge_under


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("doc"), F.col("_metadata.file_modification_time").alias("collected_at"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("value").alias("doc"), F.col("_metadata.file_modification_time").alias("collected_at"))


def parse_json_docs(
    df: DataFrame, name: str, tag_keys: list[str] = (), default_tags: dict[str, str] | None = None, *,
    doc: str = "doc", ts: str = "collected_at", single: bool = False,
) -> Result:
    """Points of JSON documents. Listed members become tags; numbers become fields; blank text gives nothing.

    With ``single`` every row must hold a point, and only its first one counts: the line form.
    """
    parsed = once(df, _doc=document_points(F.col(doc), list(tag_keys)))
    blank = F.coalesce(F.size("_doc.points") == 0, F.lit(True))
    failed = F.col("_doc.error")
    if single:
        failed = F.coalesce(failed, F.when(blank, F.concat(F.lit("can not parse the line: "), F.coalesce(F.col(doc), F.lit("")))))
    documents = error_rows(parsed.filter(failed.isNotNull()), "json", failed, ts=F.col(ts))
    points = F.slice("_doc.points", 1, 1) if single else F.col("_doc.points")
    found = parsed.filter(~blank).select(F.col(ts).alias("_ts"), F.explode(points).alias("_p"))
    empty = error_rows(found.filter(F.col("_p.error").isNotNull()), "json", F.col("_p.error"), ts=F.col("_ts"))
    tags = F.col("_p.tags")
    if default_tags:
        tags = merge_under(tags, F.create_map(*[F.lit(x) for kv in default_tags.items() for x in kv]))
    metrics = map_point(
        found.filter(F.col("_p.error").isNull()), name, tags,
        F.transform_values("_p.fields", lambda _, v: float_field(v)), F.col("_ts"), source="json")
    return Result(metrics, documents.unionByName(empty))
