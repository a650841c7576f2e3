"""Cursors of incremental batch runs, one per server."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeloom.model import Report
from gaugeloom.plans.database import next_cursor

CURSORS = "server string, end_time timestamp"


def load_cursors(spark: SparkSession, path: str) -> DataFrame | None:
    """Latest end time per server, or None before the first run.

    Every run appends its cursors, so the folder holds the history and a run that is repeated changes nothing.
    """
    try:
        saved = spark.read.schema(CURSORS).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return saved.groupBy("server").agg(F.max("end_time").alias("end_time"))


def save_cursors(cursors: DataFrame, path: str) -> None:
    cursors.select("server", "end_time").write.mode("append").parquet(path)


def _batch_name(cursors: DataFrame | None) -> str:
    """A name that only depends on where the run starts."""
    if cursors is None:
        return "first"
    row = cursors.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("server", "end_time")).alias("h")).first()
    return f"{row['n']}-{(row['h'] or 0) & (2 ** 64 - 1):016x}"


def run_incremental(
    spark: SparkSession, job: Callable[[DataFrame | None], Report], out: str, cursor_path: str,
) -> None:
    """Append what is new since the cursors to ``out``, then move them.

    The cursors are taken from the rows that were written, so rows landing meanwhile are left for the next run. A batch is
    named after the cursors it starts at: a run that broke before they moved is repeated over its own batch.
    """
    cursors = load_cursors(spark, cursor_path)
    report = job(cursors)
    batch = f"{out}/run={_batch_name(cursors)}"
    report.table.write.mode("overwrite").parquet(batch)
    save_cursors(next_cursor(spark.read.schema(report.table.schema).parquet(batch)), cursor_path)
