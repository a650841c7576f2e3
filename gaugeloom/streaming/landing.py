"""Streams over landing folders, and the sinks they end in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeloom.operators.inputs import InputConfig, normalise
from gaugeloom.session import scratch_dir


def read_landing(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder (or path glob) as they land; the checkpoint remembers which were read."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, *, interval: str | None = None, mode: str = "append",
    partition_by: tuple[str, ...] = (), name: str | None = None,
) -> StreamingQuery:
    """Append to Parquet. Without an interval all landed files are read once and the query ends."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def write_batches(
    df: DataFrame, path: str, checkpoint: str, *, interval: str | None = None, mode: str = "update",
) -> StreamingQuery:
    """Write every micro-batch to its own folder, so a repeated batch replaces itself."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stream_points(points: DataFrame, cfg: InputConfig, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """The whole point path on a stream: nothing in it keeps state."""
    return write_stream(normalise(points, cfg), path, checkpoint, interval=interval, partition_by=("source",))


def drain(spark: SparkSession, df: DataFrame, purpose: str, mode: str = "append") -> str:
    """Run a stream over everything that has landed; the folder with its result."""
    out, checkpoint = scratch_dir(spark, purpose), scratch_dir(spark, f"{purpose}-checkpoint")
    start = write_stream if mode == "append" else write_batches
    query = start(df, out, checkpoint, mode=mode)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return out


def drained(spark: SparkSession, df: DataFrame, purpose: str, mode: str = "append") -> DataFrame:
    """``drain`` and read the result back as a table."""
    out = drain(spark, df, purpose, mode)
    return spark.read.parquet(out) if mode == "update" else spark.read.schema(df.schema).parquet(out)


def latest(df: DataFrame, keys: list[str], version: str = "batch") -> DataFrame:
    """Last update of every key out of batch folders."""
    rest = [c for c in df.columns if c not in (*keys, version)]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_r"))
    return newest.select(*keys, "_r.*")


