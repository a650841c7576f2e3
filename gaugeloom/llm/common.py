"""Registration, inputs and small helpers that the operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeloom.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again: lineage ends there, and a lost executor loses nothing."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty. Bytes reach Python even where they aren't valid UTF-8."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


#: Rows of an Arrow batch of texts. Spark's default of 10,000 long texts would fill hundreds of MB on both sides.
BATCH_ROWS = 1000


def to_python(df: DataFrame) -> DataFrame:
    """The frame, to be sent to Python in batches of at most ``BATCH_ROWS`` rows from now on in this session."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    rows = int(conf.get(setting))
    if rows <= 0 or rows > BATCH_ROWS:
        conf.set(setting, str(BATCH_ROWS))
    return df


def _worker_store() -> types.ModuleType:
    return sys.modules.setdefault("_gaugeloom_worker_cache", types.ModuleType("_gaugeloom_worker_cache"))


def forget_caches(*but: str) -> None:
    """Drops what operators that ran earlier in this Python worker process left, but for these kinds."""
    store = _worker_store()
    for kind in [k for k in vars(store) if not k.startswith("__") and k not in but]:
        delattr(store, kind)


def worker_cache(kind: str, key: str, build: Callable):
    """What ``build`` makes, once in each Python worker process: workers are used again for later tasks. The last of each kind is kept."""
    store = _worker_store()
    if getattr(store, kind, (None,))[0] != key:
        setattr(store, kind, (None,))
        setattr(store, kind, (key, build()))
    return getattr(store, kind)[1]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of batches with about ``limit`` bytes in a binary column; a longer row stands alone."""
    for batch in batches:
        sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)]
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)
