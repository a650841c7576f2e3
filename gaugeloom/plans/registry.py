"""Inputs by name, and the union of the reports a run asks for.

An input is a function of landed tables that returns a ``Report`` or a ``Result``; registering one makes it
available to ``gather`` and ``gather_once``.

``gather`` is a plan: its points and its errors are two queries, and every input filters the snapshots on its own. It works
on streams. ``gather_once`` runs: the snapshots are read once and laid out by source and endpoint, so each input reads only its own
folder; then points and errors of all inputs are written in one go, as rows of one kind or the other, and the write itself
counts what each input gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from gaugeloom.model import ERRORS, METRIC, Report, Result
from gaugeloom.operators.inputs import InputConfig, counted, normalise, observed
from gaugeloom.plans import amqp, appserver, cache, coord, database, logbroker, search
from gaugeloom.session import scratch_dir

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Input:
    """What an input reads and how it is described; ``gather`` does the work."""

    gather: Callable[..., Report | Result]
    needs: tuple[str, ...]
    description: str = ""
    endpoints: tuple[tuple[str, str], ...] = ()


REGISTRY: dict[str, Input] = {}


def register(name: str, gather: Callable[..., Report | Result], needs: tuple[str, ...] = (), description: str = "",
             endpoints: tuple[tuple[str, str], ...] = ()) -> None:
    """``endpoints`` are the (source, endpoint) pairs of the snapshots that the input reads; without any it may read all."""
    if name in REGISTRY:
        raise ValueError(f"input {name!r} is already registered")
    REGISTRY[name] = Input(gather, needs, description, endpoints)


def _pick(tables: Tables, source: str, endpoint: str) -> DataFrame:
    return tables["snapshots"].filter((F.col("source") == source) & (F.col("endpoint") == endpoint))


def _from_snapshots(name: str, job, source: str, *endpoints: str) -> None:
    """Register a job that takes the snapshots of each endpoint."""
    pairs = tuple((source, e) for e in endpoints)
    register(name, lambda tables, **options: job(*[_pick(tables, *p) for p in pairs], **options), ("snapshots",), endpoints=pairs)


for _name, _job in database.REPORTS.items():
    register(f"database.{_name}", _job, description=(_job.__doc__ or "").strip().split("\n")[0])

_from_snapshots("search.node_stats", search.node_stats, "search", "nodes")
_from_snapshots("search.health", search.health_points, "search", "health")
_from_snapshots("search.cluster_stats", search.cluster_stats, "search", "cluster_stats", "nodes", "master")
for _name in ("overview", "nodes", "queues", "exchanges"):
    _from_snapshots(f"amqp.{_name}", getattr(amqp, _name), "amqp", _name)
register("logbroker.offsets", logbroker.offsets, ("broker_offsets", "topic_partitions"))
register("logbroker.metadata", logbroker.metadata, ("topic_partitions",))
register("logbroker.groups", logbroker.groups, ("group_offsets", "topic_partitions"))
_from_snapshots("cache.status", cache.status, "cache", "info")
_from_snapshots("appserver.status", appserver.status, "appserver", "status")
_from_snapshots("coord.mntr", coord.mntr, "coord", "mntr")


@dataclass(frozen=True)
class Wanted:
    """One chosen input with its options and its point settings."""

    name: str
    options: dict = field(default_factory=dict)
    config: InputConfig = field(default_factory=InputConfig)


def _run(tables: Tables, w: Wanted) -> Result:
    out = REGISTRY[w.name].gather(tables, **w.options)
    return out.result() if isinstance(out, Report) else out


def gather(tables: Tables, wanted: list[Wanted]) -> Result:
    """Points and errors of all chosen inputs, each normalised by its own settings."""
    def one(w: Wanted) -> Result:
        result = _run(tables, w)
        return Result(normalise(result.metrics, w.config), result.errors)

    return reduce(Result.union, [one(w) for w in wanted])


def by_endpoint(snapshots: DataFrame, endpoints: set[tuple[str, str]]) -> DataFrame:
    """The snapshots of these endpoints, read once and written by source and endpoint: a filter on both reads one folder."""
    chosen = reduce(lambda a, b: a | b, [(F.col("source") == s) & (F.col("endpoint") == e) for s, e in sorted(endpoints)])
    path = scratch_dir(snapshots.sparkSession, "endpoints")
    snapshots.filter(chosen).write.partitionBy("source", "endpoint").parquet(path)
    return snapshots.sparkSession.read.schema(snapshots.schema).parquet(path).select(*snapshots.columns)


def tagged(result: Result) -> DataFrame:
    """Points and errors as rows of one frame: ``kind``, and ``point`` or ``error``."""
    point, error = T.StructType(METRIC.fields), T.StructType(ERRORS.fields)
    points = result.metrics.select(F.lit("point").alias("kind"), F.struct(*METRIC.names).cast(point).alias("point"), F.lit(None).cast(error).alias("error"))
    errors = result.errors.select(F.lit("error").alias("kind"), F.lit(None).cast(point).alias("point"), F.struct(*ERRORS.names).cast(error).alias("error"))
    return points.unionByName(errors)


@dataclass(frozen=True)
class Run:
    """What a run wrote, and what it counted while writing: points gathered by each input before its filters, and errors."""

    result: Result
    gathered: dict[str, int]
    errors: int


def gather_once(tables: Tables, wanted: list[Wanted]) -> Run:
    """Run the chosen inputs with one scan of the snapshots and one write of points and errors.

    An input chosen more than once counts once for each time; its name then ends in ``#2``, ``#3`` and so on.
    """
    pairs = [REGISTRY[w.name].endpoints for w in wanted if "snapshots" in REGISTRY[w.name].needs]
    spark = next(iter(tables.values())).sparkSession
    if pairs and all(pairs):
        tables = {**tables, "snapshots": by_endpoint(tables["snapshots"], {p for some in pairs for p in some})}
    counts: dict[str, Observation] = {}
    parts, names = [], []
    for w in wanted:
        names.append(w.name)
        label = w.name if names.count(w.name) == 1 else f"{w.name}#{names.count(w.name)}"
        result = _run(tables, w)
        metrics, counts[label] = observed(result.metrics, f"gathered {label}")
        parts.append(Result(normalise(metrics, w.config), result.errors))
    whole = reduce(Result.union, parts)
    failed = Observation("gather errors")
    errors = whole.errors.observe(failed, F.count(F.lit(1)).alias("gather_errors"))
    path = scratch_dir(spark, "gathered")
    rows = tagged(Result(whole.metrics, errors))
    rows.write.partitionBy("kind").parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    result = Result(written.filter(F.col("kind") == "point").select("point.*"), written.filter(F.col("kind") == "error").select("error.*"))
    return Run(result, {n: counted(o, "metrics_gathered") for n, o in counts.items()}, counted(failed, "gather_errors"))
