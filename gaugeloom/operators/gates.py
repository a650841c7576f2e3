"""Elapsed-time gate: a server reports again only once the interval since its last report is over.

Which snapshots report depends on every report before, so it is a fold in time order. To keep one busy server from being folded in
one task, its snapshot times are cut into slices of ``SLICE_INTERVALS`` intervals. The last report before a slice lies before
the slice, so the first one in it is the first snapshot at or after some time within the slice's first interval: only the
snapshots of that interval, and the next one, can be the first. For each of these the slice's last report is worked out in the slice's
own task. What is left for a server is one step a slice, and then every slice marks its reports on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.session import ship_with_tasks

ship_with_tasks(__name__)

SLICE_INTERVALS = 1024


def _exits(interval: int, length: int):
    """Possible first reports of a slice, and the slice's last report after each of them."""
    def work(table: pa.Table) -> pa.Table:
        times = np.sort(table.column("_us").to_numpy())
        following = np.searchsorted(times, times + interval)
        last = np.arange(len(times))
        for i in range(len(times) - 1, -1, -1):
            if following[i] < len(times):
                last[i] = last[following[i]]
        start = int(table.column("_slice")[0].as_py()) * length
        n = min(len(times), int(np.searchsorted(times, start + interval)) + 1)
        keys = table.slice(0, 1).select(["_key", "_slice"])
        return pa.table({**{c: pa.concat_arrays([keys.column(c).combine_chunks()] * n) for c in keys.column_names},
                         "first": pa.array(times[:n]), "last": pa.array(times[last[:n]])})

    return work


def _firsts(slices: Column, interval: int) -> Column:
    """(slice, first report) of a server, from its slices in order with the possible first reports of each."""
    empty = F.expr("named_struct('last', CAST(NULL AS BIGINT), 'out', CAST(array() AS ARRAY<STRUCT<_slice: BIGINT, first: BIGINT>>))")

    def step(state: Column, s: Column) -> Column:
        fits = F.filter(s["choices"], lambda c: state["last"].isNull() | (c["first"] >= state["last"] + interval))
        hit = F.get(fits, F.lit(0))
        return F.when(F.size(fits) == 0, state).otherwise(F.struct(
            hit["last"].alias("last"),
            F.concat(state["out"], F.array(F.struct(s["_slice"].alias("_slice"), hit["first"].alias("first")))).alias("out")))

    return F.aggregate(slices, empty, step)["out"]


def _reports(times: Column, first: Column, interval: int) -> Column:
    """The reports of a slice from its first one on."""
    start = F.struct(first.alias("last"), F.array(first).alias("out"))
    return F.aggregate(times, start, lambda state, t: F.when(
        t >= state["last"] + interval, F.struct(t.alias("last"), F.concat(state["out"], F.array(t)).alias("out"))).otherwise(state))["out"]


def report_times(df: DataFrame, interval_seconds: int, ts: str = "collected_at", keys: tuple[str, ...] = ("server",),
                 slice_intervals: int = SLICE_INTERVALS) -> DataFrame:
    """(``_key``, ``_us``): the reporting times of every server, in microseconds."""
    interval = interval_seconds * 1_000_000
    length = interval * slice_intervals
    times = (df.where(F.col(ts).isNotNull()).select(F.struct(*[F.col(k) for k in keys]).alias("_key"), F.unix_micros(F.col(ts)).alias("_us")).distinct()
             .withColumn("_slice", F.floor(F.col("_us") / F.lit(length))))
    key = next(f for f in times.schema.fields if f.name == "_key")
    schema = times.select("_key", "_slice").schema.add("first", "long").add("last", "long")
    assert key.name == schema.fields[0].name
    choices = times.groupBy("_key", "_slice").applyInArrow(_exits(interval, length), schema)
    slices = choices.groupBy("_key", "_slice").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("choices"))
    folded = slices.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_slice", "choices"))).alias("slices"))
    firsts = folded.select("_key", F.explode(_firsts(F.col("slices"), interval)).alias("s")).select("_key", "s.*")
    inside = times.groupBy("_key", "_slice").agg(F.sort_array(F.collect_list("_us")).alias("times"))
    return inside.join(firsts, ["_key", "_slice"]).select("_key", F.explode(_reports(F.col("times"), F.col("first"), interval)).alias("_us"))


def elapsed_gate(df: DataFrame, interval_seconds: int, ts: str = "collected_at", keys: tuple[str, ...] = ("server",),
                 slice_intervals: int = SLICE_INTERVALS) -> DataFrame:
    """Rows of the snapshots that report: a server's first, and each one at least the interval after the last that did.

    All rows of a reporting snapshot stay. Rows without a time are left out; rows without a server are one server.
    """
    keyed = df.withColumns({"_key": F.struct(*[F.col(k) for k in keys]), "_us": F.unix_micros(F.col(ts))})
    return keyed.join(report_times(df, interval_seconds, ts, keys, slice_intervals), ["_key", "_us"], "left_semi").select(*df.columns)
