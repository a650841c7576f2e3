"""Elapsed-time gate against a plain fold."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators.gates import elapsed_gate
from helpers import T0

SNAPS = "id bigint, server string, collected_at timestamp"


def plain(rows, interval):
    kept, last = set(), {}
    for _, server, at in sorted((r for r in rows if r[2]), key=lambda r: r[2]):
        if last.get(server) == at or server not in last or at - last[server] >= timedelta(seconds=interval):
            last[server] = at
            kept.add((server, at))
    return sorted(i for i, s, at in rows if (s, at) in kept)


@pytest.mark.parametrize("slice_intervals", [1, 2, 1024])
@pytest.mark.parametrize("interval,gap", [(1, 0.4), (7, 1), (10, 4000)])
def test_gate_equals_a_fold(spark, slice_intervals, interval, gap):
    rng, rows, at = random.Random(slice_intervals * interval), [], dict.fromkeys(["a", "b", None], T0 - timedelta(days=20000))
    for i in range(600):
        s = rng.choice(["a", "a", "b", None])
        at[s] += timedelta(microseconds=rng.randrange(int(gap * 1e6)) * rng.choice([0, 1, 1]))
        rows.append((i, s, at[s]))
    rows.append((1000, "a", None))
    df = spark.createDataFrame(rows, SNAPS)
    assert sorted(r.id for r in elapsed_gate(df, interval, slice_intervals=slice_intervals).collect()) == plain(rows, interval)


def test_gate_of_nothing(spark):
    assert elapsed_gate(spark.createDataFrame([], SNAPS), 5).collect() == []


def test_one_server_is_gated_by_many_tasks(spark):
    """Only one step a slice is left for a busy server."""
    df = spark.range(200_000, numPartitions=4).select("id", F.lit("s").alias("server"), F.timestamp_micros(F.col("id") * 500_000 + 17).alias("collected_at"))
    out = elapsed_gate(df, 60, slice_intervals=16)
    assert [r.id for r in out.orderBy("id").limit(3).collect()] == [0, 120, 240] and out.count() == -(-200_000 // 120)
