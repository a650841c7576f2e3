"""Stateful streams: duplicate suppression, the elapsed-time gate, counters and carried timing means."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gaugeloom.model import series_key
from gaugeloom.session import ship_with_tasks

ship_with_tasks(__name__)


def dedup(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated events; keys are remembered for ``delay`` of event time."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def _filled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames with rows: a timeout hands over an empty one."""
    return (f for f in frames if len(f))


def _gate(interval: int):
    """State function: a server's last report, and the snapshots (microseconds, as 64-bit integers) that wait for the watermark."""
    def work(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, b"")
        times = np.unique(np.concatenate([np.frombuffer(held, np.int64), *(f["us"].to_numpy(np.int64) for f in _filled(frames))]))
        passed = state.getCurrentWatermarkMs()
        done = np.searchsorted(times, passed * 1000, "right")
        due, waiting = times[:done], times[done:]
        at, out = 0 if last is None else np.searchsorted(due, last + interval), []
        while at < len(due):
            last = int(due[at])
            out.append(last)
            at = max(at + 1, np.searchsorted(due, last + interval))
        state.update((last, waiting.tobytes()))
        if len(waiting):
            # A timeout ends once the watermark is beyond it; a snapshot at the watermark is due.
            state.setTimeoutTimestamp(max(-(-int(waiting[0]) // 1000) - 1, passed, 1))
        if out:
            # As an object: rows of groups without output are filled up with nulls, which would turn whole numbers into floats.
            yield pd.DataFrame({"server": pd.Series([key[0]] * len(out), dtype=object), "first_ts": pd.to_datetime(np.array(out, np.int64), unit="us", utc=True)})

    return work


def slow_interval(df: DataFrame, interval_seconds: int, ts: str, delay: str, server: str = "server") -> DataFrame:
    """(server, first_ts): snapshots at least the interval after the server's last report, as a stream to join or filter by.

    A snapshot waits for the watermark, so that those arriving out of order are judged in order of time; one that is later
    than ``delay`` is left out, as is one without a server or a time. The last report is kept in the checkpoint.
    """
    key = next(f for f in df.schema.fields if f.name == server)
    timed = df.withWatermark(ts, delay).where(F.col(server).isNotNull() & F.col(ts).isNotNull())
    rows = timed.select(F.col(server).alias("server"), ts, F.unix_micros(F.col(ts)).alias("us"))
    return rows.groupBy("server").applyInPandasWithState(
        _gate(interval_seconds * 1_000_000), f"server {key.dataType.simpleString()}, first_ts timestamp", "last bigint, waiting binary",
        "append", GroupStateTimeout.EventTimeTimeout)


def sums(df: DataFrame) -> DataFrame:
    """Running sum per series and field; partial sums are taken before the shuffle."""
    return (df.groupBy(series_key(F.col("measurement"), F.col("tags")).alias("series"), "field")
            .agg(F.sum("v").alias("value")))


def _placed(frame: pd.DataFrame, places: dict[tuple[str, str], int]) -> np.ndarray:
    """The place of each event's counter; new counters get the next ones."""
    series, field = (frame[c].to_numpy(object) for c in ("series", "field"))
    s, f = (pd.factorize(c, use_na_sentinel=False)[0] for c in (series, field))
    name = pd.factorize(s * len(frame) + f)[0]
    first = np.unique(name, return_index=True)[1]
    return np.array([places.setdefault(x, len(places)) for x in zip(series[first], field[first])], np.int64)[name]


def _count(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Last sets of a group's counters with the increments after them.

    State has the counters in order of their places. ``total`` is the set value and the increments that no set can undo any more:
    those the watermark has passed. Younger increments are held one by one (place, ``seq``, microseconds and value, as 64-bit
    integers), since a set that is still on its way may lie after some and before others.
    """
    series, field, set_seq, total, held = state.get if state.exists else ([], [], [], [], b"")
    places = dict(zip(zip(series, field), range(len(series))))
    new = np.concatenate([np.empty((0, 5), np.int64), *(
        np.column_stack([_placed(f, places), *(f[c].to_numpy(np.int64) for c in ("seq", "us", "v", "is_set"))]) for f in _filled(frames))])
    place, seq, _, v, is_set = new.T
    more = len(places) - len(set_seq)
    was_set = np.array([s is not None for s in set_seq] + [False] * more, bool)
    set_seq = np.array([s or 0 for s in set_seq] + [0] * more, np.int64)
    total = np.array([int(t) for t in total] + [0] * more, object)

    top = np.flatnonzero(is_set)
    top = top[np.lexsort((-top, seq[top], place[top]))]
    top = top[np.diff(place[top], append=-1) != 0]
    top = top[~was_set[place[top]] | (seq[top] > set_seq[place[top]])]
    was_set[place[top]], set_seq[place[top]], total[place[top]] = True, seq[top], v[top].astype(object)

    recent = np.concatenate([np.frombuffer(held, np.int64).reshape(-1, 4), new[is_set == 0, :4]])
    recent = recent[~was_set[recent[:, 0]] | (recent[:, 1] > set_seq[recent[:, 0]])]
    done = recent[:, 2] <= state.getCurrentWatermarkMs() * 1000
    np.add.at(total, recent[done, 0], recent[done, 3].astype(object))
    recent = recent[~done]
    series, field = (np.array(c, object) for c in zip(*places))
    state.update((
        series.tolist(), field.tolist(), [s if was else None for s, was in zip(set_seq.tolist(), was_set)], [str(t) for t in total], recent.tobytes()))

    value = total.copy()
    np.add.at(value, recent[:, 0], recent[:, 3].astype(object))
    seen = np.unique(place)
    fit = [x if -(2**63) <= x < 2**63 else None for x in value[seen]]
    yield pd.DataFrame({"series": series[seen], "field": field[seen], "value": fit}, dtype=object)


def counters(df: DataFrame, ts: str, delay: str, groups: int = 4096) -> DataFrame:
    """Current value per series and field: the last set by ``seq``, plus the increments after it, in whatever order they arrive.

    ``df`` has ``measurement, tags, field, seq, op (incr or set), v``; later events have later ``ts``. An event later than
    ``delay`` is left out; an increment without ``ts`` is held until a set lies after it. Every change gives the counter's new
    value (update mode); one beyond 64 bits is NULL.

    Counters are dealt into ``groups`` by their names, and the state function is called once a group and micro-batch, however many
    counters there are. A group that gets an event writes its whole state, so small batches over very many counters want more
    groups. A checkpoint stays with the number it began with.
    """
    never = F.lit(2**63 - 1)
    names = df.withWatermark(ts, delay).where("op IN ('set', 'incr') AND seq IS NOT NULL AND v IS NOT NULL").withColumn(
        "series", series_key(F.col("measurement"), F.col("tags")))
    rows = names.select(
        F.pmod(F.xxhash64("series", "field"), F.lit(groups)).alias("_group"), "series", "field", ts,
        F.coalesce(F.unix_micros(F.col(ts)), never).alias("us"), F.col("seq").cast("bigint"),
        (F.col("op") == "set").alias("is_set"), F.col("v").cast("bigint"))
    return rows.groupBy("_group").applyInPandasWithState(
        _count, "series string, field string, value bigint",
        "series array<string>, field array<string>, set_seq array<bigint>, total array<string>, recent binary",
        "update", GroupStateTimeout.EventTimeTimeout)


def interval_sums(df: DataFrame, interval: str, ts: str, delay: str, key: Column) -> DataFrame:
    """Sum and count per key and interval, appended once the interval is over.

    This is the first of two streams: it ends in a landing folder that ``carried_means`` reads, so the state
    function gets one row per interval however many events there were.
    """
    return (df.withWatermark(ts, delay).groupBy(F.window(ts, interval).alias("_w"), key.alias("series"))
            .agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
            .select("series", F.col("_w.start").alias("slot"), "total", "n"))


_OUT = "series string, slot timestamp, n bigint, value bigint"
_STATE = "value bigint"


def _mean(total: int, n: int) -> int:
    return -(-total // n) if total < 0 else total // n


def _carry(key, frames: Iterator[pd.DataFrame], state: GroupState):
    value = state.get[0] if state.exists else 0
    rows = pd.concat(list(frames)).sort_values("slot")
    values = []
    for total, n in zip(rows["total"], rows["n"]):
        if n:
            value = _mean(int(total), int(n))
        values.append(value)
    state.update((value,))
    yield pd.DataFrame({"series": key[0], "slot": rows["slot"].values, "n": rows["n"].values, "value": values})


def carried_means(reads: DataFrame) -> DataFrame:
    """Truncated mean per series and interval, repeating the last one where nothing was timed.

    ``reads`` has one row per series and interval (``series, slot, total, n``), already summed, so the state
    function sees intervals, never events. Rows with ``n = 0`` are reads without a sample.
    """
    return reads.groupBy("series").applyInPandasWithState(
        _carry, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
