"""What every input's points go through, and the counts kept about it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from gaugeloom.functions.maps import once
from gaugeloom.functions.times import precision_for, round_ns
from gaugeloom.model import VALUE_TYPES
from gaugeloom.operators.filters import FilterSpec, apply_filter
from gaugeloom.operators.points import clean, default_tags, rename


@dataclass(frozen=True)
class InputConfig:
    name: str = ""
    name_override: str = ""
    name_prefix: str = ""
    name_suffix: str = ""
    tags: dict[str, str] = field(default_factory=dict)
    global_tags: dict[str, str] = field(default_factory=dict)
    filter: FilterSpec = field(default_factory=FilterSpec)
    precision_ns: int = 0
    interval_ns: int = 0


def round_time(df: DataFrame, precision_ns: int = 0, interval_ns: int = 0) -> DataFrame:
    """Round the point time; without a precision the interval's unit is used."""
    step = precision_for(precision_ns, interval_ns)
    if step == 1:
        return df
    rounded = round_ns(F.col("time_ns"), step)
    micros = F.call_function("div", rounded - F.pmod(rounded, F.lit(1000)), F.lit(1000))
    return df.withColumns({"time_ns": rounded, "ts": F.timestamp_micros(micros)})


def default_time(df: DataFrame, fallback: str = "collected_at") -> DataFrame:
    """Points without a time get the collection time."""
    ts = F.coalesce("ts", fallback)
    return df.withColumns({"ts": ts, "time_ns": F.coalesce("time_ns", F.unix_micros(ts) * 1000)})


def with_type(df: DataFrame, mtype: str) -> DataFrame:
    """Mark points as counter, gauge, untyped, summary or histogram."""
    if mtype not in VALUE_TYPES:
        raise ValueError(f"unknown value type {mtype!r}")
    return df.withColumn("mtype", F.lit(mtype))


def normalise(df: DataFrame, cfg: InputConfig = InputConfig()) -> DataFrame:
    """Name, default tags, filter, clean and time, in this order. Works on static and streaming points."""
    out = df.filter(F.col("measurement") != "")
    out = rename(out, cfg.name_override, cfg.name_prefix, cfg.name_suffix)
    out = default_tags(out, {**cfg.global_tags, **cfg.tags})
    if cfg.filter != FilterSpec():
        # The filter tests the merged tags and the chosen fields more than once.
        out = once(out, tags=F.col("tags"))
        out = apply_filter(out, cfg.filter)
        out = once(out, fields=F.col("fields"))
    out = clean(out)
    return round_time(out, cfg.precision_ns, cfg.interval_ns)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count gathered points while another action runs; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("metrics_gathered")), seen


def counted(seen: Observation, name: str) -> int:
    """A number that an action has observed; 0 where the plan had no rows to count."""
    return int(seen.get.get(name) or 0)
