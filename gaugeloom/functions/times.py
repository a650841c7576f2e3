"""Time functions. Nothing here reads the clock: the reference time is always a column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Durations in nanoseconds.
UNITS = {"ns": 1, "us": 1_000, "ms": 1_000_000, "s": 1_000_000_000, "m": 60_000_000_000, "h": 3_600_000_000_000}

#: Seconds from the first of January of year 1 to 1970; rounding counts from there.
YEAR_ONE_SECONDS = 62_135_596_800


def precision_for(precision_ns: int = 0, interval_ns: int = 0) -> int:
    """An explicit precision wins; otherwise the unit of the interval, one second at most."""
    if precision_ns > 0:
        return precision_ns
    for unit in ("s", "ms", "us"):
        if interval_ns >= UNITS[unit]:
            return UNITS[unit]
    return 1


def round_ns(time_ns: Column, precision_ns: int) -> Column:
    """Round to the nearest multiple of the precision, halves up, counted from year 1; any precision is exact."""
    if precision_ns <= 1:
        return time_ns
    shift = (YEAR_ONE_SECONDS * UNITS["s"]) % precision_ns
    over = F.pmod(F.pmod(time_ns, F.lit(precision_ns)) + F.lit(shift), F.lit(precision_ns))
    return F.when(over + over < precision_ns, time_ns - over).otherwise(time_ns + (F.lit(precision_ns) - over))


def nanos(ts: Column) -> Column:
    """Epoch nanoseconds; NULL for a time 64 bits cannot hold."""
    return F.try_multiply(F.unix_micros(ts), F.lit(1000))


def wall_clock(collected_at: Column, uptime_seconds: Column, timer_ps: Column) -> Column:
    """Server start plus a picosecond timer: ``collected_at - (uptime - timer * 1e-12)`` seconds."""
    ago = uptime_seconds.try_cast("decimal(20,6)") - timer_ps.cast("decimal(20,0)") / F.lit(10**12).cast("decimal(20,0)")
    ago_us = F.round(ago * F.lit(1_000_000), 0).try_cast("bigint")
    return F.timestamp_micros(F.try_subtract(F.unix_micros(collected_at), ago_us))


def seconds(picoseconds: Column) -> Column:
    return picoseconds / F.lit(1e12)


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds cut to whole seconds."""
    return F.unix_seconds(ts) * F.lit(1000)


def newer_than(ts: Column, reference: Column, window_seconds: int) -> Column:
    return ts > reference - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(window_seconds))


def utc(ts: Column) -> Column:
    """Read a zone-less timestamp as UTC, whatever the session zone is; a plain cast would use that zone."""
    minutes = F.hour(ts) * 60 + F.minute(ts)
    second_us = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    day_us = F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000
    return F.timestamp_micros(day_us + minutes.cast("bigint") * 60_000_000 + second_us)
