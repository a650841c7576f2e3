"""Build and edit points. All of these are narrow: no shuffle, no Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gaugeloom.functions.maps import once
from gaugeloom.functions.times import nanos
from gaugeloom.functions.values import field_of, finite
from gaugeloom.model import FIELD_DDL, VALUE_TYPES, error_rows

_BACKSLASH = "\\"


def _ends_badly(col: Column) -> Column:
    return col.endswith(_BACKSLASH)


def _valid_field(key: Column, value: Column) -> Column:
    number_ok = (value["kind"] != "f") | finite(value["f"]).isNotNull()
    return value.isNotNull() & value["kind"].isNotNull() & number_ok & ~_ends_badly(key)


#: Maps of at most this many entries get the two-way form of ``_compact``.
_SMALL = 8


def _compact(entries: dict[str, tuple[Column, Column | None]], ddl: str) -> Column:
    """Map of the entries whose condition holds; an entry without a condition is always there.

    Rows that have every entry, which is most of them, build the map in generated code; only the others pay
    for filtering it.
    """
    if not entries:
        return F.expr("map()").cast(ddl)
    whole = F.create_map(*[x for k, (value, _) in entries.items() for x in (F.lit(k), value)])
    tests = [F.coalesce(ok, F.lit(False)) for _, ok in entries.values() if ok is not None]
    if not tests:
        return whole
    kept = {k: value if ok is None else F.when(ok, value) for k, (value, ok) in entries.items()}
    partial = F.map_filter(F.create_map(*[x for k, v in kept.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    if len(entries) > _SMALL:
        return partial
    return F.when(reduce(lambda a, b: a & b, tests), whole).otherwise(partial)


def make_point(
    df: DataFrame, measurement: str | Column, tags: dict[str, Column], fields: dict[str, Column],
    ts: Column, *, mtype: str = "untyped", source: str = "", keep: tuple[str, ...] = (),
) -> DataFrame:
    """One point per row. Absent, NaN and infinite fields are left out; a row without any field gives none."""
    if mtype not in VALUE_TYPES:
        raise ValueError(f"unknown value type {mtype!r}")
    name = F.lit(measurement) if isinstance(measurement, str) else measurement
    types = df.select(*[c.alias(f"c{i}") for i, c in enumerate(fields.values())]).schema
    typed = {k: field_of(c, t.dataType) for (k, c), t in zip(fields.items(), types)}
    sure = {k for k, t in zip(fields, types)
            if not t.nullable and isinstance(t.dataType, (T.IntegralType, T.BooleanType, T.StringType))}
    texts = {k: c.cast("string") for k, c in tags.items()}
    tag_map = _compact({k: (c, (c != "") & ~_ends_badly(c)) for k, c in texts.items()}, "map<string,string>")
    field_map = _compact({k: (c, None if k in sure else c.isNotNull()) for k, c in typed.items()}, f"map<string,{FIELD_DDL}>")
    # The row test reads the input columns, not the maps, so it reaches the scan and no map is built twice.
    any_field = F.lit(bool(sure))
    for k, c in typed.items():
        if not sure:
            any_field = any_field | c.isNotNull()
    return df.filter(any_field & (name != "") & ~_ends_badly(name)).select(
        name.alias("measurement"), tag_map.alias("tags"), field_map.alias("fields"),
        ts.alias("ts"), nanos(ts).alias("time_ns"), F.lit(mtype).alias("mtype"),
        F.lit(False).alias("is_aggregate"), F.lit(source).alias("source"), *keep)


def map_point(
    df: DataFrame, measurement: str | Column, tags: Column, fields: Column, ts: Column, *,
    mtype: str = "untyped", source: str = "",
) -> DataFrame:
    """Points from rows that already carry a tag map and a field map."""
    name = F.lit(measurement) if isinstance(measurement, str) else measurement
    parts = df.select(name.alias("measurement"), ts.alias("ts"), tags.cast("map<string,string>").alias("tags"),
                      fields.cast(f"map<string,{FIELD_DDL}>").alias("_fields"))
    staged = once(parts, fields=F.col("_fields")).select(
        "measurement", "tags", "fields", "ts", nanos(F.col("ts")).alias("time_ns"), F.lit(mtype).alias("mtype"), F.lit(False).alias("is_aggregate"), F.lit(source).alias("source"))
    return clean(staged)


def rename(df: DataFrame, override: str = "", prefix: str = "", suffix: str = "") -> DataFrame:
    """Replace the measurement name, then add a prefix and a suffix."""
    name = F.lit(override) if override else F.col("measurement")
    return df.withColumn("measurement", F.concat(F.lit(prefix), name, F.lit(suffix)))


def merge_under(tags: Column, defaults: Column) -> Column:
    """Add the defaults whose key the tags do not have."""
    missing = F.map_filter(defaults, lambda k, _: ~F.map_contains_key(tags, k))
    return F.map_concat(missing, tags)


def default_tags(df: DataFrame, defaults: dict[str, str | Column]) -> DataFrame:
    if not defaults:
        return df
    pairs = [x for k, v in defaults.items() for x in (F.lit(k), F.lit(v) if isinstance(v, str) else v)]
    return df.withColumn("tags", merge_under(F.col("tags"), F.create_map(*pairs)))


def clean_tags(df: DataFrame) -> DataFrame:
    """Drop tags that are empty or whose key or value ends in a backslash."""
    return df.withColumn("tags", F.map_filter(
        F.coalesce(F.col("tags"), F.expr("map()").cast("map<string,string>")),
        lambda k, v: v.isNotNull() & (k != "") & (v != "") & ~_ends_badly(k) & ~_ends_badly(v)))


def clean_fields(df: DataFrame) -> DataFrame:
    """Drop fields that are null, NaN or infinite or whose key ends in a backslash, then points without fields."""
    some = F.exists(F.map_entries("fields"), lambda e: _valid_field(e["key"], e["value"]))
    return df.filter(some).withColumn("fields", F.map_filter("fields", _valid_field))


def clean(df: DataFrame) -> DataFrame:
    name = F.col("measurement")
    return clean_tags(clean_fields(df.filter((name != "") & ~_ends_badly(name))))


def with_tag(df: DataFrame, key: str, value: str | Column) -> DataFrame:
    """Set a tag, replacing an old value."""
    val = F.lit(value) if isinstance(value, str) else value
    kept = F.map_filter("tags", lambda k, _: k != key)
    return df.withColumn("tags", F.map_concat(kept, F.create_map(F.lit(key), val)))


def without_tag(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("tags", F.map_filter("tags", lambda k, _: k != key))


def has_tag(key: str) -> Column:
    return F.map_contains_key("tags", F.lit(key))


def with_field(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Set a field; the value's own type decides its kind."""
    dtype = df.select(value.alias("v")).schema[0].dataType
    kept = F.map_filter("fields", lambda k, _: k != key)
    return df.withColumn("fields", F.map_concat(kept, F.create_map(F.lit(key), field_of(value, dtype))))


def without_field(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Remove a field. Points whose only field it was come back as error rows."""
    only = has_field(key) & (F.size("fields") == 1)
    errors = error_rows(df.filter(only), "point", F.concat(
        F.lit(f"cannot remove final field {key} of "), F.col("measurement")), ts=F.col("ts"))
    kept = df.filter(~only).withColumn("fields", F.map_filter("fields", lambda k, _: k != key))
    return kept, errors


def has_field(key: str) -> Column:
    return F.map_contains_key("fields", F.lit(key))


def as_aggregate(df: DataFrame, flag: bool = True) -> DataFrame:
    return df.withColumn("is_aggregate", F.lit(flag))
