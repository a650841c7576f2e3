"""Sinks: flat JSON records and the line format, with size-bounded splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.functions.maps import once
from gaugeloom.functions.text import escape
from gaugeloom.functions.values import plain_number


def _json_text(text: Column) -> Column:
    """A JSON string literal; the JSON writer is only called for texts that need escapes."""
    wrapped = F.to_json(F.struct(text.alias("v")))
    escaped = F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)
    return F.when(text.rlike(r'[\x00-\x1f"\\]'), escaped).otherwise(F.concat(F.lit('"'), text, F.lit('"')))


def _json_field(field: Column) -> Column:
    return (F.when(field["kind"] == "i", field["i"].cast("string"))
            .when(field["kind"] == "f", plain_number(field["f"]))
            .when(field["kind"] == "b", field["b"].cast("string"))
            .otherwise(_json_text(field["s"])))


def flat_record(name_key: str | None = None, time_key: str | None = None) -> Column:
    """JSON object of fields and tags with sorted keys; a tag hides a field of the same name.

    The measurement name and the time are only part of it under the given keys.
    """
    tags, fields = F.col("tags"), F.col("fields")
    shown = F.map_filter(fields, lambda k, _: ~F.map_contains_key(tags, k))
    parts = F.concat(
        F.transform(F.map_entries(shown), lambda e: F.struct(e["key"].alias("k"), _json_field(e["value"]).alias("v"))),
        F.transform(F.map_entries(tags), lambda e: F.struct(e["key"].alias("k"), _json_text(e["value"]).alias("v"))))
    extra = []
    if name_key:
        extra.append(F.struct(F.lit(name_key).alias("k"), _json_text(F.col("measurement")).alias("v")))
    if time_key:
        extra.append(F.struct(F.lit(time_key).alias("k"), F.col("time_ns").cast("string").alias("v")))
    if extra:
        parts = F.concat(parts, F.array(*extra))
    members = F.transform(F.sort_array(parts), lambda p: F.concat(_json_text(p["k"]), F.lit(":"), p["v"]))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def to_records(df: DataFrame, name_key: str | None = None, time_key: str | None = None) -> DataFrame:
    return df.select(flat_record(name_key, time_key).alias("record"))


def write_records(df: DataFrame, path: str, mode: str = "errorifexists", order_by: tuple[str, ...] = (), **keys) -> None:
    """One JSON object per line; ordering, where wanted, is done here and nowhere before."""
    to_records(df.orderBy(*order_by) if order_by else df, **keys).write.mode(mode).text(path)


def line_field(key: Column, field: Column) -> Column:
    value = (F.when(field["kind"] == "i", F.concat(field["i"].cast("string"), F.lit("i")))
             .when(field["kind"] == "f", plain_number(field["f"]))
             .when(field["kind"] == "b", field["b"].cast("string"))
             .otherwise(F.concat(F.lit('"'), escape(field["s"], "fieldval"), F.lit('"'))))
    return F.concat(escape(key, "fieldkey"), F.lit("="), value)


def _line_parts() -> tuple[Column, Column]:
    tags = F.transform(F.sort_array(F.map_entries("tags")), lambda e: F.concat(
        F.lit(","), escape(e["key"], "tagkey"), F.lit("="), escape(e["value"], "tagval")))
    head = F.concat(escape(F.col("measurement"), "name"), F.array_join(tags, ""))
    texts = F.transform(F.sort_array(F.map_entries("fields")), lambda e: line_field(e["key"], e["value"]))
    return head, texts


def line_text() -> Column:
    """``name,tags fields time``; tags and fields in key order so equal points give equal text."""
    head, texts = _line_parts()
    return F.concat(head, F.lit(" "), F.array_join(texts, ","), F.lit(" "), F.col("time_ns").cast("string"))


def to_lines(df: DataFrame) -> DataFrame:
    return df.select(line_text().alias("line"))


def trace_lines(df: DataFrame) -> DataFrame:
    """The lines as a trace prints them."""
    return df.select(F.concat(F.lit("> "), line_text()).alias("line"))


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    to_lines(df).write.mode(mode).text(path)


def split_points(df: DataFrame, max_size: int) -> DataFrame:
    """Split points whose line is longer than ``max_size`` bytes.

    Fields are packed in key order while the line stays under the limit; a field that does not fit on its
    own still gets its own point. Points within the limit are passed on unchanged.
    """
    head, texts = _line_parts()
    sized = once(df, _entries=F.sort_array(F.map_entries("fields")), _sizes=F.transform(texts, lambda t: F.octet_length(t)),
                 _fixed=F.octet_length(head) + F.length(F.col("time_ns").cast("string")) + 3)
    total = F.col("_fixed") + F.aggregate("_sizes", F.lit(0), lambda n, size: n + size + 1) - 1
    # Position of the first field of every part. Only these are gathered, so a point's cost follows its fields.
    zero = F.struct(F.lit(0).alias("used"), F.lit(0).alias("at"), F.array(F.lit(1)).alias("starts"))

    def pack(acc: Column, size: Column) -> Column:
        full = (acc["used"] > 0) & (size + acc["used"] + F.col("_fixed") >= max_size)
        used = F.when(full | (acc["used"] == 0), size).otherwise(acc["used"] + 1 + size)
        at = acc["at"] + 1
        return F.struct(used.alias("used"), at.alias("at"),
                        F.when(full, F.concat(acc["starts"], F.array(at))).otherwise(acc["starts"]).alias("starts"))

    staged = once(sized, _total=total)
    starts = F.when(F.col("_total") > max_size, F.aggregate("_sizes", zero, pack, lambda acc: acc["starts"]))
    cut = once(staged, _starts=starts)

    def part(start: Column, i: Column) -> Column:
        end = F.coalesce(F.try_element_at("_starts", i + 2), F.size("_entries") + 1)
        return F.map_from_entries(F.slice("_entries", start, end - start))

    parts = F.when(F.col("_total") <= max_size, F.array("fields")).otherwise(F.transform("_starts", part))
    rest = [c for c in df.columns if c != "fields"]
    return cut.select(*rest, F.explode(parts).alias("fields")).select(*df.columns)
