"""Point lines (``name,tags fields time``) back to points."""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeloom.functions.maps import once
from gaugeloom.model import FIELD_DDL, INT64_MAX, Result, error_rows
from gaugeloom.session import ship_with_tasks

ship_with_tasks(__name__)

# A separator counts when no backslash stands before it; inside quotes a backslash can itself be escaped.
_SPACE = re.compile(r"(?<!\\) ")
_COMMA = re.compile(r"(?<!\\),")
_EQUALS = re.compile(r"(?<!\\)=")
_QUOTED = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"', re.S)
_BARE = re.compile(r"[^, ]*(?:(?<=\\)[, ][^, ]*)*")
_ESCAPED_KEY = re.compile(r'\\([," =])')
_ESCAPED_NAME = re.compile(r"\\([, ])")
_ESCAPED_TEXT = re.compile(r'\\(["\\])')

#: How numbers are written.
_WHOLE = re.compile(r"[+-]?[0-9]+", re.A)
_NUMBER = re.compile(r"-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?", re.A)

_ROW = f"struct<error:string,measurement:string,tags:map<string,string>,fields:map<string,{FIELD_DDL}>,time_ns:bigint>"
_ARROW = pa.struct([
    ("error", pa.string()), ("measurement", pa.string()), ("tags", pa.map_(pa.string(), pa.string())),
    ("fields", pa.map_(pa.string(), pa.struct([
        ("kind", pa.string()), ("i", pa.int64()), ("f", pa.float64()), ("s", pa.string()), ("b", pa.bool_())]))),
    ("time_ns", pa.int64())])


def _value(text):
    """Typed value of one field text, or None when it has no known form."""
    first = text[:1]
    if first == '"':
        return {"kind": "s", "s": _ESCAPED_TEXT.sub(r"\1", text[1:-1])}
    if first in ("t", "T", "f", "F"):
        return {"kind": "b", "b": first in "tT"}
    if text.endswith("i"):
        number = _int64(text[:-1])
        return None if number is None else {"kind": "i", "i": number}
    number = float(text) if _NUMBER.fullmatch(text) and first != "." else math.inf
    return {"kind": "f", "f": number} if math.isfinite(number) else None


def _int64(text):
    """A whole number that 64 bits hold, or None. Its length is looked at before its value."""
    if not _WHOLE.fullmatch(text) or len(text.lstrip("+-0")) > 19:
        return None
    number = int(text)
    return number if -INT64_MAX - 1 <= number <= INT64_MAX else None


def _fail(message):
    return {"error": message}


def _point(line):
    gap = _SPACE.search(line)
    if gap is None:
        return _fail("no fields")
    head, at = line[:gap.start()], gap.end()
    name, *pairs = _COMMA.split(head)
    if not name:
        return _fail("missing measurement name")
    tags = {}
    for pair in pairs:
        parts = _EQUALS.split(pair, maxsplit=1)
        if len(parts) != 2:
            return _fail(f"tag without a value: {pair}")
        tags[_ESCAPED_KEY.sub(r"\1", parts[0])] = _ESCAPED_KEY.sub(r"\1", parts[1])
    fields = {}
    while True:
        sign = _EQUALS.search(line, at)
        if sign is None:
            return _fail("field without a value")
        key, start = line[at:sign.start()], sign.end()
        found = (_QUOTED if line[start:start + 1] == '"' else _BARE).match(line, start)
        if found is None:
            return _fail("unfinished text value")
        value = _value(found.group())
        if value is not None:
            fields[_ESCAPED_KEY.sub(r"\1", key)] = value
        at = found.end()
        if line[at:at + 1] != ",":
            break
        at += 1
    if not fields:
        return _fail("must have one or more fields")
    rest = line[at:].strip()
    time_ns = _int64(rest) if rest else None
    if rest and time_ns is None:
        return _fail(f"bad time: {rest}")
    return {"measurement": _ESCAPED_NAME.sub(r"\1", name), "tags": list(tags.items()),
            "fields": list(fields.items()), "time_ns": time_ns}


def parse_line(col: Column) -> Column:
    @F.arrow_udf(_ROW)
    def parse(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _point(t) for t in texts.to_pylist()], _ARROW)

    return parse(col)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def from_lines(df: DataFrame, line: str = "line", source: str = "line") -> Result:
    """Points of a text column; blank lines are skipped, bad lines become error rows."""
    rows = once(df.filter(F.trim(line) != "").select(F.col(line).alias("_line")), _p=parse_line(F.col("_line")))
    micros = F.call_function("div", F.col("_p.time_ns") - F.pmod(F.col("_p.time_ns"), F.lit(1000)), F.lit(1000))
    metrics = rows.filter(F.col("_p.error").isNull()).select(
        "_p.measurement", "_p.tags", "_p.fields", F.timestamp_micros(micros).alias("ts"), "_p.time_ns",
        F.lit("untyped").alias("mtype"), F.lit(False).alias("is_aggregate"), F.lit(source).alias("source"))
    errors = error_rows(rows.filter(F.col("_p.error").isNotNull()), source,
                        F.concat(F.col("_p.error"), F.lit(": "), F.col("_line")))
    return Result(metrics, errors)
