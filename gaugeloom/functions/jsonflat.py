"""Flatten nested JSON into point fields.

Depth and member names are only known at run time, so these are Arrow functions: Spark hands a column
batch to Python and gets a map column back. They see one document at a time and keep no state.
"""

from __future__ import annotations

import json
import re
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, functions as F

from gaugeloom.model import FIELD, FIELD_DDL
from gaugeloom.session import ship_with_tasks

ship_with_tasks(__name__)

_FIELDS = f"map<string,{FIELD_DDL}>"
_POINTS = "struct<error:string,points:array<struct<error:string,tags:map<string,string>,fields:map<string,double>>>>"


def _reject(name):
    raise ValueError(f"invalid number {name}")


def _finite(text):
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise ValueError(f"number out of range: {text}")
    return value


def load(text):
    """Decode one document of any depth. Numbers are doubles, the last of equal member names wins."""
    try:
        return json.loads(text, parse_constant=_reject, parse_float=_finite, parse_int=_finite)
    except RecursionError:
        return load_deep(text)


_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?")
_WORDS = {"null": None, "true": True, "false": False}


def load_deep(text):
    """``load`` without recursion: open objects and lists wait on a stack of their own."""
    waiting, names = [], []  # containers that are open, and the name under which each object's next value goes
    place = lambda i: _SPACE.match(text, i).end()

    def fail(at):
        raise ValueError(f"unexpected text at character {at}")

    def member(at):
        if text[at : at + 1] != '"':
            fail(at)
        name, at = json.decoder.scanstring(text, at + 1, True)
        at = place(at)
        if text[at : at + 1] != ":":
            fail(at)
        return name, place(at + 1)

    at = place(0)
    while True:
        sign, opened = text[at : at + 1], None
        if sign == "{" or sign == "[":
            value = opened = {} if sign == "{" else []
            at = place(at + 1)
        elif sign == '"':
            value, at = json.decoder.scanstring(text, at + 1, True)
        elif number := _NUMBER.match(text, at):
            value, at = _finite(number.group()), number.end()
        else:
            word = next((w for w in _WORDS if text.startswith(w, at)), None) or fail(at)
            value, at = _WORDS[word], at + len(word)
        if not waiting:
            whole_value = value
        elif isinstance(waiting[-1], dict):
            waiting[-1][names[-1]] = value
        else:
            waiting[-1].append(value)
        if opened is not None:
            waiting.append(opened)
            names.append(None)
            if text[at : at + 1] != ("}" if isinstance(opened, dict) else "]"):
                if isinstance(opened, dict):
                    names[-1], at = member(at)
                continue
        # A value has ended: close what closes, until another one begins.
        while waiting:
            at = place(at)
            sign, inside = text[at : at + 1], isinstance(waiting[-1], dict)
            if sign == ("}" if inside else "]"):
                waiting.pop(), names.pop()
                at += 1
            elif sign == ",":
                at = place(at + 1)
                if inside:
                    names[-1], at = member(at)
                break
            else:
                fail(at)
        if not waiting:
            return whole_value if place(at) == len(text) else fail(place(at))


_LONE = re.compile("[\ud800-\udfff]")


def whole(text):
    """The text with U+FFFD for every half of a surrogate pair, which no column can hold."""
    return _LONE.sub("\ufffd", text)


def leaves(value):
    """(path, scalar) pairs in document order; path parts are joined by ``_``, array positions included.

    Open members wait on a list of their own, so no depth is too much. The beginning of a long path is shared, not copied.
    """
    waiting = [(None, "", value)]
    while waiting:
        above, name, value = waiting.pop()
        if len(name) > 1000 and isinstance(value, (dict, list)):
            above, name = (above, name), ""
        if isinstance(value, dict):
            waiting += [(above, f"{name}_{whole(key)}".rstrip("_"), child) for key, child in reversed(value.items())]
        elif isinstance(value, list):
            waiting += [(above, f"{name}_{at}", value[at]) for at in range(len(value) - 1, -1, -1)]
        elif value is not None:
            parts = [name]
            while above:
                above, part = above
                parts.append(part)
            yield "".join(reversed(parts)).lstrip("_"), whole(value) if isinstance(value, str) else value


def number_text(value):
    text = format(Decimal(repr(value)), "f")
    return text.rstrip("0").rstrip(".") if "." in text else text


def _field_map(texts, strings, bools, tell):
    offsets, keys, refused = [0], [], []
    kinds, nums, strs, flags = [], [], [], []
    for text in texts:
        refused.append(False)
        if text is not None:
            try:
                found = dict(leaves(load(text)))
            except ValueError:
                found, refused[-1] = {}, tell
            for key, value in found.items():
                flag = isinstance(value, bool)
                if flag and not bools or isinstance(value, str) and not strings:
                    continue
                keys.append(key)
                kinds.append("b" if flag else "s" if isinstance(value, str) else "f")
                nums.append(value if kinds[-1] == "f" else None)
                strs.append(value if kinds[-1] == "s" else None)
                flags.append(value if flag else None)
        offsets.append(len(keys))
    items = pa.StructArray.from_arrays(
        [pa.array(kinds, pa.string()), pa.nulls(len(keys), pa.int64()), pa.array(nums, pa.float64()),
         pa.array(strs, pa.string()), pa.array(flags, pa.bool_())],
        names=FIELD.fieldNames())
    # A place without an offset is NULL.
    starts = pa.array([None if no else at for at, no in zip(offsets, [*refused, False])], pa.int32())
    return pa.MapArray.from_arrays(starts, pa.array(keys, pa.string()), items)


def flatten_json(col: Column, strings: bool = False, bools: bool = False, tell: bool = False) -> Column:
    """Fields of a JSON document: numbers always, texts and flags on request.

    Invalid text gives no field; with ``tell`` it gives NULL, and only a document without fields gives an empty map.
    """

    @F.arrow_udf(_FIELDS)
    def flatten(texts: pa.Array) -> pa.Array:
        return _field_map(texts.to_pylist(), strings, bools, tell)

    return flatten(col)


def _point(doc, tag_keys):
    tags = {}
    for key in tag_keys:
        value = doc.pop(key, None)
        if isinstance(value, bool):
            tags[key] = "true" if value else "false"
        elif isinstance(value, float):
            tags[key] = number_text(value)
        elif isinstance(value, str):
            tags[key] = whole(value)
    fields = {k: v for k, v in leaves(doc) if isinstance(v, float)}
    return {"error": None if fields else "no numeric member", "tags": list(tags.items()), "fields": list(fields.items())}


def _document(text, tag_keys):
    if text is None or not text.strip():
        return {"error": None, "points": []}
    try:
        docs = load(text)
    except ValueError as err:
        return {"error": f"unable to parse out as JSON, {err}", "points": []}
    if isinstance(docs, dict):
        docs = [docs]
    if not isinstance(docs, list) or not all(d is None or isinstance(d, dict) for d in docs):
        return {"error": "not a JSON object or an array of objects", "points": []}
    return {"error": None, "points": [_point(d or {}, tag_keys) for d in docs]}


def document_points(col: Column, tag_keys: list[str]) -> Column:
    """Points of one document (object or array of objects) with selected members as tags, or its error."""
    keys = list(tag_keys)
    arrow_type = pa.struct([
        ("error", pa.string()),
        ("points", pa.list_(pa.struct([
            ("error", pa.string()),
            ("tags", pa.map_(pa.string(), pa.string())),
            ("fields", pa.map_(pa.string(), pa.float64())),
        ]))),
    ])

    @F.arrow_udf(_POINTS)
    def parse(texts: pa.Array) -> pa.Array:
        return pa.array([_document(t, keys) for t in texts.to_pylist()], arrow_type)

    return parse(col)


def flatten_variant(doc: Column, depth: int) -> Column:
    """Numeric leaves of a document down to ``depth`` levels, without Python.

    Returns ``struct<fields map<string,double>, complete boolean>``; ``complete`` is false when a deeper
    level exists, so a caller can send just those rows to ``flatten_json``.
    """
    entry = "array<struct<k:string,v:variant>>"

    # The type is looked at before the cast, because a cast that fails is slow: it raises inside.
    def children(e: Column) -> Column:
        kind = F.schema_of_variant(e["v"])
        members = F.transform(
            F.map_entries(e["v"].try_cast("map<string,variant>")),
            lambda m: F.struct(F.concat(e["k"], F.lit("_"), m["key"], F.lit("_")).alias("k"), m["value"].alias("v")))
        items = F.transform(
            e["v"].try_cast("array<variant>"),
            lambda x, i: F.struct(F.concat(e["k"], F.lit("_"), i.cast("string"), F.lit("_")).alias("k"), x.alias("v")))
        same = F.array(F.struct(e["k"].alias("k"), e["v"].alias("v")))
        return F.when(kind.startswith("OBJECT"), members).when(kind.startswith("ARRAY"), items).otherwise(same)

    level = F.array(F.struct(F.lit("").alias("k"), F.try_parse_json(doc).alias("v"))).cast(entry)
    for _ in range(depth):
        level = F.flatten(F.transform(level, children))
        level = F.transform(level, lambda e: F.struct(
            F.regexp_replace(e["k"], r"\A_+|_+\z", "").alias("k"), e["v"].alias("v")))
    nested = F.exists(level, lambda e: F.coalesce(F.schema_of_variant(e["v"]).rlike("^(OBJECT|ARRAY)"), F.lit(False)))
    numeric = F.filter(level, lambda e: F.schema_of_variant(e["v"]).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
    fields = F.transform(numeric, lambda e: F.struct(e["k"].alias("k"), e["v"].cast("double").alias("v")))
    return F.struct(F.map_from_entries(fields).alias("fields"), (~nested).alias("complete"))
