"""Pattern lists and the point filter built from them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

_META = re.compile(r"[*?\[]")
_PLAIN = re.compile(r"[^*?\[\]{},\\]*")


def _regex(pattern: str) -> str:
    """Regex for one glob: ``*``, ``?``, ``[a-z]``, ``[!x]``, ``{a,b}`` and backslash escapes."""
    out, depth, at = [], 0, 0
    while at < len(pattern):
        ch = pattern[at]
        if ch == "\\" and at + 1 < len(pattern):
            at += 1
            out.append(re.escape(pattern[at]))
        elif ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[" and "]" in pattern[at + 1:]:
            end = pattern.index("]", at + 1)
            body = pattern[at + 1:end]
            negate, body = body.startswith("!"), body.removeprefix("!")
            safe = re.sub(r"([\\\[\]^&])", r"\\\1", body)
            out.append(f"[{'^' if negate else ''}{safe}]")
            at = end
        elif ch == "{":
            depth += 1
            out.append("(?:")
        elif ch == "}" and depth:
            depth -= 1
            out.append(")")
        elif ch == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(ch))
        at += 1
    if depth:
        raise ValueError(f"unbalanced braces in {pattern!r}")
    return "".join(out)


def _one(col: Column, pattern: str) -> Column:
    """A single pattern; prefix, suffix and infix globs become tests the scan can use."""
    core = pattern.strip("*")
    if _PLAIN.fullmatch(core):
        if pattern == core:
            return col == core
        if pattern == core + "*":
            return col.startswith(core)
        if pattern == "*" + core:
            return col.endswith(core)
        if pattern == f"*{core}*":
            return col.contains(core)
    return col.rlike(rf"\A(?s:{_regex(pattern)})\z")


def match(col: Column, patterns: list[str]) -> Column | None:
    """Condition for a pattern list, or None for an empty list. Without wildcards it is set membership."""
    if not patterns:
        return None
    if not any(_META.search(p) for p in patterns):
        return col.isin(*patterns)
    if len(patterns) > 1 and not all(_PLAIN.fullmatch(p.strip("*")) for p in patterns):
        return _one(col, "{" + ",".join(patterns) + "}")
    out = None
    for p in patterns:
        out = _one(col, p) if out is None else out | _one(col, p)
    return out


def include_exclude(col: Column, include: list[str] = (), exclude: list[str] = ()) -> Column:
    """Matches the include list, if there is one, and nothing on the exclude list."""
    keep = F.lit(True)
    inside, outside = match(col, list(include)), match(col, list(exclude))
    if inside is not None:
        keep = keep & inside
    if outside is not None:
        keep = keep & ~outside
    return keep


def match_any(col: Column, patterns: list[str]) -> Column:
    """Topic and group lists: only ``*`` is special, and an empty list matches nothing."""
    out = F.lit(False)
    for p in patterns:
        regex = ".*".join(re.escape(part) for part in p.split("*"))
        simple = "*" not in p.strip("*")
        if p and not p.strip("*"):
            out = out | col.isNotNull()
        elif simple and "*" in p and p == p.strip("*") + "*":
            out = out | col.startswith(p[:-1])
        elif simple and "*" not in p:
            out = out | (col == p)
        else:
            out = out | col.rlike(rf"\A(?s:{regex})\z")
    return out


def allow_list(col: Column, names: list[str]) -> Column:
    """Node and exchange lists: exact names, and an empty list matches everything."""
    return col.isin(*names) if names else F.lit(True)


@dataclass(frozen=True)
class FilterSpec:
    """Pass and drop lists of one input. Tag lists map a tag name to patterns for its value."""

    name_pass: list[str] = field(default_factory=list)
    name_drop: list[str] = field(default_factory=list)
    field_pass: list[str] = field(default_factory=list)
    field_drop: list[str] = field(default_factory=list)
    tag_pass: dict[str, list[str]] = field(default_factory=dict)
    tag_drop: dict[str, list[str]] = field(default_factory=dict)
    tag_include: list[str] = field(default_factory=list)
    tag_exclude: list[str] = field(default_factory=list)


def _any_tag(lists: dict[str, list[str]]) -> Column:
    tests = [match(F.try_element_at(F.col("tags"), F.lit(t)), list(p)) for t, p in lists.items()]
    out = F.lit(False)
    for test in tests:
        if test is not None:
            out = out | F.coalesce(test, F.lit(False))
    return out


def name_filter(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return df.filter(include_exclude(F.col("measurement"), spec.name_pass, spec.name_drop))


def tag_value_filter(df: DataFrame, spec: FilterSpec) -> DataFrame:
    if spec.tag_pass:
        df = df.filter(_any_tag(spec.tag_pass))
    if spec.tag_drop:
        df = df.filter(~_any_tag(spec.tag_drop))
    return df


def field_filter(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Keep matching fields; a point without fields disappears."""
    if not (spec.field_pass or spec.field_drop):
        return df

    def keep(key: Column) -> Column:
        return include_exclude(key, spec.field_pass, spec.field_drop)

    return (df.filter(F.exists(F.map_keys("fields"), keep))
            .withColumn("fields", F.map_filter("fields", lambda k, _: keep(k))))


def tag_key_filter(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Remove tags by key; the points stay."""
    if not (spec.tag_include or spec.tag_exclude):
        return df
    return df.withColumn("tags", F.map_filter(
        "tags", lambda k, _: include_exclude(k, spec.tag_include, spec.tag_exclude)))


def apply_filter(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Name lists, then tag values, then fields, then tag keys. With all lists empty nothing changes."""
    if spec == FilterSpec():
        return df
    return tag_key_filter(field_filter(tag_value_filter(name_filter(df, spec), spec), spec), spec)
