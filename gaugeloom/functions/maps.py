"""Map and line helpers that work inside one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, for use inside other expressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out exactly once per row.

    Catalyst moves filters below projections by copying the expressions they use, so a parsed reply that is
    both tested and read would be parsed twice. A one-element ``explode`` is not crossed by filters.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(packed)).alias("_once")).select(*kept, "_once.*")


def lines(payload: Column) -> Column:
    """Lines of a reply, without the ending line break."""
    return F.split(F.regexp_replace(payload, r"\r?\n\z", ""), r"\r?\n")


def last_wins(entries: Column) -> Column:
    """Map from entries with ``k`` and ``v``; of equal keys the last one stays. Null values are dropped."""

    def build(kept: Column) -> Column:
        return let(F.transform(kept, lambda e: e["k"]), lambda keys: F.map_from_entries(
            F.transform(F.when(F.size(F.array_distinct(keys)) == F.size(keys), kept).otherwise(F.filter(
                kept, lambda e, at: ~F.array_contains(F.slice(keys, at + 2, F.size(keys)), e["k"]))),
                lambda e: F.struct(e["k"], e["v"]))))

    return let(F.filter(entries, lambda e: e["v"].isNotNull()), build)


def last_value(entries: Column, key: str) -> Column:
    """Value of the last entry with this key, or NULL."""
    found = F.filter(entries, lambda e: e["k"] == key)
    return F.try_element_at(found, F.lit(-1))["v"]


def shown(tags: Column) -> Column:
    """``k=v`` pairs in key order, for printing and comparing."""
    return F.array_join(F.transform(
        F.sort_array(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
