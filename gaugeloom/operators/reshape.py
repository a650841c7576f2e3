"""Chunking, unpivots and ordered ranks that stay parallel inside one large group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeloom.functions.maps import last_wins

#: Rows from which a group is ranked slice by slice, and its slices.
SLICE_ROWS, SLICES = 1_000_000, 64
#: Large groups (they are counted first) up to which what holds for their slices, about 1 KB each, is broadcast.
BROADCAST_GROUPS = 50_000
#: Largest k that the group limit before a shuffle takes (Spark's default), and parts a group is cut into beyond it.
GROUP_LIMIT, SALTS = 1000, 64


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group as one struct, which also compares groups with NULL parts."""
    return df.withColumn("_key", F.struct(*[F.col(f"`{k}`") for k in keys]))


def _cut(df: DataFrame, keys: list[str], pos: str, slice_rows: int) -> tuple[DataFrame, int]:
    """Rows with ``_key`` and ``_slice``, and how many groups are large: those are cut at counted positions, so each slice holds about as many rows.

    The splitters are approximate quantiles of the group's own positions, however dense or sparse those are. Rows without a position
    lie in the first slice, and come first in it. ``_splits`` is NULL in groups of one slice. Groups are counted right away, so
    that rows without a large group, the usual case, are neither joined nor cut.
    """
    keyed, at = _keyed(df, keys), F.col(f"`{pos}`")
    large = keyed.groupBy("_key").agg(F.count(at).alias("_n")).where(F.col("_n") > slice_rows).select("_key")
    n = large.count()
    if not n:
        return keyed.withColumn("_slice", F.lit(0)), 0
    splits = keyed.select("_key", at.alias("_at")).join(_small(large, n), "_key").groupBy("_key").agg(
        F.percentile_approx("_at", [i / SLICES for i in range(1, SLICES)], 20 * SLICES).alias("_splits"))
    below = F.size(F.filter("_splits", lambda s: s <= at))
    return keyed.join(_small(splits, n), "_key", "left").withColumn("_slice", F.when(F.col("_splits").isNull(), F.lit(0)).otherwise(below)), n


def _small(df: DataFrame, groups: int) -> DataFrame:
    return F.broadcast(df) if groups <= BROADCAST_GROUPS else df


def _inside(pos: str):
    return Window.partitionBy("_key", "_slice").orderBy(F.col(f"`{pos}`"))


def _earlier():
    return Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def _by_slice(df: DataFrame, value: str) -> DataFrame:
    """One row per large group: what holds for each of its slices, as a map."""
    return df.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("_slice", value))).alias("_of"))


def ordered_rank(df: DataFrame, keys: list[str], pos: str, out: str = "rank", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Zero-based rank by position within each group.

    A large group is cut into slices of about equal numbers of rows, so a group holding most of the rows is still ranked by many
    tasks: rank in the slice, plus the row counts of the group's earlier slices. The counts are combined
    before they are shuffled, so full rows are shuffled once.
    """
    cut, large = _cut(df, keys, pos, slice_rows)
    local = cut.withColumn("_local", F.row_number().over(_inside(pos)) - 1)
    if not large:
        return local.select(*df.columns, F.col("_local").alias(out))
    sizes = cut.where(F.col("_splits").isNotNull()).groupBy("_key", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    starts = _by_slice(sizes.select("_key", "_slice", F.coalesce(F.sum("_n").over(_earlier()), F.lit(0)).alias("_start")), "_start")
    start = F.coalesce(F.try_element_at("_of", F.col("_slice")), F.lit(0))
    return local.join(_small(starts, large), "_key", "left").select(*df.columns, (F.col("_local") + start).alias(out))


def field_chunks(
    df: DataFrame, keys: list[str], pos: str, name: str, value: str, size: int = 20, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Pack the kept name/value rows of each group into field maps of at most ``size`` entries, in order.

    Of equal names in one map the later one stays.
    """
    kept = df.filter(F.col(value).isNotNull())
    ranked = ordered_rank(kept, keys, pos, "_rank", slice_rows)
    return (ranked.withColumn("chunk", F.floor(F.col("_rank") / size))
            .groupBy(*keys, "chunk")
            .agg(last_wins(F.sort_array(F.collect_list(
                F.struct("_rank", F.col(name).alias("k"), F.col(value).alias("v"))))).alias("fields")))


def collect_fields(df: DataFrame, keys: list[str], pos: str, name: str, value: str) -> DataFrame:
    """One field map per group; of equal names the one at the highest position stays."""
    latest = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, name).agg(F.max_by(value, pos).alias("_value")))
    return latest.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(name), F.col("_value")))).alias("fields"))


def unpivot(df: DataFrame, keep: list[str], label: str, rows: dict[str, dict[str, str]]) -> DataFrame:
    """One output row per label; ``rows`` maps a label to its output columns and their source columns.

    Output columns a label does not have are NULL. A single ``explode``: the input is read once.
    """
    names = list(dict.fromkeys(n for cols in rows.values() for n in cols))
    structs = [
        F.struct(F.lit(tag).alias(label), *[
            (F.col(cols[n]) if n in cols else F.lit(None)).cast("double").alias(n) for n in names])
        for tag, cols in rows.items()
    ]
    return df.select(*keep, F.explode(F.array(*structs)).alias("_row")).select(*keep, "_row.*")


def carry_forward(df: DataFrame, keys: list[str], pos: str, mark: str, out: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Give every row the last non-null mark at or before it in its group, slice by slice."""
    cut, large = _cut(df, keys, pos, slice_rows)
    local = cut.withColumn("_local", F.last(mark, ignorenulls=True).over(_inside(pos)))
    if not large:
        return local.select(*df.columns, F.col("_local").alias(out))
    last = F.max_by(mark, F.when(F.col(mark).isNotNull(), F.struct("_slice", F.col(f"`{pos}`"))))
    ends = cut.where(F.col("_splits").isNotNull()).groupBy("_key", "_slice").agg(last.alias("_last"))
    heads = _by_slice(ends.select("_key", "_slice", F.last("_last", ignorenulls=True).over(_earlier()).alias("_head")), "_head")
    head = F.try_element_at("_of", F.col("_slice"))
    return local.join(_small(heads, large), "_key", "left").select(*df.columns, F.coalesce("_local", head).alias(out))


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every group; the group limit is applied before rows are shuffled."""
    return top_rows(df, keys, order, 1)


def top_rows(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group.

    Up to ``GROUP_LIMIT`` rows each task keeps its own first ones before anything is shuffled. Beyond, a group is cut into ``SALTS``
    parts whose first ``k`` rows are found side by side, and only those meet.
    """
    if k > GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if _hashable(df, c)]), F.lit(SALTS)))
        df = _first(salted, [*keys, "_salt"], order, k).drop("_salt")
    return _first(df, keys, order, k)


def _hashable(df: DataFrame, column: str) -> bool:
    return "map<" not in df.schema[column].dataType.simpleString() and "variant" not in df.schema[column].dataType.simpleString()


def _first(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= k).drop("_rn")
