"""Hard negatives of anchor vectors by BOND: a vertical scan of columns with shrinking candidate sets.

Rows are dealt by a hash of their id into shards, and each shard is written as columns: for every dimension the values of all its
rows, with the dimension's least and largest value. An anchor reads a shard's columns in descending magnitude of its own
components. After every few columns, a row's score is known to lie between its sum so far plus the least and plus the
most that the remaining columns can add; a row that can no longer reach a wanted score leaves the candidate set. What survives all
columns has its exact score.

An anchor's positives are its ``positives`` best other rows of its label. A positive of score p opens the window
``low * p <= 100 * score <= high * p``, and the first ``negatives`` rows of other labels in it are the answer. A window that holds
enough rows is narrowed from below to its last one, from shard to shard of a task; its upper end cuts off the rows that are too close.

The anchors are taken in blocks of bounded bytes, and each block is broadcast and meets every shard: rows are neither copied nor
shuffled for it. A task gives at most ``negatives`` rows for each window, whatever the number of its shards.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite component take no part.
Vectors of different lengths are met with zeros. Repeated rows count each on their own, but no row with the anchor's id is its
positive or negative; of several anchors with one id, the largest by label and vector asks. Ties go to the smaller id.
An anchor without positives or a window without rows gives no rows. Sums that no 64-bit integer holds are clipped. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeloom.llm.common import keep, load, query
from gaugeloom.llm.maxscore import whole_numbers

#: Rows of a shard, bytes of a broadcast block of anchors, and columns read between two looks at the candidates.
SHARD_ROWS, BLOCK_BYTES, STEP = 8192, 16 << 20, 8
#: Rows of a shard that are scored first, so that the windows narrow early, and the share of candidates from which they are listed.
FIRST, SPARSE = 512, 0.25

_PACKED = "shard long, n int, width int, ids binary, labels binary, columns binary"


def _pack(table: pa.Table) -> pa.Table:
    """One row: the shard's ids, labels and columns, sorted by label."""
    vectors = table.column("v").combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    width, flat = int(sizes.max(initial=0)), vectors.flatten().to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(sizes), width), np.int64)
    matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
    order = np.lexsort((ids, labels))
    made = (table.column("shard")[0].as_py(), len(ids), width, ids[order].tobytes(), labels[order].tobytes(), np.ascontiguousarray(matrix[order].T).tobytes())
    return pa.table({n: pa.array([x], t) for n, x, t in zip(("shard", "n", "width", "ids", "labels", "columns"), made,
                                                           (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))})


def packed(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Column shards of (id long, label long, v array<long>), written once."""
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    return keep(dealt.groupBy("shard").applyInArrow(_pack, _PACKED), "column-shards")


class Shard:
    """Columns of a shard with what each can add at least and at most."""

    def __init__(self, row: dict, width: int, most: float):
        n, own = row["n"], row["width"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.columns = np.zeros((max(width, own), n), np.int64)
        self.columns[:own] = np.frombuffer(row["columns"], np.int64).reshape(own, n)
        # Doubles add up whole numbers exactly as long as no sum passes 2**53, and 64-bit integers up to 2**63.
        worst = (float(np.abs(self.columns.astype(float)).max(initial=0)) + 1) * (most + 1) * max(1, len(self.columns))
        self.kind = np.float64 if worst < 2**53 else np.int64 if worst < 2**62 else object
        self.columns = self.columns.astype(self.kind)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def parts(self, own: int, label: int, same: bool) -> list[tuple[int, int, np.ndarray]]:
        """The rows of the label, or of all others, without those of the id ``own``: a small part first, so that windows narrow early."""
        n, a, b = len(self.ids), *(int(np.searchsorted(self.labels, label, side)) for side in ("left", "right"))
        if same:
            return [(i, j, self.ids[i:j] != own) for i, j in ((a, min(b, a + FIRST)), (min(b, a + FIRST), b)) if i < j]
        first = (b, min(n, b + FIRST)) if n - b >= a else (max(0, a - FIRST), a)
        rest = self.ids != own
        rest[a:b] = rest[first[0] : first[1]] = False
        return [(*first, self.ids[first[0] : first[1]] != own), (0, n, rest)] if first[0] < first[1] else []

    def scan(self, anchor: np.ndarray, start: int, stop: int, live: np.ndarray | None, intervals: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Rows from ``start`` to ``stop`` (of them those that ``live`` marks) whose score lies in one of the intervals, and their scores."""
        q = np.zeros(len(self.columns), self.kind)
        q[: len(anchor)] = anchor.astype(self.kind)
        order = np.argsort(-np.abs(q.astype(float)), kind="stable")
        order = order[q[order] != 0]
        first, second = self.low[order] * q[order], self.high[order] * q[order]
        zero = np.zeros(1, self.kind)
        # The least and the most that the columns from here on can add.
        least = np.concatenate([np.cumsum(np.minimum(first, second)[::-1])[::-1], zero])
        most = np.concatenate([np.cumsum(np.maximum(first, second)[::-1])[::-1], zero])
        part = self.columns[:, start:stop]
        live = np.ones(stop - start, bool) if live is None else live
        score, rows, done, looked = np.zeros(stop - start, self.kind), None, 0, np.inf
        while done < len(order):
            some = order[done : done + STEP]
            score = score + q[some] @ (part[some] if rows is None else part[some[:, None], rows])
            done += len(some)
            # A look costs as much as a column: the next one waits until the uncertainty has shrunk to two thirds.
            if done < len(order) and most[done] - least[done] > looked * 2 / 3:
                continue
            looked = most[done] - least[done]
            fits = np.zeros(len(score), bool)
            for low, high in _merged([(low - most[done], high - least[done]) for low, high in intervals]):
                fits |= (score >= low) & (score <= high)
            if rows is not None:
                rows, score = rows[fits], score[fits]
                continue
            live = live & fits
            if done == len(order) or np.count_nonzero(live) < SPARSE * len(live):
                rows = np.flatnonzero(live)
                score = score[rows]
        if rows is None:  # an anchor of zeros scores 0 everywhere
            rows = np.flatnonzero(live) if any(low <= 0 <= high for low, high in intervals) else np.zeros(0, np.int64)
            score = score[rows]
        return rows + start, score


def _merged(intervals: list[tuple]) -> list[tuple]:
    """The same union as intervals that don't overlap."""
    out: list[tuple] = []
    for low, high in sorted(x for x in intervals if x[0] <= x[1]):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


class Best:
    """The k best (score, id) found so far for one window, and the least score that still counts."""

    __slots__ = ("k", "low", "high", "ids", "scores")

    def __init__(self, k: int, low, high):
        self.k, self.low, self.high, self.ids, self.scores = k, low, high, np.zeros(0, np.int64), np.zeros(0)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = (scores >= self.low) & (scores <= self.high)
        if not fit.any():
            return
        ids, scores = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.scores.astype(scores.dtype), scores[fit]])
        top = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[top], scores[top]
        if len(top) == self.k:
            self.low = max(self.low, self.scores[-1])


def _finder(block, k: int, same: bool):
    """Best rows of the task's shards for every window of a broadcast block of anchors."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        best = [[Best(k, low, high) for low, high in zip(a["lows"], a["highs"])] for a in anchors]
        width = max((len(a["v"]) for a in anchors), default=0)
        most = max((float(np.abs(a["v"].astype(float)).max(initial=0)) for a in anchors), default=0.0)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], width, most)
                for a, windows in zip(anchors, best):
                    for start, stop, live in shard.parts(a["id"], a["label"], same):
                        found, scores = shard.scan(a["v"], start, stop, live, [(w.low, w.high) for w in windows])
                        for w in windows:
                            w.add(shard.ids[found], scores)
        out: list[list] = [[], [], [], []]
        for a, windows in zip(anchors, best):
            for place, w in enumerate(windows):
                out[0] += [a["id"]] * len(w.ids)
                out[1] += [place] * len(w.ids)
                out[2] += w.ids.tolist()
                out[3] += [min(max(int(x), -(2**63)), 2**63 - 1) for x in w.scores]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                         names=["anchor_id", "place", "id", "score"])

    return find


def _blocks(anchors: DataFrame, block_bytes: int) -> Iterator[list[dict]]:
    """The anchors in blocks of about ``block_bytes``: the only rows that pass through the driver, a block at a time."""
    size = anchors.agg(F.sum(F.size("v") * 8 + 256).alias("n")).first().n or 0
    blocks = max(1, -(-size // block_bytes))
    for b in range(blocks):
        rows = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        yield [{**r.asDict(), "v": np.array(r.v, np.int64)} for r in rows]


def _search(shards: DataFrame, anchors: DataFrame, k: int, same: bool, windows, block_bytes: int) -> DataFrame:
    """(anchor_id, place, rank, id, score): the ``k`` best rows of each anchor's windows over all shards."""
    spark, parts = shards.sparkSession, []
    for block in _blocks(anchors, block_bytes):
        asked = []
        for a in block:
            lows, highs = windows(a)
            asked.append({"id": a["id"], "label": a["label"], "v": a["v"], "lows": lows, "highs": highs})
        parts.append(shards.mapInArrow(_finder(spark.sparkContext.broadcast(asked), k, same), "anchor_id long, place int, id long, score long"))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    ranked = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         shard_rows: int = SHARD_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (id long, label, v array<long>)."""
    fine = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").select("id", F.col("label").cast("long").alias("label"), "v")
    shards = packed(fine, shard_rows)
    asked = keep(fine.where(is_anchor).groupBy("id").agg(F.max(F.struct("label", "v")).alias("a")).select("id", "a.*"), "anchors")
    best = keep(_search(shards, asked, positives, True, lambda a: ([-np.inf], [np.inf]), block_bytes).select(
        "anchor_id", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = best.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))

    def windows(a):
        p = [x.positive_score for x in a["p"]]
        return [-(-low * s // 100) for s in p], [high * s // 100 for s in p]

    found = _search(shards, asked.join(scores, "id"), negatives, False, windows, block_bytes)
    return found.withColumn("place", F.col("place") + 1).join(best, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


_MINED = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, v.id, a.label = v.label AS same, CAST(list_inner_product(a.v, v.v) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.id <> v.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) <= 10
"""


@query("op12_bond_negatives", _MINED)
def embedding_negatives(spark, sf_dir):
    """Ten negatives within 30 to 90 % of each of the five positives, for every row of ``embeddings`` whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), whole_numbers(F.col("embedding"), 256).alias("v"))
    return mine(rows, F.col("id") % 100 == 0)
