"""Exact top-k search by MaxScore over posting lists of sparse or dense integer vectors.

A vector's positions are the terms, its values the weights, and a score is the sum over terms of
``query weight * row weight``. The rows are dealt by a hash of their id into shards. A shard is written once, term by term: a term
that few rows have as a posting list (places and weights), any other as a whole column, both with the least and the largest weight.

A query orders its terms by how much they can still change a score within the shard. The terms whose bounds together can't lift
a row to the current k-th score are non-essential. The essential postings are traversed, which scores every row over them; the other terms are
probed, a few at a time, only for rows that stay competitive. The k-th score is carried from shard to shard of a task, so
most shards begin with a good one. Queries are taken in blocks of bounded bytes, and each block is broadcast and meets every shard:
rows are neither copied nor shuffled for it. The tasks' results, at most k rows a query, are merged by rank.

Weights may be negative: a term's contribution lies between its smallest and largest product in the shard, and a row is
dropped only if its score so far plus the largest products of the rest is below the k-th score (equal rows stay, for ties).

Defined cases: a vector that is null, or holds a null or non-finite value, takes no part, nor does a row with a null
id. Vectors of different lengths are met with zeros. Repeated rows count each on their own, but an id never finds itself; of several
queries with one id the largest (in array order) asks. Fewer than k candidates: all are returned. Sums that no 64-bit integer holds
are clipped to its range. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeloom.llm.common import keep, load, query

#: Rows of a shard and bytes of a broadcast block of queries.
SHARD_ROWS, BLOCK_BYTES = 8192, 16 << 20
#: Rows of a shard that are scored first, so that a first k-th score is known, and terms probed at a time.
FIRST, PROBE = 256, 8
#: Share of rows from which a term is kept as a column, and share of the columns up to which a query's own are picked out.
DENSE, COPIED = 0.25, 0.125

_PACKED = "shard long, n int, ids binary, lengths binary, values binary"
_RESULT = "query_id long, vec_id long, score long"


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if the vector is null or has a null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def _matrix(lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Rows of different lengths, filled up with zeros."""
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), at] = flat
    return out


def _exact(terms: int, most: float, other: float) -> type:
    """The number type in which every sum of products is exact."""
    worst = (most + 1) * (other + 1) * max(1, terms)
    return np.float64 if worst < 2**53 else np.int64 if worst < 2**62 else object


class Postings:
    """A shard by terms. Bounds are worked out here, once for all queries."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, most: float = 0.0):
        """``most`` is the largest weight of any query, which decides on the number type."""
        self.ids, (self.n, self.terms) = ids, rows.shape
        self.kind = _exact(self.terms, float(np.abs(rows.astype(float)).max(initial=0)), most)
        columns = np.ascontiguousarray(rows.T).astype(self.kind)
        zero = np.zeros(self.terms, self.kind)
        self.low, self.high = (columns.min(axis=1), columns.max(axis=1)) if self.n else (zero, zero)
        used = (columns != 0).sum(axis=1) if self.n else np.zeros(self.terms, int)
        self.is_dense = used > DENSE * self.n
        # Dense terms first, as one block of columns; the place of each in it.
        self.place = np.cumsum(self.is_dense) - 1
        self.block = columns[self.is_dense]
        self.lists = {t: (w := np.flatnonzero(columns[t]), columns[t][w]) for t in np.flatnonzero(~self.is_dense & (used > 0)).tolist()}

    def traverse(self, q: np.ndarray, terms: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Scores of the rows from ``start`` to ``stop`` over these terms."""
        dense = terms[self.is_dense[terms]]
        if self.kind is np.float64 and len(dense) > COPIED * len(self.block):
            # Picking columns copies them, which costs more than passing over the others with weight 0.
            weights = np.zeros(len(self.block), self.kind)
            weights[self.place[dense]] = q[dense]
            score = weights @ self.block[:, start:stop]
        else:
            score = q[dense] @ self.block[self.place[dense], start:stop]
        for t in terms[~self.is_dense[terms]].tolist():
            if t in self.lists:
                rows, values = self.lists[t]
                a, b = np.searchsorted(rows, (start, stop))
                score[rows[a:b] - start] += values[a:b] * q[t]
        return score

    def probe(self, q: np.ndarray, terms: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What these terms add for single rows."""
        dense = terms[self.is_dense[terms]]
        if self.kind is np.float64 and len(at) > COPIED * self.n:
            more = (q[dense] @ self.block[self.place[dense]])[at]
        else:
            more = q[dense] @ self.block[self.place[dense][:, None], at]
        for t in terms[~self.is_dense[terms]].tolist():
            if t in self.lists:
                rows, values = self.lists[t]
                i = np.minimum(np.searchsorted(rows, at), len(rows) - 1)
                more = more + np.where(rows[i] == at, values[i] * q[t], 0)
        return more

    def search(self, q: np.ndarray, own: int | None, k: int, best: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows of the shard and of ``best``, the k best so far."""
        weights = np.zeros(self.terms, self.kind)
        weights[: len(q)] = q[: self.terms].astype(self.kind)
        high, low = self.high * weights, self.low * weights
        high, low = np.maximum(high, low), np.minimum(high, low)
        order = np.argsort(-(high - low).astype(float), kind="stable")
        order = order[weights[order] != 0]
        # The most that the terms from each place on can add.
        rest = np.concatenate([np.cumsum(high[order][::-1])[::-1], np.zeros(1, self.kind)])
        best_ids, scores = best if best is not None else (self.ids[:0], np.zeros(0, self.kind))
        for start, stop in ((0, min(FIRST, self.n)), (min(FIRST, self.n), self.n)):
            if start == stop:
                continue
            least = scores.min() if len(scores) >= k else None
            # Essential: without these terms, no row can reach the k-th score.
            done = len(order) if least is None else int(np.argmax(np.append(rest[:-1] < least, True)))
            score = self.traverse(weights, order[:done], start, stop)
            at = np.arange(start, stop)
            if least is not None:
                fit = score + rest[done] >= least
                at, score = at[fit], score[fit]
            while done < len(order) and len(at):
                some = order[done : done + PROBE]
                score = score + self.probe(weights, some, at)
                done += len(some)
                fit = score + rest[done] >= least
                at, score = at[fit], score[fit]
            if own is not None:
                other = self.ids[at] != own
                at, score = at[other], score[other]
            best_ids, scores = _top(np.append(best_ids, self.ids[at]), np.append(scores, score), k)
        return best_ids, scores


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best, ties to the smaller id."""
    if len(scores) > 4 * k and scores.dtype != object:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[scores >= cut], scores[scores >= cut]
    top = np.lexsort((ids, -scores))[:k]
    return ids[top], scores[top]


def search_shard(ids: np.ndarray, rows: np.ndarray, own: int | None, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows for one query."""
    return Postings(ids, rows, float(np.abs(q.astype(float)).max(initial=0))).search(q, own, k)


def _pack(table: pa.Table) -> pa.Table:
    vectors = table.column("v").combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    made = (table.column("shard")[0].as_py(), len(lengths), table.column("id").to_numpy().tobytes(), lengths.tobytes(), flat.tobytes())
    return pa.table({n: pa.array([x], t) for n, x, t in zip(("shard", "n", "ids", "lengths", "values"), made,
                                                           (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))})


def _searcher(block, k: int):
    """The k best rows of the task's shards for every query of a broadcast block."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value
        most = max((float(np.abs(q.astype(float)).max(initial=0)) for _, q in queries), default=0.0)
        best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(queries)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, values = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("ids", "lengths", "values"))
                shard = Postings(ids, _matrix(lengths, values), most)
                for j, (name, q) in enumerate(queries):
                    best[j] = shard.search(q, name, k, best[j])
        found = [(name, i, s) for (name, _), b in zip(queries, best) if b is not None for i, s in zip(b[0].tolist(), b[1].tolist())]
        out = [[n for n, _, _ in found], [i for _, i, _ in found], [min(max(int(s), -(2**63)), 2**63 - 1) for _, _, s in found]]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return search


def top_k(rows: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows. Both frames have (id long, v array<long>)."""
    fine = rows.where("id IS NOT NULL AND v IS NOT NULL").select("id", "v")
    shards = max(1, -(-fine.count() // shard_rows))
    packed = keep(fine.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))).groupBy("shard").applyInArrow(_pack, _PACKED), "postings")
    asked = keep(queries.where("id IS NOT NULL AND v IS NOT NULL").groupBy("id").agg(F.max("v").alias("v")), "queries")
    size = asked.agg(F.sum(F.size("v") * 8 + 256).alias("n")).first().n or 0
    blocks, parts = max(1, -(-size // block_bytes)), []
    for b in range(blocks):
        # A block of queries is all that passes through the driver at a time.
        block = [(r.id, np.array(r.v, np.int64)) for r in asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()]
        parts.append(packed.mapInArrow(_searcher(rows.sparkSession.sparkContext.broadcast(block), k), _RESULT))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_TOP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


@query("op10_maxscore", _TOP10)
def embedding_top10(spark, sf_dir):
    """Ten best rows of ``embeddings`` for every row whose id is divisible by 100, in integer inner product."""
    vectors = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), whole_numbers(F.col("embedding")).alias("v"))
    return top_k(vectors, vectors.where(F.col("id") % 100 == 0), 10)
