"""Importance resampling of documents towards the word distribution of a target, with a head-tail vocabulary.

A text's features are its runs of 1 to ``order`` consecutive words, each counted as often as it stands there; a feature's
bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``. A bucket's gain is the logarithm of how much more often the
target uses it, and a document's weight is the sum of its features' gains. Gumbel noise from a hash of the document's id
turns weights into a draw without replacement: the highest scores are drawn.

The head of the vocabulary is found by Misra-Gries summaries of all texts, so every word that makes up more than
1 / ``SUMMARY`` of a task's words is in that task's summary; the most frequent of their union are broadcast, words with
their CRC state and, for runs of two words and more, pairs with their bucket. A run's CRC goes on from the state of its first
word. What isn't in the head takes its CRC directly. Head or tail, the bucket is the same: the head only saves work.

Every text is read twice: for the head, and for its buckets. These are written (two bytes a feature) and then serve the totals
and the weights. Ranks are worked out slice by slice of the scores.

Defined cases: a null or empty text, or one without a word, has no features and weight 0. Repeated rows count and are drawn each
on its own; rows that tie in score and id may come in either order, with the same result. A null id ranks before others at the
same score. An empty table gives no rows, and an empty target counts every feature 0 times. Columns named like the result's are
replaced, others pass through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeloom.llm.common import forget_caches, keep, load, query, slices, text_bytes, to_python, worker_cache

#: Counters of a task's summary, entries of the broadcast head, and the longest word (in bytes) that the head takes.
SUMMARY, HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 8192, 16384, 16384, 48
#: Rows of a slice of the ranking, and slices at most.
SLICE_ROWS, SLICES = 4000, 1000

#: Lower case for A-Z, a space for every other ASCII character that is neither letter nor digit.
_PLAIN = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(data: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return data.translate(_PLAIN).split()


def _pairs(found: list[bytes]) -> list[bytes]:
    return [a + b" " + b for a, b in zip(found, found[1:])]


def shrink(counts: Counter, size: int) -> Counter:
    """A Misra-Gries step: at most ``size`` counters stay, all lowered by the largest count that doesn't."""
    if len(counts) <= size:
        return counts
    cut = np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -(size + 1))[-(size + 1)]
    return Counter({w: n - int(cut) for w, n in counts.items() if n > cut})


def _summariser(order: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Counter(), Counter()]
        for batch in slices(batches, "_data"):
            for data in batch.column("_data"):
                found = words(data.as_py())
                for kind, items in enumerate((found, _pairs(found) if order > 1 else [])):
                    kept[kind].update(items)
                    if len(kept[kind]) > 4 * SUMMARY:
                        kept[kind] = shrink(kept[kind], SUMMARY)
        for kind, counts in enumerate(kept):
            items = [(w, n) for w, n in shrink(counts, SUMMARY).items() if len(w) <= HEAD_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(items), pa.int32()), pa.array([w for w, _ in items], pa.binary()),
                                              pa.array([n for _, n in items], pa.int64())], names=["kind", "item", "n"])

    return summarise


def frequent(texts: DataFrame, order: int) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """CRC-32 of the most frequent words and pairs of ``_data``: at most ``HEAD_WORDS`` and ``HEAD_PAIRS``."""
    counts = to_python(texts.select("_data")).mapInArrow(_summariser(order), "kind int, item binary, n long").groupBy("kind", "item").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    heads = []
    for kind, most in ((0, HEAD_WORDS), (1, HEAD_PAIRS)):
        rows = counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "item").limit(most).collect()
        heads.append({bytes(r.item): zlib.crc32(r.item) for r in rows})
    counts.unpersist()
    return heads[0], heads[1]


def feature_buckets(found: list[bytes], order: int, buckets: int, states: dict[bytes, int], pairs: dict[bytes, int]) -> np.ndarray:
    """Bucket of every run of 1 to ``order`` words. ``states`` and ``pairs`` hold the head's CRC states and buckets."""
    crc = zlib.crc32
    first = [s if s is not None else crc(w) for s, w in zip(map(states.get, found), found)]
    parts = [np.array(first, np.uint32) % np.uint32(buckets)]
    if order > 1 and len(found) > 1:
        known = map(pairs.get, _pairs(found))
        parts.append(np.array([b if b is not None else crc(b" " + w, s) % buckets for b, s, w in zip(known, first, found[1:])], np.uint32))
    for size in range(3, min(order, len(found)) + 1):
        runs = (crc(b" " + b" ".join(found[i + 1 : i + size]), first[i]) % buckets for i in range(len(found) - size + 1))
        parts.append(np.fromiter(runs, np.uint32))
    return np.concatenate(parts)


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _bucketer(head, key: str, names: list[str], order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches("head")
        states, pairs = worker_cache("head", key, lambda: (head.value[0], {p: c % buckets for p, c in head.value[1].items()}))
        for batch in slices(batches, "_data"):
            found = [words(x.as_py()) for x in batch.column("_data")]
            made = [feature_buckets(w, order, buckets, states, pairs) for w in found]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array([len(w) for w in found], pa.int64()), pa.array([len(b) for b in made], pa.int64()),
                 pa.array([b.astype(_width(buckets)).tobytes() for b in made], pa.binary())],
                names=[*names, "_words", "n_features", "_buckets"])

    return run


def _totals(buckets: int):
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column("_buckets"):
                sums += np.bincount(np.frombuffer(x.as_buffer(), _width(buckets)), minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets), pa.int64()), pa.array(sums)], names=["bucket", "n"])

    return total


def bucket_totals(features: DataFrame, buckets: int, name: str) -> DataFrame:
    """(bucket, name): how many features of all rows each bucket holds. A task gives one row a bucket."""
    return features.select("_buckets").mapInArrow(_totals(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 * ln of target share over corpus share) of each bucket, both with one added to every bucket."""
    both = (corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(bucket_totals(corpus, buckets, "s"), "bucket", "left")
            .join(bucket_totals(target, buckets, "t"), "bucket", "left").select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("s", "t")]))
    rows = both.collect()  # one row a bucket
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in rows:
        s[r.bucket], t[r.bucket] = r.s, r.t
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _weigher(gains: bytes, names: list[str], buckets: int):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(gains, np.int64)
        for batch in batches:
            sums = [int(table[np.frombuffer(x.as_buffer(), _width(buckets))].sum()) for x in batch.column("_buckets")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sums, pa.int64())], names=[*names, "weight"])

    return weigh


def gumbel(seed: int, doc_id: Column) -> Column:
    """floor(-1000 * ln(-ln(u))), u in (0, 1) from the SHA-256 of ``seed:doc_id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def drawn(scored: DataFrame, eligible: Column, percent: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``scored`` with the rank of the ``percent`` % eligible rows of highest score (then smaller doc_id); null for the rest.

    Scores are cut into slices at approximate quantiles. Exact counts say where each slice's ranks begin, so rows are
    only ordered inside their slice, and only in the slices that are drawn from.
    """
    rows = scored.withColumn("_in", F.coalesce(eligible, F.lit(False)))
    inside = rows.where("_in")
    n = inside.count()
    parts = min(SLICES, max(1, -(-n // slice_rows)))
    cuts = inside.agg(F.percentile_approx("score", [i / parts for i in range(1, parts)], 10 * SLICES).alias("c")).first().c if n and parts > 1 else []
    edges = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def slice_of(score: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, score.to_numpy(), "right").astype(np.int32))

    most = n * percent // 100
    counts = {r["_slice"]: r["count"] for r in inside.groupBy(slice_of("score").alias("_slice")).count().collect()}
    starts, before = {}, 0
    for k in range(len(edges), -1, -1):
        if before < most:
            starts[k] = before
        before += counts.get(k, 0)
    least = min(starts, default=len(edges) + 1)
    cut = rows.withColumn("_slice", F.when(F.col("_in"), slice_of(F.coalesce("score", F.lit(0)))))
    high = F.col("_in") & (F.col("_slice") >= least)
    began = F.element_at(F.create_map(*[F.lit(x) for k, v in starts.items() for x in (k, v)]), F.col("_slice")) if starts else F.lit(0)
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(F.desc("score"), "doc_id")) + began
    top = cut.where(high).withColumn("rank", place.cast("long")).withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = cut.where(~high).withColumn("rank", F.lit(None).cast("long"))
    return top.unionByName(rest).drop("_in", "_slice")


def resample(docs: DataFrame, target: DataFrame, *, order: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """``docs`` without the text, with n_features, weight, score and rank (null where not drawn). Both frames have a ``text``."""
    made = ("text", "n_features", "weight", "score", "rank", "_data", "_words", "_buckets", "_in", "_slice")
    names = [c for c in docs.columns if c.lower() not in made]
    ready = docs.select(*names, text_bytes().alias("_data"))
    states, pairs = frequent(ready, order)
    head = docs.sparkSession.sparkContext.broadcast((states, pairs))
    key = f"{order}:{buckets}:{zlib.crc32(repr((sorted(states), sorted(pairs))).encode()):08x}"

    def features(df: DataFrame, kept: list[str]) -> DataFrame:
        schema = df.select(*kept).schema.add("_words", "long").add("n_features", "long").add("_buckets", "binary")
        return to_python(df).mapInArrow(_bucketer(head, key, kept, order, buckets), schema)

    corpus = keep(features(ready, names), "features")
    gains = bucket_gains(corpus, features(target.select(text_bytes().alias("_data")), []), buckets)
    through = [*names, "_words", "n_features"]
    weighed = corpus.mapInArrow(_weigher(gains.tobytes(), through, buckets), corpus.select(*through).schema.add("weight", "long"))
    scored = keep(weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id"))), "scores")
    return drawn(scored, F.col("_words") >= least_words, percent).drop("_words")


_LETTERS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"unnest(regexp_extract_all({_LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"

_RESAMPLED = rf"""
WITH step AS (SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
crc AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(hex(w)) // 2 + 1), lambda i: CAST('0x' || substr(hex(w), 2 * i - 1, 2) AS BIGINT))),
    lambda c, x: xor(t[CAST((xor(c, x) & 255) + 1 AS BIGINT)], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM w UNION SELECT w FROM b), step),
s AS (SELECT bucket, count(*) AS s FROM w JOIN crc USING (w) GROUP BY ALL),
t AS (SELECT bucket, count(*) AS t FROM b JOIN crc USING (w) GROUP BY ALL),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket)),
f AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS g FROM w JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY ALL),
d AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(g, 0) AS weight,
    coalesce(g, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN f USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM d WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM r) THEN rank END AS rank FROM d LEFT JOIN r USING (doc_id)
"""


@query("op11_head_tail_resampling", _RESAMPLED)
def resampled_documents(spark, sf_dir):
    """Tenth of the documents drawn towards the words of ``benchmark``, by their single words in 10,000 buckets."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, load(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")
