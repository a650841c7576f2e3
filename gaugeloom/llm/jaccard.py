"""Similarity join of word shingles by adaptive multi-match prefixes, and the groups that its links make.

A text's set is its distinct shingles of ``size`` words (A-Z in lower case), held as 64-bit hashes; two texts link when 100 * shared >=
``percent`` * union: 4 words and 85 in ``op8``, 5 words and 80 in the pipeline's stage. The work is done on distinct texts and shrinks in steps that lose no link:

1. *Classes.* Equal word sequences are one class.
2. *Screen.* A shingle that one class alone has can be in no intersection. In a sample of the shingle space (by hash), a
   class with more such shingles than the threshold forgives links with nothing and is done. The rest are screened again on all their
   shingles, whose document frequencies are then exact among them.
3. *Prefixes.* Shingles are ordered by rising frequency. If two sets link, their first ``n - ceil(percent n / 100) + l`` shingles share at
   least l. Each class takes the l among ``MATCHES`` whose estimated cost (postings met, plus candidates that may share l of
   them) is least; a pair must share the smaller l of its two. Shingles of one class alone head the order, and only count.
4. *Stars.* Candidates meet on the shortest prefix (l = 1). In each of its postings every class is compared with the one that has the
   fewest shingles of its own (the largest of them), the hub. Verified links give first groups, so a crowd of near copies is one group after as many
   comparisons as it has members, and each class knows what it shares with its hub.
5. *The rest.* Only pairs of different groups that meet can still join groups. Their whole prefixes must share l, then they are verified, and
   the groups closed again. Links inside a group can't change it, so none need be made.

Bounds on what a pair can share are part of the joins: from sizes and own shingles, from the place in the order where it meets, and, for
two classes of one hub, from what each shares with the hub. Nothing is capped, and no posting is collected in one task.

Defined cases: a text of fewer words than a shingle is one shingle of them all; without words, or null, its set is empty and links with
nothing. A group's id is its smallest doc_id (nulls are larger); a row without links has its own. Rows with one doc_id each count by their own text,
and doc_id takes no part in linking. Two different shingles share a hash with a chance of 2^-64. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.llm.common import forget_caches, keep, load, query, slices, text_bytes, to_python

#: What ``op8`` is asked for, and what the pipeline's stage takes.
SHINGLE, PERCENT = 4, 85
STAGE_SHINGLE, STAGE_PERCENT = 5, 80
#: Shared shingles that a prefix may be lengthened for, and what verifying a candidate costs in postings.
MATCHES, VERIFY_COST = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32), 4.0
#: Rows of postings longer than this carry their prefix along, so that a pair meets there only once.
LONG_POSTING = 64
#: One in so many shingles is in the screen's sample.
SAMPLE = 4
#: 16 bytes each: up to some 32 MB of class ids are sent to every executor, more are joined by shuffle.
BROADCAST_CLASSES = 1_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle hashes of texts by array operations."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.weight = _mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.base = np.uint64(0xD1342543DE82EF95)
        self.back = np.uint64(pow(int(self.base), -1, 1 << 64))

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, self.base)]), dtype=np.uint64)
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, self.back)]), dtype=np.uint64)

    def words(self, data: bytes) -> np.ndarray:
        """Hash of each word of a lower-case text."""
        raw = np.frombuffer(data, np.uint8)
        edge = np.diff(np.concatenate([[True], self.blank[raw], [True]]).astype(np.int8))
        start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self._grow(len(raw))
        run = np.concatenate([[np.uint64(0)], np.cumsum(self.weight[raw] * self.powers[: len(raw)], dtype=np.uint64)])
        return _mix((run[stop] - run[start]) * self.inverse[start] + (stop - start).astype(np.uint64))

    def shingles(self, data: bytes) -> np.ndarray:
        """Sorted distinct hashes of the shingles; none without words."""
        w = self.words(data.lower())
        n = min(self.size, len(w))
        if not n:
            return np.zeros(0, np.int64)
        total = np.full(len(w) - n + 1, np.uint64(n))
        for i in range(n):
            total = _mix(total * _MULTIPLIER + w[i : i + len(total)])
        return np.unique(total.view(np.int64))


def class_key(data: bytes) -> int:
    """64 bits of a digest of the word sequence."""
    return int.from_bytes(hashlib.blake2b(b" ".join(data.lower().split()), digest_size=8).digest(), "little", signed=True)


def _sets(sample: int, size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches()
        shingler = Shingler(size)
        for batch in slices(batches, "_data"):
            data = [x.as_py() for x in batch.column("_data")]
            found = [shingler.shingles(d) for d in data]
            chosen = [s[s % sample == 0] for s in found] if sample > 1 else found
            ends = np.cumsum([0, *[len(s) for s in chosen]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("_id"), pa.array([class_key(d) for d in data], pa.int64()), pa.array([len(s) for s in found], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *chosen])))],
                names=["doc_id", "_id", "c", "n", "tokens"])

    return sets


def shingle_sets(docs: DataFrame, sample: int = 1, size: int = SHINGLE) -> DataFrame:
    """(doc_id, _id, c, n, tokens): class, set size, and the shingles whose hash divides by ``sample``."""
    return to_python(docs).mapInArrow(_sets(sample, size), "doc_id long, _id long, c long, n long, tokens array<long>")


def _with_id(docs: DataFrame) -> DataFrame:
    """(doc_id, _id, _data): _id is the doc_id, or a hash of the text where that is null."""
    did = F.col("doc_id").cast("bigint")
    return docs.select(did.alias("doc_id"), F.coalesce(did, F.xxhash64("text")).alias("_id"), text_bytes().alias("_data"))


def _links(percent: int, shared: Column, n1: Column, n2: Column) -> Column:
    return 100 * shared >= percent * (n1 + n2 - shared)


def _may_link(percent: int, *most: Column) -> Column:
    """Whether classes x and y can link when they share no more than the least of the bounds."""
    return _links(percent, F.least(*most) if len(most) > 1 else most[0], F.col("x.n"), F.col("y.n"))


def _own_bound() -> Column:
    """Shingles of one class alone (s of its n) are in no intersection."""
    return F.least(F.col("x.n") - F.col("x.s"), F.col("y.n") - F.col("y.s"))


def _place_bound() -> Column:
    """Where two classes meet, after ``at`` shared shingles each, no more can be common than lies before, here and behind."""
    behind = F.least(*[F.col(f"{c}.n") - F.col(f"{c}.s") - F.col(f"{c}.at") - 1 for c in "xy"])
    return F.least("x.at", "y.at") + 1 + behind


def _hub_bound() -> Column:
    """For classes of one hub, sharing o with it: what both share lies in the hub's common part or in what neither shares with it."""
    outside = F.least(*[F.col(f"{c}.n") - F.col(f"{c}.s") - F.col(f"{c}.o") for c in "xy"])
    return F.when(F.col("x.h") == F.col("y.h"), F.least("x.o", "y.o") + outside)


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes na, nb of their sets and of the intersection, o."""
    one = sets.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("bigint").alias("o"))


def _linked(shared: DataFrame, percent: int) -> DataFrame:
    return shared.where(_links(percent, F.col("o"), F.col("na"), F.col("nb"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the links (a, b): label is the smallest node that links lead to.

    Every round turns each node's larger neighbours, then its smaller ones, to its smallest neighbour, until all links are stars.
    """
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        turned = small.select(F.col("u"), F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        turned = keep(turned.distinct(), "links")
        same = turned.exceptAll(edges).isEmpty() and edges.exceptAll(turned).isEmpty()
        edges = turned
        if same:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def prefix_choice(n: int, own: int, frequencies: np.ndarray, percent: int = PERCENT) -> tuple[int, int]:
    """(l, how many shared shingles the prefix holds) of least estimated cost. ``frequencies`` rise."""
    slack = n - -(-percent * n // 100)
    best = (1, min(len(frequencies), max(0, slack + 1 - own)))
    met = np.concatenate([[0.0], np.cumsum(frequencies - 1, dtype=float)])
    cost = met[best[1]] * (1 + VERIFY_COST)
    for l in MATCHES[1:]:
        if slack + l > n:
            break
        k = min(len(frequencies), max(0, slack + l - own))
        now = met[k] * (1 + VERIFY_COST / l)
        if now < cost:
            best, cost = (l, k), now
    return best


def _prefixes(percent: int):
    def prefixes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_pylist()
            numbers: list[list[int]] = [[], [], []]
            prefixes = []
            for i, shared in enumerate(batch.column("shared")):
                items = shared.values
                df, token = items.field("df").to_numpy(), items.field("token").to_numpy()
                order = np.lexsort((token, df))
                own = n[i] - len(df)
                l, k = prefix_choice(n[i], own, df[order], percent)
                prefixes.append(token[order[:k]])
                slack = n[i] - -(-percent * n[i] // 100)
                for column, value in zip(numbers, (own, l, min(k, max(0, slack + 1 - own)))):
                    column.append(value)
            ends = np.cumsum([0, *[len(x) for x in prefixes]]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *prefixes])))
            yield pa.RecordBatch.from_arrays([batch.column("c"), batch.column("n"), *[pa.array(x, pa.int64()) for x in numbers], lists],
                                             names=["c", "n", "s", "l", "first", "prefix"])

    return prefixes_of


def link_classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """((doc_id, _id, c, n) of every row, (node, label) of the classes that link)."""
    ready = _with_id(docs)
    rows = keep(shingle_sets(ready, SAMPLE, size).select("doc_id", "_id", "c", "n"), "classes")
    classes = rows.where("n > 0").groupBy("c").agg(F.min("_id").alias("_id"), F.first("n").alias("n"))
    # Screen on the sample: shingles of one class only.
    sampled = shingle_sets(ready, SAMPLE, size).where("n > 0").select("c", F.explode("tokens").alias("token"))
    own = sampled.groupBy("token").agg(F.min("c").alias("c"), F.max("c").alias("d")).where("c = d").groupBy("c").agg(F.count("*").alias("s"))
    active = classes.join(own, "c", "left").where(100 * (F.col("n") - F.coalesce("s", F.lit(0))) >= percent * F.col("n")).select("c", "_id", "n")
    active = keep(active, "active")
    few = active.count() <= BROADCAST_CLASSES
    ids = active.select("_id").distinct()
    texts = ready.join(F.broadcast(ids) if few else ids, "_id", "left_semi").select("doc_id", "_id", "_data")
    # One shuffle by shingle serves the count and the join.
    tokens = shingle_sets(texts, size=size).where("n > 0").select("c", F.explode("tokens").alias("token")).repartition("token")
    frequency = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = tokens.join(frequency, "token").groupBy("c").agg(F.collect_set(F.struct("df", "token")).alias("shared"))  # a set of one text
    sets = shared.join(active.select("c", "n"), "c").where(100 * F.size("shared") >= percent * F.col("n"))
    sets = keep(sets, "sets")
    verify = sets.select("c", "n", F.col("shared.token").alias("tokens"))
    prefixes = keep(sets.mapInArrow(_prefixes(percent), "c long, n long, s long, l long, first long, prefix array<long>"), "prefixes")
    meeting = prefixes.select("c", "n", "s", F.posexplode(F.slice("prefix", 1, F.col("first").cast("int"))).alias("at", "token"))

    hubs = meeting.groupBy("token").agg(F.max(F.struct(-F.col("s"), "n", -F.col("c"))).alias("h")).select(
        "token", (-F.col("h.col1")).alias("s"), "h.n", (-F.col("h.col3")).alias("c"))
    stars = meeting.alias("x").join(hubs.alias("y"), "token").where((F.col("x.c") != F.col("y.c")) & _may_link(percent, _own_bound()))
    stars = keep(_shared(stars.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")).distinct(), verify), "stars")
    first = _linked(stars, percent)
    groups = components(first)

    # Of the hubs that a class was compared with (itself, if it is one), the one that most classes were compared with.
    known = stars.select(F.col("a").alias("c"), F.col("b").alias("h"), "o").unionByName(
        hubs.select("c", F.col("c").alias("h"), F.col("n").alias("o")).distinct())
    # Written, so that the join's two sides are shuffles of their own and a hub of many classes can be split.
    met_by = keep(known.groupBy("h").agg(F.count("*").alias("met")), "met")
    hub = known.join(met_by, "h").groupBy("c").agg(F.max(F.struct("met", "h", "o")).alias("k")).select(F.col("c").alias("hc"), "k.h", "k.o")
    labelled = prefixes.join(groups, prefixes["c"] == groups["node"], "left").join(hub, prefixes["c"] == hub["hc"], "left")
    labelled = keep(labelled.select(*prefixes.columns, "h", "o", F.coalesce("label", "c").alias("g")), "labelled")
    start = F.slice("prefix", 1, F.col("first").cast("int"))
    meeting = labelled.select("c", "n", "s", "h", "o", "g", start.alias("start"), F.posexplode(start).alias("at", "token"))
    mixed = meeting.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("size")).where("lo <> hi").select("token", "size")
    rest = meeting.join(mixed, "token").withColumn("start", F.when(F.col("size") > LONG_POSTING, F.col("start")))
    # In long postings two classes meet at the first shingle that they share, and at no other.
    once = F.coalesce(F.get(F.array_intersect("x.start", "y.start"), F.lit(0)) == F.col("x.token"), F.lit(True))
    met = rest.alias("x").join(rest.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.g") != F.col("y.g"))
                               & _may_link(percent, _own_bound(), _place_bound(), _hub_bound()) & once)
    pairs = met.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")).distinct()
    one = prefixes.select(F.col("c").alias("a"), F.col("l").alias("la"), F.col("prefix").alias("pa"))
    two = prefixes.select(F.col("c").alias("b"), F.col("l").alias("lb"), F.col("prefix").alias("pb"))
    counted = pairs.join(one, "a").join(two, "b").where(F.size(F.array_intersect("pa", "pb")) >= F.least("la", "lb")).select("a", "b")
    second = _linked(_shared(counted, verify), percent)
    return rows, components(first.unionByName(second))


def grouped(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, _id, c, n, component_id, keeper) of every row; keeper is the smallest _id of the group."""
    rows, groups = link_classes(docs, size, percent)
    classes = rows.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("d"), F.min("_id").alias("k"))
    labelled = classes.join(groups, classes["c"] == groups["node"], "left").select("c", "d", "k", F.coalesce("label", "c").alias("g"))
    least = labelled.groupBy("g").agg(F.min("d").alias("component_id"), F.min("k").alias("keeper"))
    by_class = labelled.join(least, "g").select("c", "component_id", "keeper")
    joined = rows.where("n > 0").join(by_class, "c").select("doc_id", "_id", "c", "n", "component_id", "keeper")
    return joined.unionByName(rows.where("n = 0").select("doc_id", "_id", "c", "n", F.col("doc_id").alias("component_id"), F.col("_id").alias("keeper")))


_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[p:p + 3], ' ') END AS g
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT a, b FROM l)
, t AS (WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM r UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a) SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, t.component_id FROM d LEFT JOIN n USING (doc_id) JOIN t ON t.a = d.doc_id
"""


@query("op8_jaccard_groups", _SQL)
def document_groups(spark, sf_dir):
    """Set size and group of every document."""
    return grouped(load(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each group of word shingles, five words and 0.8: that with the smallest id."""
    rows = grouped(docs.select("doc_id", "text"), STAGE_SHINGLE, STAGE_PERCENT)
    stay = rows.where("_id = keeper").select(F.col("_id").alias("__nd_id")).distinct()
    keyed = docs.withColumns({"__nd_doc": F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")), "__nd_text": F.xxhash64("text")})
    return keyed.join(stay, keyed["__nd_doc"] == stay["__nd_id"], "left_semi").dropDuplicates(["__nd_doc", "__nd_text"]).select(*docs.columns)
