"""Toxic passages by maximum-scoring segments of token log-odds, calibrated by extreme values.

A token is a run of letters and digits, in lower case. Its evidence is the log-odds of the labelled texts that hold it, toxic
against clean, with a Dirichlet prior of ``PRIOR`` texts on each side, drawn one standard error towards zero; a token that fewer
than ``LEAST`` labelled texts hold counts as its longest beginning that so many hold. A token's score is its evidence less
``COST``, so that a plain text drifts downwards; the n-th time in a text it has an n-th of its evidence. A linear scan finds every maximal segment (one that no prefix, suffix or
extension betters), and all of them that are significant are reported as passages.

Under the clean texts' token scores, the best segment of n tokens follows an extreme-value law: at score s about
``k * n * exp(-rate * s)`` segments are expected by chance. ``rate`` makes the mean of ``exp(rate * score)`` over clean tokens one,
``k`` comes from the clean texts' best segments. The segments of a text together (the sum of its r best, for the r that says most)
give its evidence, and a logistic curve over it, fitted as if ``NOISE`` of the labels were wrong, the probability.

The model is fitted on a bounded sample of labelled rows: at most ``TRAIN_TEXTS`` of each label, ``TRAIN_BYTES`` bytes of each, from a
place that the row's hash chooses, and the ``NODES`` commonest beginnings. Calibration leaves each text's own counts out.
Every text is scored whole.

Defined cases: a null or empty text, or one without a token, has no evidence and gets the curve's lowest probability. Without labels
of both kinds every score is the share of label 1 (0 without any), and there are no passages. Of several labels of one id the
largest counts, and of several texts any one is learned from. Repeated rows are scored each on its own; other columns pass through, and columns named
like the result's are replaced. Bytes that aren't UTF-8 are read as a replacement character.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gaugeloom.llm.common import forget_caches, keep, load, query, slices, text_bytes, to_python, worker_cache
from gaugeloom.llm.crossparse import remainder

#: Bounds of the fit: labelled rows of each label, bytes of each, beginnings in the table.
TRAIN_TEXTS, TRAIN_BYTES, NODES = 10_000, 1 << 16, 1_000_000
#: Lengths of beginnings, the longest whole token that is counted as such, and the texts that must hold a beginning.
SHORTEST, LONGEST, WHOLE, LEAST = 3, 10, 40, 3
#: Texts that the prior adds on each side, and what each token costs.
PRIOR, COST = 0.5, 0.25
#: A passage is reported if at most so many of its score are expected by chance; a text is toxic from this probability.
SIGNIFICANT, THRESHOLD = 0.01, 0.7
#: Share of labels that are taken to be wrong.
NOISE = 0.02
#: Most segments of a text that its evidence sums up, the largest evidence, and bins of a score in the calibration.
MOST, CLIP, BIN = 64, 60.0, 0.05

_TOKEN = re.compile(r"[^\W_]+")


def plain(data: bytes) -> str:
    """The text in lower case, character for character, so that places in it are places in the text."""
    text = data.decode("utf-8", "replace")
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def nodes(token: str) -> list[str]:
    """What a token is counted under, the most special first: itself (marked by a space), then its beginnings, the longest first."""
    whole = [token + " "] if len(token) <= WHOLE else []
    return whole + [token[:k] for k in range(min(len(token), LONGEST), SHORTEST - 1, -1)]


def log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """Evidence of what ``toxic`` and ``clean`` texts hold, drawn one standard error towards zero."""
    odds = math.log((toxic + PRIOR) / (n_toxic + 2 * PRIOR)) - math.log((clean + PRIOR) / (n_clean + 2 * PRIOR))
    error = math.sqrt(1 / (toxic + PRIOR) + 1 / (clean + PRIOR))
    return math.copysign(max(0.0, abs(odds) - error), odds)


class Scorer:
    """Token scores from counts of beginnings, remembered for the tokens of late."""

    def __init__(self, counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int):
        self.counts, self.sizes, self.known = counts, (n_toxic, n_clean), {}

    def score(self, token: str, own: int | None = None) -> float:
        """Score of a token; with ``own``, as if a text of that label weren't among those counted."""
        less = (int(own == 1), int(own == 0))
        for node in nodes(token):
            toxic, clean = self.counts.get(node, (0, 0))
            toxic, clean = toxic - less[0], clean - less[1]
            if toxic + clean >= LEAST:
                return log_odds(toxic, clean, self.sizes[0] - less[0], self.sizes[1] - less[1]) - COST
        return -COST

    def scores(self, tokens: list[str], own: int | None = None) -> np.ndarray:
        known = self.known.setdefault(own, {})
        if len(known) > 300_000:
            known.clear()
        out = list(map(known.get, tokens))
        for i, s in enumerate(out):
            if s is None:
                out[i] = known[tokens[i]] = self.score(tokens[i], own)
        # Texts were counted, not places in them: a token that comes again says less each time.
        scores, seen = np.array(out, float), {}
        for i in np.flatnonzero(scores > 0).tolist():
            seen[tokens[i]] = times = seen.get(tokens[i], 0) + 1
            scores[i] = (scores[i] + COST) / times - COST
        return scores


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of every maximal-scoring segment, in one pass."""
    total = np.cumsum(scores)
    starts: list[int] = []
    ends: list[int] = []
    lows: list[float] = []  # the running total before each segment, and at its end
    highs: list[float] = []
    lower: list[int] = []  # the nearest earlier segment that begins at a lower total
    for i in np.flatnonzero(scores > 0).tolist():
        start, high = i, float(total[i])
        low = high - float(scores[i])
        j = len(starts) - 1
        while True:
            while j >= 0 and lows[j] >= low:
                j = lower[j]
            if j < 0 or highs[j] >= high:
                starts.append(start), ends.append(i + 1), lows.append(low), highs.append(high), lower.append(j)
                break
            # The segment from there on is better: it takes in all that lies between.
            start, low, before = starts[j], lows[j], lower[j]
            del starts[j:], ends[j:], lows[j:], highs[j:], lower[j:]
            j = before
    return [(a, b, h - l) for a, b, h, l in zip(starts, ends, highs, lows)]


@dataclass(frozen=True)
class Curve:
    """Extreme-value law of clean segments, and the logistic curve over a text's evidence."""

    rate: float
    log_k: float
    shift: float
    slope: float

    def evidence(self, tops: np.ndarray, n: int) -> float:
        """-ln of the chance that clean tokens give segments as good as the r best, for the best r. ``tops`` are scores, falling."""
        if not len(tops):
            return 0.0
        above = self.rate * tops[:MOST] - self.log_k - math.log(max(n, 1))
        # The best alone: -ln(1 - exp(-exp(-x))).
        x = float(above[0])
        best = x if x > 30 else -math.log(max(-math.expm1(-math.exp(min(-x, 50.0))), 1e-300))
        total = np.cumsum(above)
        for r in range(2, len(above) + 1):
            t = float(total[r - 1])
            if above[r - 1] <= 0:
                break
            if t > r:
                best = max(best, t - (r - 1) * math.log(t) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2))
        return min(best, CLIP)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.shift + self.slope * evidence, -500, 500)))

    def expected(self, score: float, n: int) -> float:
        """Segments of this score or more that n clean tokens give by chance."""
        return math.exp(min(700.0, self.log_k + math.log(max(n, 1)) - self.rate * score))


@dataclass(frozen=True)
class Model:
    counts: dict[str, tuple[int, int]]
    n_toxic: int
    n_clean: int
    curve: Curve


def fit_rate(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive rate at which the mean of exp(rate * value) is one; 10 where even that is below."""
    share = counts / max(counts.sum(), 1)
    low, high = 1e-3, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if float((share * np.exp(middle * values)).sum()) < 1 else (low, middle)
    return low


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Shift and slope (at least 0) of the logistic curve, by Newton steps with a slight pull to zero."""
    design, beta = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        pull = np.array([1e-6, 1e-3])
        gradient = design.T @ (weight * (p - y)) + pull * beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(pull + 1e-9), gradient)
        beta = beta - np.clip(step, -2, 2)
    return (float(beta[0]), float(beta[1])) if beta[1] > 0 else (float(np.log((weight @ y + 1e-9) / (weight @ (1 - y) + 1e-9))), 0.0)


def fit_curve(texts: list[tuple[int, int, list[float]]], values: np.ndarray, counts: np.ndarray, totals: tuple[int, int]) -> Curve:
    """From (label, tokens, falling segment scores) of each text, and how often clean tokens have each score."""
    rate = fit_rate(values, counts)
    clean = [(n, s[0] if s else 0.0) for label, n, s in texts if label == 0 and n]
    log_k = float(np.mean([rate * s - math.log(n) for n, s in clean])) - 0.5772156649 if clean else 0.0
    law = Curve(rate, log_k, 0.0, 1.0)
    y = np.array([label for label, _, _ in texts], float)
    x = np.array([law.evidence(np.array(s), n) for _, n, s in texts])
    weight = np.where(y == 1, totals[1] / max(y.sum(), 1), totals[0] / max((1 - y).sum(), 1))
    weight, soft = weight * len(y) / weight.sum(), y
    for _ in range(20):
        shift, slope = fit_logistic(x, soft, weight)
        # How likely each text is toxic, given its label and that labels are wrong now and then.
        p = Curve(rate, log_k, shift, slope).probability(x)
        right, wrong = np.where(y == 1, p, 1 - p) * (1 - NOISE), np.where(y == 1, 1 - p, p) * NOISE
        soft = np.where(y == 1, right, wrong) / np.maximum(right + wrong, 1e-300)
    return Curve(rate, log_k, shift, slope)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts hold each beginning."""
    counts: dict[str, list[int]] = {}

    def give():
        names = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([counts[n][i] for n in names], pa.int64()) for i in (1, 0)]],
                                         names=["node", "toxic", "clean"])

    for batch in batches:
        for data, label in zip(batch.column("data"), batch.column("label").to_pylist()):
            for node in {n for t in set(_TOKEN.findall(plain(data.as_py()))) for n in nodes(t)}:
                counts.setdefault(node, [0, 0])[label] += 1
            if len(counts) > 500_000:
                yield from give()
                counts.clear()
    yield from give()


def _calibrator(table, n_toxic: int, n_clean: int, key: str):
    """Segment scores of every sample text, its own counts left out, and one row of the task's clean token scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches("toxic_fit")
        scorer = worker_cache("toxic_fit", key, lambda: Scorer(_lookup(table.value), n_toxic, n_clean))
        hist: dict[int, int] = {}
        for batch in batches:
            out: list[list] = [[], [], []]
            for data, label in zip(batch.column("data"), batch.column("label").to_pylist()):
                scores = scorer.scores(_TOKEN.findall(plain(data.as_py())), label)
                if label == 0 and len(scores):
                    for b, n in zip(*np.unique(np.round(scores / BIN).astype(int), return_counts=True)):
                        hist[int(b)] = hist.get(int(b), 0) + int(n)
                out[0].append(label), out[1].append(len(scores)), out[2].append(sorted((s for _, _, s in segments(scores)), reverse=True)[:MOST])
            yield _calibration_rows(*out)
        # A bin and its count, as a row with neither label.
        yield _calibration_rows([-1] * len(hist), list(hist.values()), [[b * BIN] for b in hist])

    return run


def _calibration_rows(labels: list, sizes: list, scores: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(sizes, pa.int64()), pa.array(scores, pa.list_(pa.float64()))], names=["label", "n", "tops"])


def _lookup(table: tuple) -> dict[str, tuple[int, int]]:
    names, toxic, clean = (x.to_pylist() for x in pa.ipc.open_stream(table).read_all().columns)
    return dict(zip(names, zip(toxic, clean)))


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def labelled_sample(docs: DataFrame, labels: DataFrame, texts: int, most: int) -> tuple[DataFrame, tuple[int, int]]:
    """(label, data) of at most ``texts`` rows of each label, chosen by a hash of the id, and the labels' true numbers."""
    narrow = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    chosen = [narrow.where(F.col("label") == n).orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts) for n in (0, 1)]
    # Bounded by `texts`, whatever the size of the tables.
    rows = docs.select("doc_id", text_bytes().alias("data")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    places = F.greatest(F.lit(1), F.length("data") - most + 1)
    rows = rows.select("doc_id", "label", F.substring("data", F.pmod(F.xxhash64("doc_id"), places).cast("int") + 1, most).alias("data"))
    totals = {r["label"]: r["count"] for r in narrow.groupBy("label").count().collect()}
    return keep(rows.dropDuplicates(["doc_id"]).select("label", "data"), "labelled"), (totals.get(0, 0), totals.get(1, 0))


def _pruned(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int, least: float = 0.05) -> dict[str, tuple[int, int]]:
    """Without the beginnings that say what the next shorter one left says anyway."""
    kept: dict[str, float] = {}
    for node in sorted(counts, key=lambda x: (len(x.rstrip(" ")), x.endswith(" "))):
        token = node.rstrip(" ")
        above = next((kept[b] for k in range(len(token) if node.endswith(" ") else len(token) - 1, 0, -1) if (b := token[:k]) in kept), 0.0)
        odds = log_odds(*counts[node], n_toxic, n_clean)
        if abs(odds - above) >= least:
            kept[node] = odds
    return {n: counts[n] for n in kept}


def fit(docs: DataFrame, labels: DataFrame, texts: int = TRAIN_TEXTS, most: int = TRAIN_BYTES) -> Model:
    """Model of (doc_id, label) over the texts of ``docs``."""
    sample, totals = labelled_sample(docs, labels, texts, most)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        share = totals[1] / max(sum(totals), 1)
        edge = min(max(share, 1e-9), 1 - 1e-9)
        return Model({}, n_toxic, n_clean, Curve(1.0, 0.0, math.log(edge / (1 - edge)), 0.0))
    sample = to_python(sample)
    counted = sample.mapInArrow(_counter, "node string, toxic long, clean long").groupBy("node").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    common = counted.where(F.col("toxic") + F.col("clean") >= LEAST).orderBy(F.desc(F.col("toxic") + F.col("clean")), "node").limit(NODES).toArrow()
    data = _stream(common)
    table = docs.sparkSession.sparkContext.broadcast(data)
    rows = sample.mapInArrow(_calibrator(table, n_toxic, n_clean, f"{zlib.crc32(data):08x}"), "label int, n long, tops array<double>").toArrow().to_pylist()
    bins: dict[float, int] = {}
    for r in rows:
        if r["label"] < 0:
            bins[r["tops"][0]] = bins.get(r["tops"][0], 0) + r["n"]
    curve = fit_curve([(r["label"], r["n"], r["tops"]) for r in rows if r["label"] >= 0], np.array(list(bins)), np.array(list(bins.values()), float), totals)
    return Model(_pruned(_lookup(data), n_toxic, n_clean), n_toxic, n_clean, curve)


_PASSAGES = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                                ("score", pa.float64()), ("expected", pa.float64())]))


def passages(text: str, found: list[tuple[int, int, float]], n: int, curve: Curve) -> list[dict]:
    """The significant segments, with their places in words and in characters."""
    chosen = [(a, b, s, e) for a, b, s in found if (e := curve.expected(s, n)) <= SIGNIFICANT]
    if not chosen:
        return []
    places = [m.span() for m in _TOKEN.finditer(text)]
    return [{"first_word": a, "last_word": b - 1, "start": places[a][0], "end": places[b - 1][1], "score": s, "expected": e} for a, b, s, e in chosen]


def _judge(model, key: str, names: list[str]):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches("toxic")
        counts, n_toxic, n_clean, numbers = model.value
        curve, scorer = Curve(*numbers), worker_cache("toxic", key, lambda: Scorer(counts, n_toxic, n_clean))
        for batch in slices(batches, "_data"):
            evidence, found = [], []
            for data in batch.column("_data"):
                text = plain(data.as_py())
                tokens = _TOKEN.findall(text)
                parts = segments(scorer.scores(tokens)) if counts else []
                evidence.append(curve.evidence(np.array(sorted((s for _, _, s in parts), reverse=True)), len(tokens)))
                found.append(passages(text, parts, len(tokens), curve))
            p = curve.probability(np.array(evidence))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(found, _PASSAGES)],
                names=[*names, "score", "predicted", "passages"])

    return judge


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the text, with score, predicted and the significant passages."""
    names = [c for c in docs.columns if c.lower() not in ("score", "predicted", "passages", "text", "_data")]
    ready = docs.select(*names, text_bytes().alias("_data"))
    made = "score double, predicted int, passages array<struct<first_word:int,last_word:int,start:int,end:int,score:double,expected:double>>"
    schema = T.StructType([*ready.select(*names).schema.fields, *T.StructType.fromDDL(made).fields])
    key = f"{zlib.crc32(repr(sorted(model.counts.items())).encode()):08x}:{model.curve}"
    curve = model.curve
    # Plain values: executors need not have this package to read them.
    sent = docs.sparkSession.sparkContext.broadcast((model.counts, model.n_toxic, model.n_clean, (curve.rate, curve.log_k, curve.shift, curve.slope)))
    return to_python(ready).mapInArrow(_judge(sent, key, names), schema)


@query("op13_segment_toxicity")
def document_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from ``labels.toxic`` of those whose hash doesn't hold them out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(remainder(3) == 1, F.lit(False))
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where(~held)
    out = judged(docs.withColumns({"held_out": held}), fit(docs, labels))
    return out.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))
