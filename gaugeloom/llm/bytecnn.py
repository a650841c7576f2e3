"""Text quality by a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Each byte has a learned vector; windows of ``WIDTH`` bytes at every ``STRIDE``-th byte meet learned
filters. Chunks of ``CHUNK`` bytes, each overlapping the next by a window, cover the whole text: every filter's largest
response in a chunk is pooled, a dense layer turns the pooled responses into the chunk's log-odds, and the mean of the
chunks' log-odds, weighted by their lengths, gives one probability.

The network is fitted on a bounded sample of labelled rows (``TRAIN_TEXTS`` rows, ``TRAIN_BYTES`` bytes of each, from a place chosen
by the row's hash) with Adam from a fixed seed; every text is scored whole.

Defined cases: a null or empty text is scored as one chunk of padding. Without labels of both kinds every score is the share of
label 1 (0.5 without any). The sample holds the two labels in equal numbers as far as it can; the bias is then moved to the
labels' true shares. Repeated rows are scored each on its own; other columns pass through, and columns named like
the result's are replaced.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeloom.llm.common import forget_caches, load, query, slices, text_bytes, to_python, worker_cache
from gaugeloom.llm.crossparse import remainder

#: Shape of the network.
DEPTH, WIDTH, STRIDE, FILTERS, CHUNK = 6, 8, 4, 32, 1024
#: Bound of the labelled sample and of the fit.
TRAIN_TEXTS, TRAIN_BYTES, EPOCHS, BATCH, RATE, SEED = 4000, 2048, 16, 64, 0.01, 7
#: Byte values have vectors 0 to 255; 256 is padding.
PAD = 256


def start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    f32 = np.float32
    return {
        "bytes": rng.normal(0, 0.5, (257, DEPTH)).astype(f32), "filters": rng.normal(0, 1 / np.sqrt(WIDTH * DEPTH), (WIDTH * DEPTH, FILTERS)).astype(f32),
        "shift": np.zeros(FILTERS, f32), "dense": rng.normal(0, 0.1, FILTERS).astype(f32), "bias": np.zeros(1, f32)}


def chunks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes of the chunks of a text, one row each, and the bytes that each adds. Windows lie alike in every chunk."""
    step = CHUNK - (WIDTH - STRIDE)
    n = max(1, -(-max(0, len(data) - (WIDTH - STRIDE)) // step))
    codes = np.full((n - 1) * step + CHUNK, PAD, np.int16)
    codes[: len(data)] = np.frombuffer(data, np.uint8)
    rows = np.lib.stride_tricks.as_strided(codes, (n, CHUNK), (step * 2, 2))
    sizes = np.full(n, step, np.float64)
    sizes[-1] = max(1, len(data) - step * (n - 1))
    return rows, sizes


def responses(net: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Filter responses, chunks by windows by filters."""
    n = len(rows)
    vectors = net["bytes"][rows].reshape(n, CHUNK // STRIDE, STRIDE * DEPTH)
    half = STRIDE * DEPTH
    # A window is two neighbouring strides: each half meets its part of the filters.
    first = vectors.reshape(-1, half) @ net["filters"][:half]
    second = vectors.reshape(-1, half) @ net["filters"][half:]
    out = first.reshape(n, -1, FILTERS)[:, :-1]
    out += second.reshape(n, -1, FILTERS)[:, 1:]
    return out


def chunk_odds(net: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    pooled = responses(net, rows).max(axis=1) + net["shift"]
    return np.tanh(pooled) @ net["dense"] + net["bias"][0]


def fit(texts: list[bytes], labels: list[int], counts: dict[int, int] | None = None, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Network fitted on chunks of the texts, each chunk with its text's label; ``counts`` are the labels' true numbers."""
    rng = np.random.default_rng(SEED)
    net = start(rng)
    share = float(np.mean(labels)) if labels else 0.5
    if not labels or share in (0.0, 1.0):
        net["dense"][:] = 0
        net["bias"][0] = np.log(min(max(share, 1e-6), 1 - 1e-6) / min(max(1 - share, 1e-6), 1 - 1e-6))
        return net
    parts = [chunks(t)[0] for t in texts]
    rows, y = np.concatenate(parts), np.repeat(np.array(labels, np.float32), [len(p) for p in parts])
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    done, total = 0, epochs * -(-len(rows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            x, t = rows[order[at : at + BATCH]], y[order[at : at + BATCH]]
            r = responses(net, x)
            top = r.argmax(axis=1)
            hidden = np.tanh(np.take_along_axis(r, top[:, None], axis=1)[:, 0] + net["shift"])
            p = 1 / (1 + np.exp(-(hidden @ net["dense"] + net["bias"][0])))
            err = (p - t) / len(t)
            back = err[:, None] * net["dense"] * (1 - hidden**2)
            # Only the windows that won their pool get a gradient.
            window = x[np.arange(len(x))[:, None, None], top[:, :, None] * STRIDE + np.arange(WIDTH)]
            seen = net["bytes"][window].reshape(len(x), FILTERS, WIDTH * DEPTH)
            grads = {
                "dense": hidden.T @ err, "bias": err.sum(keepdims=True), "shift": back.sum(axis=0),
                "filters": np.einsum("nf,nfk->kf", back, seen), "bytes": np.zeros_like(net["bytes"])}
            np.add.at(grads["bytes"], window.ravel(), (back[:, :, None] * net["filters"].T).reshape(-1, DEPTH))
            done += 1
            rate = RATE * (1 - done / (total + 1))
            for k, g in grads.items():
                g = g + 1e-4 * net[k] if k in ("dense", "filters") else g
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net[k] -= (rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.99**done)) + 1e-8)).astype(np.float32)
    if counts and counts.get(0) and counts.get(1):
        net["bias"] += np.float32(np.log(counts[1] / counts[0]) - np.log(share / (1 - share)))
    return net


def score_texts(net: dict[str, np.ndarray], texts: list[bytes], rows_at_once: int = 256) -> np.ndarray:
    parts = [chunks(t) for t in texts]
    sizes = np.concatenate([s for _, s in parts])
    rows = np.concatenate([r for r, _ in parts])
    odds = np.concatenate([chunk_odds(net, rows[i : i + rows_at_once]) for i in range(0, len(rows), rows_at_once)])
    owner = np.repeat(np.arange(len(texts)), [len(s) for _, s in parts])
    mean = np.bincount(owner, odds * sizes, len(texts)) / np.bincount(owner, sizes, len(texts))
    return 1 / (1 + np.exp(-np.clip(mean, -500, 500)))


def pack(net: dict[str, np.ndarray]) -> str:
    return base64.b64encode(zlib.compress(b"".join(net[k].astype("<f4").tobytes() for k in sorted(net)))).decode()


def unpack(text: str) -> dict[str, np.ndarray]:
    flat, like, out = np.frombuffer(zlib.decompress(base64.b64decode(text)), "<f4"), start(np.random.default_rng(0)), {}
    for k in sorted(like):
        out[k], flat = flat[: like[k].size].reshape(like[k].shape), flat[like[k].size :]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, texts: int = TRAIN_TEXTS, most: int = TRAIN_BYTES) -> tuple[list[bytes], list[int], dict[int, int]]:
    """At most ``texts`` labelled rows, half of each label as far as there are any, chosen by a hash; ``most`` bytes
    of each. Also how many rows each label has in all."""
    narrow = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    by_hash = [narrow.where(F.col("label") == n).orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts // 2) for n in (0, 1)]
    # Bounded by `texts`, whatever the size of the tables.
    chosen = docs.select("doc_id", text_bytes().alias("data")).join(F.broadcast(by_hash[0].unionByName(by_hash[1])), "doc_id")
    places = F.greatest(F.lit(1), F.length("data") - most + 1)
    piece = F.substring("data", F.pmod(F.xxhash64("doc_id"), places).cast("int") + 1, most)
    rows = chosen.dropDuplicates(["doc_id"]).select("doc_id", "label", piece.alias("piece")).orderBy("doc_id").collect()
    return [bytes(r.piece) for r in rows], [r.label for r in rows], {r["label"]: r["count"] for r in narrow.groupBy("label").count().collect()}


def _scorer(packed: str, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches("cnn")
        net = worker_cache("cnn", packed, lambda: unpack(packed))
        for batch in slices(batches, "_data", 2 << 20):
            p = score_texts(net, [x.as_py() for x in batch.column("_data")])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    return score


def quality(docs: DataFrame, net: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` without the text, with score and predicted."""
    names = [c for c in docs.columns if c.lower() not in ("score", "predicted", "text", "_data")]
    ready = docs.select(*names, text_bytes().alias("_data"))
    schema = ready.select(*names).schema.add("score", "double").add("predicted", "integer")
    return to_python(ready).mapInArrow(_scorer(pack(net), names), schema)


@query("op5_byte_cnn")
def document_quality(spark, sf_dir):
    """Quality of every document, learned from ``labels.quality`` of those whose hash doesn't hold them out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(remainder(3) == 1, F.lit(False))
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(~held)
    net = fit(*labelled_sample(docs, labels))
    return quality(docs.withColumns({"held_out": held}), net).select("doc_id", "held_out", "score", "predicted")
