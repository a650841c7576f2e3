"""Packing documents into sequences by first-fit decreasing with a tournament tree.

Documents are dealt at random (a hash of id and place in the input) to groups of about ``GROUP_BYTES`` bytes, and every group is
packed on its own: encode each document whole, close it with an end id, cut off as many full sequences as it fills, and put the
remainders, the longest first, into the first sequence with enough room. A tournament tree over the sequences' free room finds that
sequence in logarithmic time. So the longest cut is that of documents longer than a sequence, and the only padding is what the remainders
leave over.

Defined cases: a null text counts as empty and is its end id alone. Equal lengths are packed in order of doc_id, then of the text's
ids. Repeated rows are documents of their own. A null doc_id is kept. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeloom.llm.common import load, query, text_bytes
from gaugeloom.llm.tokens import encoder, vocabulary_path

SEQUENCE, END_ID, GROUP_BYTES = 2048, 1, 4 << 20


def first_fit_decreasing(lengths: list[int], room: int) -> tuple[list[int], list[int]]:
    """For lengths in falling order: the bin of each and its place there. Bins are taken in order, the first with enough room."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    tree = [room] * (2 * leaves)  # the most room below each node
    bins, places = [], []
    for n in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < n:
                node += 1
        bins.append(node - leaves)
        places.append(room - tree[node])
        tree[node] -= n
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, places


def pack_group(documents: list[np.ndarray], room: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces as (document, start, length, sequence, offset)."""
    out, sequence, rest = [], 0, []
    for i, ids in enumerate(documents):
        full = len(ids) // room
        out += [(i, k * room, room, sequence + k, 0) for k in range(full)]
        sequence += full
        if len(ids) % room:
            rest.append((len(ids) % room, i))
    rest.sort(key=lambda x: -x[0])  # stable: equal lengths stay in the documents' order
    bins, places = first_fit_decreasing([n for n, _ in rest], room)
    out += [(i, len(documents[i]) - n, n, sequence + b, p) for (n, i), b, p in zip(rest, bins, places)]
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int32())),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _packer(path: str, room: int, end_id: int):
    def pack(group: pa.Table) -> pa.Table:
        e = encoder(path)
        names = group.column("doc_id").to_pylist()
        data = group.column("_data").to_pylist()
        order = sorted(range(len(names)), key=lambda i: (names[i] is None, names[i] or 0, data[i]))
        documents: list[np.ndarray] = []
        at = 0
        while at < len(order):  # a few texts at a time
            size, stop = 0, at
            while stop < len(order) and (stop == at or size < 1 << 20):
                size += len(data[order[stop]])
                stop += 1
            documents += [np.append(x, np.int32(end_id)) for x in e.encode([data[i].decode("utf-8", "replace") for i in order[at:stop]])]
            at = stop
        base = int(group.column("_group")[0].as_py()) << 32
        pieces = pack_group(documents, room)
        ids = [documents[i][s : s + n] for i, s, n, _, _ in pieces]
        ends = np.cumsum([0, *[len(x) for x in ids]], dtype=np.int32)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.table([
            pa.array([names[order[p[0]]] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()), pa.array([p[2] for p in pieces], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
            pa.array([len(documents[p[0]]) for p in pieces], pa.int64()),
            pa.array([base + p[3] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.int64())], schema=_SCHEMA)

    return pack


def pack_documents(docs: DataFrame, path: str | None = None, room: int = SEQUENCE, end_id: int = END_ID, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Pieces: doc_id, start, length, ids, their CRC-32 as little-endian 32-bit numbers, doc_tokens, sequence_id, offset."""
    ready = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_data"))
    total = ready.select(F.sum(F.length("_data"))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    dealt = ready.withColumn("_group", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(
        _packer(path or vocabulary_path(), room, end_id),
        "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


@query("op7_ffd_packing")
def packed_documents(spark, sf_dir):
    """Pieces of all documents in sequences of 2048 tokens; the ids as their CRC-32."""
    return pack_documents(load(spark, sf_dir, "documents")).drop("ids")


def packing_stage(spark, docs, sf_dir):
    """Pieces of the documents that earlier stages kept."""
    return pack_documents(docs).drop("ids")
