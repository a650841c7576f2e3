"""Token ids of whole texts, and token counts by section.

``Encoder`` gives the ids of a public byte-level vocabulary. Texts are cut into the pieces that merges never cross by
array operations on code points, in which each distinct piece is encoded once and then remembered; the
vocabulary's file is a parameter. The pieces follow the byte-level split pattern: contractions, words, numbers and other
signs with an optional space before them, and runs of white space. Texts in which an added token of the file (an end-of-text mark,
say) is written out, and all texts where the file normalises or splits in another way, go to the file's own library.

Token counts: a text is encoded once as a whole. Tokens of such a vocabulary cover the text's bytes without gaps, so the running
sum of their lengths is the map from tokens to places. Tokens are joined with the sections by interval. A token that
crosses a boundary goes to the section that holds most of its bytes, to the earlier on a tie.

Defined cases: a null text has no tokens and, like an empty one, one empty section. An added token written out
in a text is that token, as the file's library has it. Token counts need a byte-level file, as only its tokens cover the text without gaps;
another raises ValueError. Repeated rows are counted each on its own; other columns pass through, and columns named like the result's are replaced.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeloom.llm.common import forget_caches, load, query, slices, text_bytes, to_python, worker_cache

#: Pieces that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 300_000
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _classes() -> np.ndarray:
    import regex

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1]) + 1
            out[a:b] = kind
    out[0xD800:0xE000] = OTHER
    return out


def _byte_signs() -> dict[int, str]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _merger(model: dict, path: str):
    """A function from a piece to its ids.

    Where the file numbers its merges in their order, as byte-level vocabularies commonly do, merging by rank gives the same ids as
    merging by the list; else the file's own model is asked.
    """
    signs = _byte_signs()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    numbers = [model["vocab"]["".join(m)] for m in merges]
    if all(a < b for a, b in zip(numbers, numbers[1:])) and all(model["vocab"][x] < numbers[0] for x in signs.values()):
        import tiktoken

        byte = {sign: b for b, sign in signs.items()}
        known = {*signs.values(), *("".join(m) for m in merges)}
        ranks = {bytes(byte[x] for x in piece): i for piece, i in model["vocab"].items() if piece in known}
        # Pieces are cut already: the pattern takes each whole.
        ranked = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        return ranked.encode_ordinary
    from tokenizers import Tokenizer

    merge = Tokenizer.from_file(path).model.tokenize
    return lambda piece: [t.id for t in merge(piece.encode("utf-8", "replace").decode("latin-1").translate(signs))]


def _byte_level(file: dict) -> bool:
    """Whether the file takes texts as they are and cuts them into byte-level pieces by the usual pattern."""
    split = file.get("pre_tokenizer") or {}
    plain = {"dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"}
    return (file["model"].get("type", "BPE") == "BPE" and not any(file["model"].get(x) for x in plain) and not file.get("normalizer")
            and not file.get("truncation") and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
            and split.get("use_regex", True) and all(x in file["model"]["vocab"] for x in _byte_signs().values()))


class Encoder:
    """Ids of texts by the vocabulary file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.path = path
        self.byte_level = _byte_level(file)
        self.added = {t["content"]: t["id"] for t in file.get("added_tokens") or ()}
        self.vocabulary = file["model"]["vocab"] if self.byte_level else {}
        self.merge = _merger(file["model"], path) if self.byte_level else None
        self.kinds = worker_cache("kinds", "", _classes)
        self.known: dict[str, bytes] = {}  # ids as bytes: small, and quick to join

    def cuts(self, text: str) -> np.ndarray:
        """Places where the pieces of a text begin."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kinds[points]
        n = len(kind)
        starts = np.empty(n, bool)
        starts[0] = True
        blank = kind == SPACE
        plain = points == 32
        np.not_equal(kind[1:], kind[:-1], out=starts[1:])
        starts[1:] &= ~(plain[:-1] & ~blank[1:])  # a plain space belongs to what follows
        starts[:-1] |= blank[:-1] & ~blank[1:]  # so the last blank of a run stands apart
        for at in np.flatnonzero((points == 39) & starts).tolist():
            tail = text[at + 1 : at + 3]
            size = 2 if tail[:1] in ("s", "t", "m", "d") else 3 if tail in ("re", "ve", "ll") else 0
            if size and tail:
                starts[at + 1 : at + size] = False
                if at + size < n and not starts[at + size]:
                    starts[at + size] = True
        return np.flatnonzero(starts)

    @cached_property
    def library(self):
        """The file's own library, loaded when a first text needs it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        own = [not self.byte_level or any(a in t for a in self.added) for t in texts]
        if not any(own):
            return self._by_pieces(texts)
        rest = iter(self._by_pieces([t for t, o in zip(texts, own) if not o]))
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, np.int32) if o else next(rest) for t, o in zip(texts, own)]

    def _by_pieces(self, texts: list[str]) -> list[np.ndarray]:
        pieces, sizes = [], []
        for t in texts:
            if not t:
                sizes.append(0)
                continue
            at = self.cuts(t).tolist()
            pieces += [t[a:b] for a, b in zip(at, [*at[1:], len(t)])]
            sizes.append(len(at))
        found = list(map(self.known.get, pieces))
        new = {p for p, ids in zip(pieces, found) if ids is None}
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set(pieces)
            for p in new:
                self.known[p] = array("i", self.merge(p)).tobytes()
            found = [self.known[p] for p in pieces]
        out, at = [], 0
        for n in sizes:
            out.append(np.frombuffer(b"".join(found[at : at + n]), np.int32))
            at += n
        return out

    def lengths(self) -> np.ndarray:
        """Bytes that each id stands for."""
        if not self.byte_level:
            raise ValueError(f"{self.path}: tokens of a vocabulary that isn't byte-level don't cover the text's bytes")
        out = np.zeros(max([*self.vocabulary.values(), *self.added.values()]) + 1, np.int32)
        for piece, i in self.vocabulary.items():
            out[i] = len(piece)  # each byte is written as one character
        for content, i in self.added.items():
            out[i] = len(content.encode())
        return out


def encoder(path: str) -> Encoder:
    forget_caches("encoder", "kinds")
    return worker_cache("encoder", path, lambda: Encoder(path))


def section_counts(ids: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them also reach into another; ``ends`` are the sections' ends in bytes."""
    stop = np.cumsum(lengths[ids], dtype=np.int64)
    start = stop - lengths[ids]
    first = np.searchsorted(ends, start, side="right")  # the section of the first byte
    last = np.searchsorted(ends, stop - 1, side="right")
    owner = first.copy()
    begins = np.append(0, ends[:-1])
    for i in np.flatnonzero(first != last):
        spans = np.arange(first[i], last[i] + 1)
        share = np.minimum(ends[spans], stop[i]) - np.maximum(begins[spans], start[i])
        owner[i] = spans[int(share.argmax())]
    return np.bincount(owner, minlength=len(ends)), np.bincount(owner[first != last], minlength=len(ends))


def _counter(path: str, names: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        lengths = e.lengths()
        for batch in slices(batches, "_data"):
            data = [x.as_py() for x in batch.column("_data")]
            texts = [d.decode("utf-8", "replace") for d in data]
            row, section, begin, end, tokens, split = [], [], [], [], [], []
            for i, (text, ids) in enumerate(zip(texts, e.encode(texts))):
                raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                ends = np.append(np.flatnonzero(raw == 10) + 1, len(raw)) if len(raw) else np.zeros(1, np.int64)
                if len(ends) > 1 and ends[-1] == ends[-2]:
                    ends = ends[:-1]  # a final line end closes the last section
                n, s = section_counts(ids, lengths, ends)
                places = np.cumsum((raw & 0xC0) != 0x80)  # characters up to each byte
                stops = places[np.maximum(ends - 1, 0)] if len(raw) else np.zeros(1, np.int64)
                row.append(np.full(len(ends), i))
                section.append(np.arange(len(ends)))
                begin.append(np.append(0, stops[:-1]))
                end.append(stops)
                tokens.append(n)
                split.append(s)
            take = pa.array(np.concatenate(row))
            made = [pa.array(np.concatenate(x).astype(np.int64)) for x in (section, begin, end, tokens, split)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(take) for n in names], *made],
                                             names=[*names, "section", "start_char", "end_char", "n_tokens", "n_crossing"])

    return count


def line_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row for each line of each text (its line end included): section, start_char, end_char, n_tokens, n_crossing."""
    made = ("section", "start_char", "end_char", "n_tokens", "n_crossing")
    names = [c for c in docs.columns if c.lower() not in {*made, "text", "_data"}]
    ready = docs.select(*names, text_bytes().alias("_data"))
    schema = ready.select(*names).schema
    for n in made:
        schema = schema.add(n, "long")
    return to_python(ready).mapInArrow(_counter(path or vocabulary_path(), names), schema)


@query("op4_offset_tokens")
def document_line_tokens(spark, sf_dir):
    """Tokens of every line of every document."""
    return line_tokens(load(spark, sf_dir, "documents").select("doc_id", "text"))
