"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built for each language. A text is parsed greedily into phrases, each the longest
match that some place of the language's text allows; the phrase count, times the bits a phrase's address takes, divided by
the length, estimates the cross entropy in bits a character. The language that needs fewest wins.

Texts are lower-cased, letters outside the alphabet of the labelled text match nothing, and each run of other
characters is one space. A parse starts anew after every ``BLOCK`` characters, so that blocks of many texts are parsed side by
side as arrays, and a text of any length is parsed whole in bounded memory.

Defined cases: a null text, or one without letters, is ``und`` with score 0. Equal costs go to the first language in
alphabetical order. Without any labelled text every text is ``und``. Repeated rows are predicted each on its own; other columns
pass through, and columns named like the result's are replaced.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeloom.llm.common import forget_caches, load, query, slices, to_python, worker_cache

#: Characters parsed as one row of the array.
BLOCK = 1024
#: Symbols of the automata: 0 is any letter not seen in the labelled text, 1 a space.
SYMBOLS = 64
#: The labelled text that a language is learned from: so many texts, and so many characters in all.
TRAIN_TEXTS, TRAIN_CHARS = 64, 20_000
#: A text has none of the learned languages where the best of them needs more bits a symbol than this (phrases of one or two letters:
#: other scripts, random letters), by so many bits in all that a few letters aren't judged.
STRANGE_BITS, STRANGE_EXCESS = 9.4, 32.0
#: Columns that ``identify`` adds.
MADE = ("lang_pred", "score", "bits", "symbols")
#: How sharply the score falls with the lead in bits a character.
SHARPNESS = 10.0


def suffix_automaton(symbols: list[int]) -> tuple[list[dict[int, int]], list[int], list[int]]:
    """Transitions, suffix links and longest lengths of the states of a sequence's suffix automaton; state 0 is the root."""
    step, link, longest, last = [{}], [-1], [0], 0
    for c in symbols:
        new = len(step)
        step.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step, link, longest


def _letters() -> np.ndarray:
    """By code point: 0 where there is no letter, else the lower-case code point."""
    out = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low[0])
    return out


def _points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)


class Parser:
    """Suffix automata of several languages as one table of next states."""

    def __init__(self, labelled: dict[str, list[str]]):
        self.languages = sorted(labelled)
        self.lower = worker_cache("letters", "", _letters)
        texts = {n: [self.lower[_points(t.encode("utf-8", "replace"))] for t in labelled[n]] for n in self.languages}
        seen, counts = np.unique(np.concatenate([np.zeros(0, np.int32), *[t[t > 0] for ts in texts.values() for t in ts]]), return_counts=True)
        common = seen[np.argsort(-counts, kind="stable")][: SYMBOLS - 2]
        self.symbol = np.zeros(0x110000, np.uint8)
        self.symbol[common] = np.arange(2, len(common) + 2)
        self.symbol = self.symbol[self.lower]
        self.symbol[self.lower == 0] = 1
        tables, self.roots, self.bits, base = [], [], [], 0
        for n in self.languages:
            symbols = np.concatenate([np.zeros(0, np.uint8), *[np.append(self.symbols(t), 0).astype(np.uint8) for t in labelled[n]]])
            step, _, _ = suffix_automaton([c if c else -1 - i for i, c in enumerate(symbols.tolist())])  # a strange letter matches nothing
            table = np.full((len(step), SYMBOLS), -1, np.int32)
            for i, nexts in enumerate(step):
                for c, j in nexts.items():
                    if c > 0:
                        table[i, c] = base + j
            tables.append(table)
            self.roots.append(base)
            self.bits.append(np.log2(max(2, len(symbols))))
            base += len(step)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def symbols(self, text: str | bytes) -> np.ndarray:
        points = _points(text if isinstance(text, bytes) else text.encode("utf-8", "replace"))
        s = self.symbol[points]
        spare = s == 1
        spare[1:] &= s[:-1] == 1
        return s[~spare]

    def phrases(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrase counts, languages by rows: rows of symbols, the longest first, each parsed for itself."""
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(rows), axis=1)
        count = np.zeros(state.shape, np.int32)
        columns, active = np.ascontiguousarray(rows.T), np.searchsorted(-lengths, -np.arange(rows.shape[1]), side="left")
        for i in range(rows.shape[1]):
            n = active[i]
            if not n:
                break
            c = columns[i, :n].astype(np.int32)
            now = self.table[state[:, :n] * SYMBOLS + c]
            ended = now < 0
            if ended.any():
                anew = self.table[roots * SYMBOLS + c]
                alone = anew < 0  # nothing begins so: the letter is a phrase of its own
                count[:, :n] += ended * ((state[:, :n] != roots) + alone.astype(np.int32))
                now = np.where(ended, np.where(alone, roots, anew), now)
            state[:, :n] = now
        return count + (state != roots)

    def costs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Bits a symbol, texts by languages; which texts have letters; and their symbols."""
        parts = [self.symbols(t) for t in texts]
        has = np.array([bool((p != 1).any()) for p in parts], bool)
        lengths, owners, blocks = [], [], []
        for i, p in enumerate(parts):
            for s in range(0, len(p), BLOCK) if has[i] else ():
                blocks.append(p[s : s + BLOCK])
                lengths.append(len(blocks[-1]))
                owners.append(i)
        total = np.zeros((len(self.languages), len(texts)))
        if blocks and self.languages:
            order = np.argsort(-np.array(lengths), kind="stable")
            length = np.array(lengths)[order]
            rows = np.zeros((len(blocks), int(length[0])), np.uint8)
            for at, j in enumerate(order):
                rows[at, : lengths[j]] = blocks[j]
            found = self.phrases(rows, length)
            for n in range(len(self.languages)):
                total[n] = np.bincount(np.array(owners)[order], weights=found[n], minlength=len(texts)) * self.bits[n]
        sizes = [len(p) for p in parts]
        return total.T / np.maximum(1, sizes)[:, None], has, sizes


def labelled_sample(labelled: DataFrame, texts: int = TRAIN_TEXTS, chars: int = TRAIN_CHARS) -> dict[str, list[str]]:
    """A bounded sample by language: ``texts`` rows by a hash of id and text, each giving an equal share of ``chars``."""
    first = Window.partitionBy("lang").orderBy(F.crc32(F.col("doc_id").cast("string")), "doc_id")
    ids = labelled.where("lang IS NOT NULL").select("lang", "doc_id").withColumn("n", F.row_number().over(first)).where(F.col("n") <= texts)
    share = max(1, chars // max(1, texts))
    # At most `texts` ids for each language: small, whatever the size of the corpus.
    chosen = labelled.join(F.broadcast(ids.select("lang", "doc_id")), ["lang", "doc_id"], "left_semi")
    places = F.greatest(F.lit(1), F.length("text") - share)
    piece = F.substring("text", F.pmod(F.crc32(F.col("doc_id").cast("string")), places) + 1, share)
    out: dict[str, list[str]] = {}
    for r in chosen.where("text IS NOT NULL").select("lang", "doc_id", piece.alias("piece")).orderBy("lang", "doc_id").collect():
        out.setdefault(r.lang, []).append(r.piece)
    return out


def _predictor(packed: str, names: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        forget_caches("letters", "parser")
        parser = worker_cache("parser", packed, lambda: Parser(json.loads(zlib.decompress(base64.b64decode(packed)))))
        for batch in slices(batches, "_data", 2 << 20):
            costs, has, sizes = parser.costs([x.as_py() or b"" for x in batch.column("_data")])
            lang, score = [], []
            for c, letters in zip(costs, has):
                if not letters or not len(c):
                    lang.append("und")
                    score.append(0.0)
                else:
                    best = int(c.argmin())
                    lang.append(parser.languages[best])
                    score.append(float(1 / np.exp(-SHARPNESS * (c - c[best])).sum()))
            bits = [float(c.min()) if letters and len(c) else None for c, letters in zip(costs, has)]
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64()),
                                              pa.array(sizes, pa.int64())], names=[*names, *MADE])

    return predict


def identify(docs: DataFrame, labelled: dict[str, list[str]], text: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score (share of the winner, 0 to 1), bits (a symbol) and symbols; without the text unless ``text``."""
    import json

    packed = base64.b64encode(zlib.compress(json.dumps(labelled, sort_keys=True).encode())).decode()
    names = [c for c in docs.columns if c.lower() not in {*MADE, "_data"}]
    sent = [c for c in names if c.lower() != "text"]
    # The text goes over as bytes and comes back as such: once each way, and unharmed.
    ready = docs.select(*sent, F.col("text").cast("binary").alias("_data"))
    back = [*sent, "_data"] if text else sent
    schema = ready.select(*back).schema.add("lang_pred", "string").add("score", "double").add("bits", "double").add("symbols", "long")
    out = to_python(ready).mapInArrow(_predictor(packed, back), schema)
    made = [F.col(c) for c in MADE]
    return out.select(*[F.col("_data").cast("string").alias(c) if c.lower() == "text" else F.col(c) for c in names if text or c in sent], *made)


def remainder(divisor: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(divisor))


@query("op2_cross_parse")
def document_languages(spark, sf_dir):
    """The language of every document, learned from those whose hash doesn't hold them out."""
    docs = load(spark, sf_dir, "documents")
    held = F.coalesce(remainder(4) == 2, F.lit(False))
    sample = labelled_sample(docs.where(~held))
    return identify(docs.select("doc_id", "text").withColumns({"held_out": held}), sample, text=False).select("doc_id", "held_out", "lang_pred", "score", "bits")


def in_languages(docs: DataFrame, labelled: dict[str, list[str]], languages: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` whose predicted language is wanted (default: any that was learned), with their own columns.

    Texts without letters go, and those that no learned language parses (``STRANGE_BITS``). Where nothing was learned nothing is judged
    but the letters.
    """
    if not labelled:
        return docs.where(F.col("text").rlike(r"\p{L}")) if languages is None else docs.where(F.lit(False))
    # The names that the prediction takes are put aside, as the documents' own columns stay.
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns) if c.lower() in MADE}
    found = identify(docs.withColumnsRenamed(own), labelled)
    strange = (F.col("bits") - STRANGE_BITS) * F.col("symbols") > STRANGE_EXCESS
    wanted = (F.col("lang_pred") != "und") if languages is None else F.col("lang_pred").isin(languages)
    return found.where(wanted & ~strange).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def language_stage(spark, docs, sf_dir):
    """Documents in one of the languages that their labels name, as predicted from their text."""
    return in_languages(docs, labelled_sample(docs.where(~F.coalesce(remainder(4) == 2, F.lit(False)))))
