"""Licence scan by a generalised suffix automaton over the words of licence texts.

All templates and base phrases are put into one automaton over word ids. A text's words are streamed through it, which
gives at each word the longest match that ends there (the matching statistics). Base phrases are read off the suffix links of
the states passed, at every place where they stand. Each state also knows every place of the templates where its words' last
``MIN_MATCH`` or more end, so the walk itself gives all runs that text and template share, without looking at a template again.
Runs are chained in order of both, with gaps of at most ``MAX_GAP`` words in the text, into spans; a span that covers ``MIN_COVER`` of its
template's words labels the text. A run asks only for chains that end within ``MAX_GAP`` words before it, so a text of any length is
scanned in time proportional to it.

Words are ``[0-9a-z]`` and bytes from 0x80 of the text with A-Z in lower case; words that no template has reset the automaton,
so only the stretches between them are walked.

Defined cases: a null or empty text has no words, no labels and score 0. Overlapping places of base phrases all count. Of spans
that overlap, the one that covers most words of its template counts, then the better covered, the earlier, the first by label. Repeated rows are scanned each on its
own; other columns pass through, and columns named like the result's are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeloom.llm.common import forget_caches, load, query, slices, text_bytes, to_python, worker_cache
from gaugeloom.llm.crossparse import suffix_automaton
from gaugeloom.llm.licencetexts import FULL_TEXTS

#: Phrases whose every place counts, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices by label: short standard wordings, as they stand in file headers and page footers.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
)
TEMPLATES = (*NOTICES, *FULL_TEXTS)
MIN_MATCH, MAX_GAP, MIN_COVER = 3, 4, 0.8

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


class Scanner:
    """The automaton of templates and base phrases, with the places of the templates at its states."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.vocabulary: dict[bytes, int] = {}
        texts = [_WORDS.findall(p.encode().lower()) for p in [*base, *[t for _, t in templates]]]
        self.codes = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws] for ws in texts]
        self.base, self.templates = list(base.values()), [(label, c) for (label, _), c in zip(templates, self.codes[len(base):])]
        joined: list[int] = []
        for i, c in enumerate(self.codes):
            joined += [*c, -1 - i]  # a separator of its own: no match crosses it
        self.step, self.link, self.longest = suffix_automaton(joined)
        ends: dict[int, list[int]] = {}
        for p, c in enumerate(self.codes[: len(base)]):
            state = 0
            for w in c:
                state = self.step[state][w]
            ends.setdefault(state, []).append(p)
        #: Base phrases that end where a state's words end, with their lengths.
        self.ends = []
        for state in range(len(self.step)):
            found, s = [], state
            while s > 0:
                found += [(p, len(self.codes[p])) for p in ends.get(s, ())]
                s = self.link[s]
            self.ends.append(found)
        self.places = self._places(len(base))

    def _places(self, first: int) -> list[list[tuple[int, int, int]]]:
        """By state: (template, place of its last word, most words) of all places that share the last ``MIN_MATCH`` words or more."""
        own: list[list[tuple[int, int]]] = [[] for _ in self.step]
        for t, c in enumerate(self.codes[first:]):
            state = length = 0
            for e, w in enumerate(c):
                while state and w not in self.step[state]:
                    state = self.link[state]
                    length = self.longest[state]
                state, length = self.step[state][w], length + 1
                own[state].append((t, e))
        # A state's words end wherever those of the states below it do; longer ones come first, so children before parents.
        ends = [set(x) for x in own]
        order = sorted(range(1, len(self.step)), key=lambda s: -self.longest[s])
        for s in order:
            ends[self.link[s]] |= ends[s]
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.step]
        for s in reversed(order):
            if self.longest[s] >= MIN_MATCH:
                link = self.link[s]
                out[s] = [(t, e, self.longest[s]) for t, e in sorted(ends[s])]
                out[s] += [x for x in out[link] if x[:2] not in ends[s]]
        return out

    def walk(self, codes: list[int], start: int):
        """Of a stretch of known words: base phrases as (phrase, first word), and runs shared with templates as (first word,
        template, its first word, length)."""
        state = length = 0
        phrases, runs = [], []
        for i, c in enumerate(codes):
            while state and c not in self.step[state]:
                state = self.link[state]
                length = self.longest[state]
            if c in self.step[state]:
                state = self.step[state][c]
                length += 1
            else:
                length = 0
            phrases += [(p, start + i - n + 1) for p, n in self.ends[state] if n <= length]
            after = codes[i + 1] if i + 1 < len(codes) else 0
            if length >= MIN_MATCH:
                for t, e, most in self.places[state]:
                    words = self.templates[t][1]
                    if e + 1 == len(words) or words[e + 1] != after:
                        n = min(most, length)
                        runs.append((start + i - n + 1, t, e - n + 1, n))
        return phrases, runs

    def spans(self, runs: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, last word, share of the template covered) of chained runs, for labels that are covered enough."""
        chains: dict[tuple[int, int], list[tuple[int, int, int]]] = {}  # (template, word after) -> (template's word after, covered, first word)
        out = []
        for s, t, at, n in sorted(runs):
            label, words = self.templates[t]
            cover, first = n, s
            for gap in range(MAX_GAP + 1):
                for after, covered, begun in chains.get((t, s - gap), ()):
                    if after <= at and covered + n > cover:
                        cover, first = covered + n, begun
            chains.setdefault((t, s + n), []).append((at + n, cover, first))
            if cover >= MIN_COVER * len(words):
                out.append((label, first, s + n - 1, cover / len(words), cover))
        taken: list[tuple[int, int, str, float]] = []  # apart from each other, in order
        for label, first, last, share, _ in sorted(out, key=lambda x: (-x[4], -x[3], x[1], x[0])):
            i = bisect_left(taken, (first,))
            if (i == len(taken) or taken[i][0] > last) and (i == 0 or taken[i - 1][1] < first):
                taken.insert(i, (first, last, label, share))
        return [(label, first, last, share) for first, last, label, share in taken]

    def scan(self, text: bytes) -> dict:
        words = _WORDS.findall(text.lower())
        get = self.vocabulary.get
        codes = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        known = np.flatnonzero(np.diff(np.concatenate([[0], codes > 0, [0]]).astype(np.int8)))
        phrases, runs = [], []
        for a, b in zip(known[::2].tolist(), known[1::2].tolist()):
            if b - a > 1:
                found, shared = self.walk(codes[a:b].tolist(), a)
                phrases += found
                runs += shared
        spans = self.spans(runs)
        names = {self.base[p] for p, _ in phrases}
        starts = [s for _, s in phrases]
        return {
            "n_words": len(words), "n_base": len(phrases), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(names)), "labels": ",".join(sorted(names | {s[0] for s in spans})),
            "score": 1.0 if names else max((s[3] for s in spans), default=0.0),
            "spans": [{"label": s[0], "first": s[1], "last": s[2], "cover": s[3]} for s in spans]}


RESULT = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
    ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())])))])
_DDL = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label:string,first:long,last:long,cover:double>>")


def _scanner(names: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches("licences")
        scanner = worker_cache("licences", "", Scanner)
        for batch in slices(batches, "_data"):
            rows = [scanner.scan(x.as_py()) for x in batch.column("_data")]
            made = [pa.array([r[f.name] for r in rows], f.type) for f in RESULT]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *made], names=[*names, *RESULT.names])

    return scan


def scan_licences(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with the counts, labels and spans of licence notices."""
    names = [c for c in docs.columns if c.lower() not in {*RESULT.names, "text", "_data"}]
    ready = docs.select(*names, text_bytes().alias("_data"))
    schema = ", ".join([docs.select(*names).schema.simpleString()[7:-1], _DDL]) if names else _DDL
    return to_python(ready).mapInArrow(_scanner(names), schema)


@query("op3_licence_scan")
def document_licences(spark, sf_dir):
    """Licence phrases, labels and spans of every document."""
    return scan_licences(load(spark, sf_dir, "documents").select("doc_id", "text"))
