"""Operators against brute force, round trips and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from gaugeloom.llm import bytecnn, crossparse, jaccard, licences, linechunks, maxscore, packing, pseudonyms, templates, tokens

SF = "/root/testdata/sf0.001"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


# 1: pseudonyms


def pseudonym_of(spark, values, key="k"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    return [r.text for r in pseudonyms.pseudonymise(df, key).orderBy("doc_id").collect()]


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed([int(x) for x in digits]))) % 10 == 0


def test_pseudonyms_keep_format_and_stay_different(spark):
    cards = [f"{4000000000000000 + i * 7919}" for i in range(200)]
    ips = [f"10.0.{i // 256}.{i % 256}" for i in range(200)]
    dates = [f"2001-0{1 + i % 9}-{10 + i % 18}" for i in range(60)]
    ssns = [f"{100 + i}-45-{6789 - i}" for i in range(100)]
    values = list(dict.fromkeys([*cards, *ips, *dates, *ssns]))
    made = pseudonym_of(spark, values)
    assert len(set(made)) == len(values) and not set(made) & {v for v, m in zip(values, made) if v == m}
    for v, m in zip(values, made):
        assert re.sub(r"\d+", "0", v) == re.sub(r"\d+", "0", m)
        if v in cards:
            assert luhn(v) == luhn(m) and len(m) == 16
        elif v in ips:
            assert all(0 <= int(x) <= 255 for x in m.split("."))
    assert pseudonym_of(spark, [f"a {values[0]} b {values[0]}, {ips[3]}"]) == [f"a {made[0]} b {made[0]}, {made[values.index(ips[3])]}"]
    assert pseudonym_of(spark, values[:5], "other") != made[:5]


def test_invalid_values_stay(spark):
    odd = ["300.1.2.3 is no address", "2023-02-29 is no date", "000-12-3456", "only words", "version 1.2.3"]
    assert pseudonym_of(spark, odd) == odd


# 2: languages


def test_phrases_match_a_plain_parse():
    rng = random.Random(3)
    labelled = {n: ["".join(rng.choice(a) for _ in range(300))] for n, a in (("x", "abc "), ("y", "bcd "))}
    parser = crossparse.Parser(labelled)
    for _ in range(20):
        text = "".join(rng.choice("abcde  ,") for _ in range(rng.randrange(1, 400))) + "a"
        clean = lambda t: re.sub(r"[^a-z]+", " ", t).lstrip()
        s = clean(text)
        costs, has, _ = parser.costs([text.encode()])
        assert has[0]
        for k, n in enumerate(parser.languages):
            learned, phrases, at = clean(labelled[n][0]).replace("e", "#"), 0, 0
            while at < len(s):
                end = at + 1
                while end <= len(s) and s[at:end] in learned:
                    end += 1
                phrases, at = phrases + 1, max(end - 1, at + 1)
            assert round(costs[0][k] * len(s) / parser.bits[k], 6) == phrases


def test_held_out_languages(spark):
    from pyspark.sql import functions as F

    from gaugeloom.llm.common import load

    got = crossparse.document_languages(spark, SF).join(load(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95


def test_language_stage_follows_the_prediction(spark):
    from pyspark.sql import functions as F

    from gaugeloom.llm.common import load

    docs = load(spark, SF, "documents").select("doc_id", "text", "lang", F.lit("own").alias("score"))
    sample = crossparse.labelled_sample(docs)
    strange = [(-1, "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。"), (-2, "Все люди рождаются свободными и равными"),
               (-3, "xq zvk jjw qpz wxk vvz kqj " * 9), (-4, "12 + 30"), (-5, None)]
    few = [(-6, "A"), (-7, "日本"), (-8, "The same thing again and all of it.")]  # too short to be judged strange, or clean
    more = spark.createDataFrame(strange + few, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "score": F.lit("own")})
    kept = crossparse.in_languages(docs.unionByName(more), sample)
    assert kept.columns == docs.columns and kept.where("score <> 'own'").count() == 0
    assert {r.doc_id for r in kept.where("doc_id < 0").collect()} == {-6, -7, -8}
    letters = docs.where(F.col("text").rlike(r"\p{L}"))
    assert kept.where("doc_id >= 0").count() == letters.count()  # clean documents stay
    german = crossparse.in_languages(docs, sample, ["de"])
    got = {r.lang: r.n for r in german.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got["de"] >= 0.98 * letters.where("lang = 'de'").count() and sum(n for lang, n in got.items() if lang != "de") <= 0.01 * letters.count()


# 3: licences


def test_scan_matches_plain_search():
    rng, scanner = random.Random(5), licences.Scanner()
    pool = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "the", "x", "Ünder"]
    for _ in range(200):
        ws = [rng.choice(pool) for _ in range(rng.randrange(0, 40))]
        got = scanner.scan(", ".join(ws).upper().encode() if rng.random() < 0.5 else " ".join(ws).encode())
        low = [w if not w.isascii() else w.lower() for w in ws]
        places = [(i, label) for p, label in licences.BASE.items() for i in range(len(low)) if low[i : i + len(p.split())] == p.split()]
        assert got["n_words"] == len(ws) and got["n_base"] == len(places)
        assert got["first_word"] == min([i for i, _ in places], default=None) and got["last_word"] == max([i for i, _ in places], default=None)
        assert got["base_labels"] == ",".join(sorted({n for _, n in places})) and set(got["base_labels"].split(",")) <= set(got["labels"].split(","))


def test_chained_spans():
    got = licences.Scanner().scan(b"x This work is licensed under the GNU, General Public License (version 3). y")
    assert got["labels"] == "gpl,gpl-3.0" and got["spans"] == [{"label": "gpl-3.0", "first": 1, "last": 12, "cover": 1.0}]
    assert licences.Scanner().scan(b"licensed under the apache licence")["labels"] == ""


def _shared_runs(codes, templates):
    """All maximal runs of at least three words along every diagonal of text and template."""
    out = []
    for t, (_, words) in enumerate(templates):
        for shift in range(-len(words) + 1, len(codes)):
            run = 0
            for e in range(len(words) + 1):
                if e < len(words) and 0 <= shift + e < len(codes) and codes[shift + e] == words[e]:
                    run += 1
                else:
                    out += [(shift + e - run, t, e - run, run)] if run >= licences.MIN_MATCH else []
                    run = 0
    return out


def _spans_plainly(runs, templates):
    """Chains by looking at every pair of runs, spans by looking at every one taken."""
    runs, best, out = sorted(runs), [], []
    for s, t, at, n in runs:
        before = [(b, r) for b, r in zip(best, runs) if r[1] == t and r[0] + r[3] <= s <= r[0] + r[3] + licences.MAX_GAP and r[2] + r[3] <= at]
        best.append((n + max((b[0] for b, _ in before), default=0), n))
        if best[-1][0] >= licences.MIN_COVER * len(templates[t][1]):
            out.append((templates[t][0], s + n - 1, best[-1][0] / len(templates[t][1]), best[-1][0]))
    return out


def test_runs_and_covers_match_plain_search():
    rng, scanner = random.Random(8), licences.Scanner()
    for _ in range(40):
        codes = []
        while len(codes) < 150:  # parts of templates, some words left out, changed or put in
            words = rng.choice(scanner.templates)[1]
            begin = rng.randrange(len(words))
            codes += [w if rng.random() > 0.03 else rng.randint(1, 60) for w in words[begin : begin + rng.randint(1, 90)] if rng.random() > 0.02]
        _, runs = scanner.walk(codes, 0)
        assert sorted(runs) == sorted(_shared_runs(codes, scanner.templates))
        plain = _spans_plainly(runs, scanner.templates)
        got = scanner.spans(runs)
        assert {(label, last, share) for label, _, last, share in got} <= {p[:3] for p in plain}
        assert all(a[2] < b[1] for a, b in zip(got, got[1:]))
        most = max((p[3] for p in plain), default=0)  # what covers most words always counts
        assert not plain or {p[:3] for p in plain if p[3] == most} & {(label, last, share) for label, _, last, share in got}


def test_whole_licences_with_small_edits():
    from gaugeloom.llm.licencetexts import FULL_TEXTS

    rng, scanner = random.Random(3), licences.Scanner()
    for label, text in FULL_TEXTS:
        words = text.split()
        exact = scanner.scan(text.encode())["spans"]
        assert [(s["label"], s["first"], s["cover"]) for s in exact] == [(label, 0, 1.0)]
        for i in rng.sample(range(len(words)), max(1, len(words) // 60)):
            words[i] = "someoneelse"
        edited = scanner.scan(("Preface of its own. " + " ".join(words) + " And an end.").encode())["spans"]
        assert label in {s["label"] for s in edited} and max(s["last"] - s["first"] for s in edited) > len(words) // 2


def test_a_megabyte_of_notices():
    import time

    from gaugeloom.llm.licencetexts import FULL_TEXTS

    text = (" ".join(t for _, t in FULL_TEXTS) + " ").encode()
    repeat = -(-1_000_000 // len(text))
    begun = time.process_time()
    got = licences.Scanner().scan(text * repeat)
    assert time.process_time() - begun < 2 and len(got["spans"]) == repeat * len(FULL_TEXTS)


# 4, 7: tokens and packing


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    return lambda x: t.encode(x, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdtmrevl,.!09aé"), st.characters(codec="utf-8", max_codepoint=0x2FFF)), max_size=60))
def test_ids_match_the_library(reference, text):
    assert tokens.encoder(tokens.vocabulary_path()).encode([text])[0].tolist() == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|endoftext|", " <|", "a", " b'll", "\n", "  ", "é"]), st.text(max_size=6)), max_size=12))
def test_added_tokens_match_the_library(reference, parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    e = tokens.encoder(tokens.vocabulary_path())
    got = e.encode(["plain", text, ""])
    assert [x.tolist() for x in got] == [reference(x) for x in ("plain", text, "")]
    assert e.lengths()[got[1]].sum() == len(text.encode())


def test_other_files_are_encoded_by_their_library():
    from tokenizers import Tokenizer

    path = tokens.vocabulary_path("word_bpe_49k.json")
    e = tokens.Encoder(path)
    text = "Two  WORDS, don't <|endoftext|> naïve 12"
    assert not e.byte_level and e.encode([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError, match="byte-level"):
        e.lengths()


def test_line_tokens_add_up(spark, reference):
    df = spark.createDataFrame([(1, "ab\n\ncd  \n  efé日\n"), (2, "x")], "doc_id long, text string")
    got = tokens.line_tokens(df).orderBy("doc_id", "section").collect()
    assert sum(r.n_tokens for r in got if r.doc_id == 1) == len(reference("ab\n\ncd  \n  efé日\n"))
    assert [(r.start_char, r.end_char) for r in got if r.doc_id == 1] == [(0, 3), (3, 4), (4, 9), (9, 16)]


def test_crossing_tokens_go_to_the_larger_part():
    n, crossing = tokens.section_counts(np.array([0, 1, 1]), np.array([4, 2]), np.array([3, 5, 8]))
    assert n.tolist() == [1, 1, 1] and crossing.tolist() == [1, 1, 0]  # 0-4: three of four bytes; 4-6: a tie, so the earlier; 6-8 inside


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, places = packing.first_fit_decreasing(lengths, 50)
    room = []
    for n, b, p in zip(lengths, bins, places):
        want = next((i for i, r in enumerate(room) if r >= n), len(room))
        if want == len(room):
            room.append(50)
        assert (b, p) == (want, 50 - room[want])
        room[want] -= n


def test_packed_ids_come_back(spark, reference):
    rng = random.Random(1)
    texts = {i: words(rng, rng.randrange(0, 3000)) for i in range(30)} | {99: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pieces = packing.pack_documents(df, group_bytes=20000).collect()
    for i, t in texts.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == reference(t or "") + [1] and {p.doc_tokens for p in own} == {len(reference(t or "")) + 1}
    by: dict[int, list] = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 2048
    assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in pieces)


# 5: quality


def test_quality_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    from gaugeloom.llm.common import load

    got = bytecnn.document_quality(spark, "/root/testdata/sf0.01").join(load(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out")
    assert got.select(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] >= 0.9


def test_chunks_cover_every_window():
    for n in (0, 1, 7, 8, 1024, 1025, 1028, 5000):
        data = bytes(i % 251 for i in range(n))
        rows, sizes = bytecnn.chunks(data)
        windows = {bytes(r[i : i + 8].astype(np.uint8)) for r in rows for i in range(0, 1024 - 7, 4) if (r[i : i + 8] < 256).all()}
        assert windows == {data[i : i + 8] for i in range(0, n - 7, 4)} and (sizes > 0).all()


# 6: templates


def test_leaks_with_other_values(spark):
    item = "a train leaves Paris at 10 km per hour and meets Paris after 10 long hours near the old mill"
    rows = [
        (1, "xx yy " + item.replace("Paris", "Rome").replace("10", "75") + " zz"), (2, item), (3, "xx " + item.replace("Paris", "Rome", 1).replace("10", "75")),
        (4, "something else that has nothing to do with it at all, not a bit"), (5, " ".join(item.split()[:6]))]
    df, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.cover, r.changed) for r in templates.find_leaks(df, items).collect()}
    assert got == {(1, 7): (1.0, True), (2, 7): (1.0, False)}  # 3: one name would stand for two


def test_short_items_are_one_window(spark):
    df = spark.createDataFrame([(1, "so they said red green blue then left"), (2, "red blue green")], "doc_id long, text string")
    got = templates.find_leaks(df, spark.createDataFrame([(1, "Red, green blue")], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 1)]


def leaks(spark, docs, items):
    df, given_items = spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in templates.find_leaks(df, given_items).collect()}


def test_leaks_with_words_put_in_or_taken_out(spark):
    rng = random.Random(4)
    items = {n: words(rng, n, 10**9) for n in (16, 20, 30, 39)}
    docs = {}
    for n, item in items.items():
        w = item.split()
        docs |= {n: " ".join(["so", *w[: n // 2], "extra", *w[n // 2 :]]), 100 + n: " ".join(w[: n // 2 - 1] + w[n // 2 :]) if n > 16 else item, 200 + n: " ".join(w[:8])}
    items[1] = "a shop sells 900 red pens to Tom each and every long day and then some more to the old man"
    docs[1] = "it says a shop sells 1,500 red pens to Mary Ann each and every long day and then some more to the old man"
    assert leaks(spark, docs, items) == {(d, d % 100) for d in docs if d < 200}


def test_verbatim_items_are_found(spark):
    items = {
        1: "What is 348 + 217?", 2: "What is it called?", 3: "the men were Tom, Ann, Bob, Jim, Eve, Max and Zoe, Kim, Lee, Roy, Sam, Tim in all",
        4: "on 12 May 1999, 13 June 2000, 14 July 2001, 15 August 2002"}
    docs = {1: "they asked: " + items[1] + " 565", 2: "so he said, " + items[2] + " and left", 3: "we know that " + items[3], 4: "as " + items[4] + " and", 5: "What is 348 + 218?"}
    assert leaks(spark, docs, items) == {(n, n) for n in items}


def test_contradictions_do_not_hide_what_else_agrees(spark):
    rng = random.Random(6)
    passage = f"{words(rng, 60, 10**9)} Paris {words(rng, 60, 10**9)} Paris {words(rng, 78, 10**9)}"
    apples = "a farmer has 3 apples and 3 pears in the big old basket that stands near the door"
    names = " ".join(f"{words(rng, 5, 10**9)} Paris" for _ in range(3)) + " " + words(rng, 5, 10**9)
    items = {1: passage, 2: apples, 3: names, 4: " ".join(f"{words(rng, 5, 10**9)} {n}" for n in ("Paris", "Rome")) + " " + words(rng, 5, 10**9)}
    docs = {
        1: passage.replace("Paris", "Rome", 1), 2: apples.replace("3", "4", 1).replace("3", "5"), 3: names.replace("Paris", "Rome").replace("Rome", "Oslo", 1),
        4: items[4].replace("Paris", "Oslo").replace("Rome", "Oslo")}
    assert leaks(spark, docs, items) == {(1, 1), (2, 2), (3, 3)}  # 4: one name would stand for two


# 8: groups


def brute_groups(texts):
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())
    label = {d: d for d in texts}
    links = [(a, b) for a in texts for b in texts if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {d: (len(sets[d]), label[d]) for d in texts}


@pytest.mark.parametrize("seed", range(3))
def test_groups_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "LONG_POSTING", 3)
    rng = random.Random(seed)
    bases = [words(rng, rng.choice([3, 8, 30, 80, 200])) for _ in range(12)]
    texts = {}
    for i in range(150):
        w = rng.choice(bases).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            kind, at = rng.randrange(3), rng.randrange(len(w))
            if kind == 0:
                w[at] = f"w{rng.randrange(400)}"
            elif kind == 1:
                w.insert(at, "the")
            elif len(w) > 1:
                del w[at]
        texts[i] = "  ".join(w).upper() if rng.random() < 0.2 else " ".join(w)
    texts |= {500: "", 501: None, 502: " \n", 503: "one two", 504: "ONE two", 505: "common line of text here"}
    got = {r.doc_id: (r.n, r.component_id) for r in jaccard.grouped(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute_groups(texts)


def test_stage_takes_five_words_and_four_fifths(spark):
    rng = random.Random(5)
    texts = {}
    for i in range(4):
        w = words(rng, 300, 5000).split()
        scattered, heavy = w[:], w[:]
        for at in range(20, 221, 40):
            scattered[at] = "edited"
        for at in range(5, 295, 6):
            heavy[at] = "edited"
        texts |= {10 * i: " ".join(w), 10 * i + 1: " ".join(w + words(rng, 60, 5000).split()), 10 * i + 2: " ".join(scattered), 10 * i + 3: " ".join(heavy),
                  10 * i + 4: " ".join(w + words(rng, 90, 5000).split())}
    sets = {d: {tuple(x[j : j + 5]) for j in range(len(x) - 4)} for d, x in ((d, t.split()) for d, t in texts.items())}
    label = {d: d for d in texts}
    for _ in range(5):
        for a in texts:
            for b in texts:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert label[1] == label[2] == 0 and label[3] == 3 and label[4] == 4
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in jaccard.near_duplicate_stage(spark, df, None).collect()} == set(label.values())


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    label = {x: x for p in links for x in p}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if any(k in p and p[0] != p[1] for p in links)}


# 9: lines


def test_repeated_passages_go_once(spark):
    passage = "\n".join(f"shared line number {i}" for i in range(40))
    long = " ".join(f"p{i}" for i in range(60))
    texts = {1: f"one\n{passage}\ntwo\n{long}\nend", 2: f"three\n{passage}\nfour\n{long}\nlast", 3: "five\nsix", 4: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in linechunks.remove_repeated(df).collect()}
    assert got[1].text == texts[1] and got[3].text == texts[3] and got[4].text is None
    assert long not in got[2].text and got[2].n_removed >= 25 and got[2].text.startswith("three") and got[2].text.endswith("last")


def test_runs_of_ordinary_lines_go_whole(spark):
    rng = random.Random(9)
    line = lambda n: words(rng, n, 10**9)
    passages = {n: [line(60 // n + 1 + i % 2) for i in range(n)] for n in range(3, 11)}
    short = [line(12) for _ in range(3)]
    first = {n: "\n".join([line(9), *p, line(9)]) for n, p in passages.items()}
    again = {100 + n: "\n".join([f"before {n}", *p[:2], "", *p[2:], f"after {n}"]) for n, p in passages.items()}
    one = line(10)
    texts = first | again | {50: "\n".join(["x", *short, "y"]), 150: "\n".join([one] * 20), None: "\n".join(["null", *passages[5], "id"])}
    df = spark.createDataFrame([*texts.items(), (103, again[103])], "doc_id long, text string")
    got = {r.doc_id: r for r in linechunks.remove_repeated(df, runs=True).collect()}
    assert all(got[n].text == first[n] for n in first) and got[50].text == texts[50]
    assert all(got[100 + n].text == f"before {n}\nafter {n}" and got[100 + n].n_removed == n + 1 for n in passages)
    assert got[None].text == "null\nid"
    assert got[150].text == "\n".join([one] * 6)  # the first place of more than 50 words stays
    assert {r.text for r in linechunks.line_stage(spark, df.where("doc_id > 100 and doc_id < 150 or doc_id < 20"), None).collect()} == {
        *first.values(), *[f"before {n}\nafter {n}" for n in passages]}


def test_copies_of_several_lines_leave_nothing(spark):
    rng = random.Random(11)
    texts = {}
    for i in range(40):
        lines = [words(rng, rng.randrange(1, 9), 10**9) for _ in range(rng.randrange(2, 14))]
        texts |= {i: "\n".join(lines), 100 + i: "\n".join(lines), 200 + i: "\n\n".join(lines) + "\n"}
    left = linechunks.line_stage(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), None).collect()
    assert {r.doc_id: r.text for r in left} == {i: texts[i] for i in range(40)}


# 10: top-k


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 12))
def test_maxscore_matches_full_scores(seed, k):
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(1, 900)), int(rng.integers(1, 40))
    rows = rng.integers(-9, 10, (n, d)) * (rng.random((n, d)) < rng.random())
    q, ids = rng.integers(-9, 10, d), rng.permutation(n)
    score = rows @ q
    found, got = maxscore.search_shard(ids, rows, int(ids[0]), q, k)
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[0]][:k]
    mine = sorted(zip((-got).tolist(), found.tolist()))
    assert mine == [(-int(score[i]), int(ids[i])) for i in order]


# What the operators share


def test_one_operator_s_caches_at_a_time():
    from gaugeloom.llm.common import forget_caches, worker_cache

    built = []
    make = lambda name: lambda: built.append(name) or name
    forget_caches()
    assert [worker_cache(n, "key", make(n)) for n in ("one", "two", "one")] == ["one", "two", "one"] and built == ["one", "two"]
    forget_caches("one")
    assert [worker_cache(n, "key", make(n)) for n in ("one", "two")] == ["one", "two"] and built == ["one", "two", "two"]
    forget_caches()
