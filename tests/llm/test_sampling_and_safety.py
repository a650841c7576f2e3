"""Resampling, hard negatives and toxicity against brute force, exact recounts and held-out labels; odd input of all three."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gaugeloom.llm import hardnegatives, maxscore, pseudonyms, resampling, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, "en", "a", 0), (2, "", None, None, None), (3, "alpha beta gamma " * 30000, "en", "a", 1), (4, "same text here", "en", "a", 1),
    (4, "same text here", "en", "a", 1), (None, "no id at all", None, "a", 1), (5, "\n\n \n", "en", "a", 1), (6, "日本語 ünïcode \U0001f600 \u0000", "x", "a", 1)]


# 11: resampling


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def runs(text, order):
    w = tokens(text)
    return [" ".join(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def plain_resampling(docs, target, order, buckets, percent, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in runs(text, order):
            s[bucket(f)] += 1
    for text in target:
        for f in runs(text, order):
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for name, text in docs:
        feats = runs(text, order)
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in feats)
        rows.append((name, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(tokens(text))))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: len(able) * percent // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in rows)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_resampling_equals_a_plain_recount(spark, monkeypatch, order):
    monkeypatch.setattr(resampling, "HEAD_WORDS", 20)  # so that most words and pairs are of the tail
    monkeypatch.setattr(resampling, "HEAD_PAIRS", 20)
    rng = random.Random(order)
    text = lambda: " ".join(rng.choice(["Ab", "b-c", "é", "x1", "longer,word", "the"]) + str(rng.randrange(9) or "") for _ in range(rng.randrange(60)))
    docs = [(i, text()) for i in range(120)] + [(900, None), (901, "")]
    target = [text() for _ in range(9)] + [None]
    out = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string"),
                              order=order, buckets=97, percent=30, least_words=12)
    got = sorted(tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert got == plain_resampling(docs, target, order, 97, 30, 12, 2024)


def test_ranks_go_on_over_slices(spark):
    scored = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") * 7919 % 400).alias("score"))
    out = resampling.drawn(scored, F.col("doc_id") % 5 > 0, 37, slice_rows=150).where("rank IS NOT NULL").orderBy("rank").collect()
    best = sorted(((-(i * 7919 % 400), i) for i in range(5000) if i % 5), key=lambda x: x)[: 4000 * 37 // 100]
    assert [(r.rank, -r.score, r.doc_id) for r in out] == [(n + 1, s, i) for n, (s, i) in enumerate(best)]


@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e", b"f"]), max_size=200))
@settings(max_examples=60, deadline=None)
def test_summary_keeps_every_frequent_word(items):
    counts, n = resampling.Counter(), 0
    for w in items:
        counts.update([w])
        counts = resampling.shrink(counts, 3)
        n += 1
    assert all(w in counts for w in set(items) if items.count(w) * 4 > n) and len(counts) <= 3


# 12: hard negatives


def plain_mining(rows, anchors, k, m, low, high):
    out = []
    for a, la, va in rows:
        if a not in anchors:
            continue
        score = lambda v: sum(x * y for x, y in zip(va, v))
        others = [(-score(v), i, lab) for i, lab, v in rows if i != a]
        for p, pid, _ in sorted(x for x in others if x[2] == la)[:k]:
            fit = sorted(x for x in others if x[2] != la and low * -p <= 100 * -x[0] <= high * -p)[:m]
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block_bytes,spread", [(7, 1 << 20, 3), (64, 600, 40), (1000, 1 << 20, 1 << 20), (50, 1 << 20, 1 << 30)])
def test_mining_equals_brute_force(spark, monkeypatch, shard_rows, block_bytes, spread):
    monkeypatch.setattr(hardnegatives, "FIRST", 5)
    rng = random.Random(shard_rows)
    rows = [(i, rng.randrange(4), [rng.randrange(-spread // 4, spread) for _ in range(rng.choice([6, 6, 4]))]) for i in range(160)]
    anchors = {i for i, _, _ in rows if i % 10 == 0}
    out = hardnegatives.mine(spark.createDataFrame(rows, "id long, label int, v array<long>"), F.col("id") % 10 == 0, positives=3, negatives=4,
                             shard_rows=shard_rows, block_bytes=block_bytes)
    assert sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == \
        plain_mining(rows, anchors, 3, 4, 30, 90)


def test_mining_of_odd_vectors(spark):
    rows = [(0, 1, [4, 4]), (0, 1, [4, 4]), (1, 1, [5, 5]), (2, 2, [3, 3]), (2, 2, [3, 3]), (3, 2, [3]), (4, None, [9, 9]), (5, 2, None), (None, 1, [9, 9]),
            (10, 7, [1, 1]), (20, 8, [0, 0]), (21, 8, [5, 5]), (22, 9, [1, 0])]
    df = spark.createDataFrame(rows, "id long, label int, v array<long>").selectExpr("*", "'own' AS score", "'own' AS rank", "1 AS place")
    got = sorted(tuple(r) for r in hardnegatives.mine(df, F.col("id") % 10 == 0).collect())
    # Repeated rows count each; an id is not its own positive; a positive of score 0 takes negatives of score 0; no positive, no rows.
    first = [r for r in got if r[0] == 0]
    assert first == [(0, 1, 1, 2, 40, 24), (0, 1, 2, 2, 40, 24), (0, 1, 3, 3, 40, 12)]
    assert [r for r in got if r[0] == 20] and all(r[4] == r[5] == 0 for r in got if r[0] == 20)
    assert not [r for r in got if r[0] == 10]
    assert hardnegatives.mine(df.limit(0), F.col("id") % 10 == 0).collect() == []
    fine = maxscore.whole_numbers(F.col("v"), 256)
    made = spark.createDataFrame([([1.0, None],), ([float("inf")],), (None,), ([-0.001],)], "v array<double>").select(fine.alias("v")).collect()
    assert [r.v for r in made] == [None, None, None, [-1]]


# 1: pseudonyms in their written forms


def pseudonym_of(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    return [r.text for r in pseudonyms.pseudonymise(df, "k").orderBy("doc_id").collect()]


def test_phones_are_linked_over_groupings_and_leave_the_next_number(spark):
    forms = ["+1 (555) 123-4567", "+15551234567", "+1 555 123 4567", "+1-555-123-4567", "+1.555.123.4567"]
    made = pseudonym_of(spark, [*forms, "call +1 (555) 123-4567 250 times", "+44 20 7946 0958"])
    digits = [re.sub(r"\D", "", m) for m in made[:5]]
    assert len(set(digits)) == 1 and digits[0][0] == "1" and digits[0] != "15551234567"
    assert all(re.sub(r"\d", "0", m) == re.sub(r"\d", "0", f) for m, f in zip(made, forms))
    assert made[5] == f"call {made[0]} 250 times" and made[6].startswith("+44 ")


def test_dates_with_the_month_first(spark):
    from datetime import date

    days = [date.fromordinal(date(2020, 1, 13).toordinal() + i) for i in range(120)]
    values = [d.strftime("%m/%d/%Y") for d in days if d.day > 12]
    made = pseudonym_of(spark, values)
    assert len(set(made)) == len(values) and not set(made) & set(values)
    assert all(date(int(m[6:]), int(m[:2]), int(m[3:5])).day > 12 for m in made)
    kept = ["13/13/2020", "02/30/2021", "00/20/2020"]
    assert pseudonym_of(spark, kept) == kept


def test_mail_names_with_accents(spark):
    made = pseudonym_of(spark, ["jörg@x.de", "rg@x.de", "Ünal.Çelik@x.de", "иван1@x.de"])
    assert all(m.endswith("@x.de") for m in made) and made[0] != "jörg@x.de"
    name = made[0][:-5]
    assert len(name) == 4 and not name.endswith(made[1][:-5]) and name[1] not in "abcdefghijklmnopqrstuvwxyz"
    assert re.fullmatch(r"[À-Þ]\w{3}\.[À-Þ]\w{4}", made[2][:-5]) and made[3][:4] == "иван"


# 10: top-k over posting lists


@pytest.mark.parametrize("density,scale", [(0.05, 1), (0.5, 1), (1.0, 1), (0.4, 2**45)])
def test_postings_equal_full_scores_over_shards(density, scale):
    rng = np.random.default_rng(int(density * 100))
    n, d, k = 3000, 24, 7
    rows = rng.integers(-9, 10, (n, d)) * (rng.random((n, d)) < density) * scale
    ids = rng.integers(0, 2000, n)  # some ids stand in several rows, and many scores tie
    shards = [maxscore.Postings(ids[a : a + 700], rows[a : a + 700], 9.0) for a in range(0, n, 700)]
    for j in range(25):
        q, best = rng.integers(-9, 10, d), None
        for s in shards:
            best = s.search(q, int(ids[j]), k, best)
        score = [sum(int(x) * int(y) for x, y in zip(r, q)) for r in rows]
        want = sorted((-x, int(i)) for x, i in zip(score, ids) if i != ids[j])[:k]
        assert [(-int(x), int(i)) for i, x in zip(*best)] == want


def test_terms_that_cannot_matter_are_only_probed(monkeypatch):
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 3, (4000, 40))
    rows[:, :4] *= 100
    shard, asked = maxscore.Postings(np.arange(4000), rows, 9.0), []
    traverse, probe = shard.traverse, shard.probe
    shard.traverse = lambda q, terms, a, b: asked.append(("all", len(terms), b - a)) or traverse(q, terms, a, b)
    shard.probe = lambda q, terms, at: asked.append(("some", len(terms), len(at))) or probe(q, terms, at)
    shard.search(np.ones(40, np.int64), None, 5)
    full = [x for x in asked if x[0] == "all"]
    assert full[0][1:] == (40, maxscore.FIRST) and full[1][1] < 20
    assert sum(n * rows for kind, n, rows in asked if kind == "some") < 4000 * 40 / 4


def test_top_k_keeps_repeated_rows_and_other_columns(spark):
    df = spark.createDataFrame([(0, [1, 2], "x"), (1, [3, 3], "y"), (1, [3, 3], "y"), (1, [0, 1], "z"), (2, [9], "w")], "id long, v array<long>, score string")
    got = maxscore.top_k(df, df.where("id = 0"), 4, shard_rows=2, block_bytes=300)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 9), (0, 2, 1, 9), (0, 3, 2, 9), (0, 4, 1, 2)]


# 13: toxicity


def plain_segments(scores):
    """Maximal segments by the definition: split at the best stretch, again on both sides."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > 0 and (best is None or s > best[2] + 1e-12):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    return plain_segments(scores[:a]) + [best] + [(x + b, y + b, z) for x, y, z in plain_segments(scores[b:])]


@given(st.lists(st.integers(-5, 6), max_size=24))
@settings(max_examples=150, deadline=None)
def test_segments_are_the_maximal_ones(values):
    scores = np.array(values, float) + 0.00137 * np.arange(1, len(values) + 1) ** 1.5  # no ties, so the segments are unique
    got, plain = toxicity.segments(scores), plain_segments(scores.tolist())
    assert [x[:2] for x in got] == [x[:2] for x in plain] and np.allclose([x[2] for x in got], [x[2] for x in plain])


def test_segments_take_linear_time():
    rng = np.random.default_rng(1)
    found = toxicity.segments(rng.normal(-0.01, 1, 400_000))
    assert sum(s for _, _, s in found) > 0 and all(a < b for a, b, _ in found)


def labelled(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        bad = i % 5 == 0
        if bad:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(["zqvile", "zqrotten", "xkscum"]) + rng.choice(["", "s", "ly"]) for _ in range(3)]
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_toxic_passages_are_found(spark):
    train, test = labelled(400, 1), labelled(200, 2)
    model = toxicity.fit(spark.createDataFrame([r[:2] for r in train], "doc_id long, text string"),
                         spark.createDataFrame([(r[0], r[2]) for r in train], "doc_id long, label int"))
    out = {r.doc_id: r for r in toxicity.judged(spark.createDataFrame([r[:2] for r in test], "doc_id long, text string"), model).collect()}
    assert np.mean([out[i].predicted == label for i, _, label in test]) >= 0.98
    for i, text, label in test:
        cut = [text[p.start : p.end] for p in out[i].passages]
        assert not label or any("zq" in c or "xk" in c for c in cut)
        for p, c in zip(out[i].passages, cut):
            assert len(c.split()) == p.last_word - p.first_word + 1 and p.expected <= toxicity.SIGNIFICANT


def test_own_counts_are_left_out():
    counts = {"bad ": (4, 0), "bad": (5, 1)}
    scorer = toxicity.Scorer(counts, 10, 10)
    assert scorer.score("bad") == toxicity.log_odds(4, 0, 10, 10) - toxicity.COST
    assert scorer.score("bad", 1) == toxicity.log_odds(3, 0, 9, 10) - toxicity.COST
    assert scorer.score("badly") == toxicity.log_odds(5, 1, 10, 10) - toxicity.COST and scorer.score("other") == -toxicity.COST
    # A token that comes again says less each time.
    once, twice = scorer.scores(["bad", "bad"]) + toxicity.COST
    assert math.isclose(twice, once / 2)


def test_pruned_tables_score_alike():
    rng = random.Random(4)
    counts = {n: (rng.randrange(3, 40), rng.randrange(40)) for w in ("moron", "morose", "mor", "mo", "idiotic", "xy") for n in toxicity.nodes(w)}
    whole, cut = toxicity.Scorer(counts, 50, 50), toxicity.Scorer(toxicity._pruned(counts, 50, 50), 50, 50)
    for w in ("moron", "morose", "moros", "more", "mor", "mo", "idiotic", "idiot", "xy", "none"):
        assert abs(whole.score(w) - cut.score(w)) < 0.05


def test_fit_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (None, "x")], "doc_id long, text string")
    for labels, share in (([], 0), ([(1, 1), (2, 1), (None, 0), (3, None)], 1), ([(1, 0)], 0)):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        rows = toxicity.judged(docs, model).collect()
        assert len(rows) == 4 and all(abs(r.score - share) < 1e-6 and r.passages == [] and r.predicted == share for r in rows)


# Odd rows and names


MODEL = toxicity.Model({"bad ": (5, 0)}, 10, 10, toxicity.Curve(1.0, 0.0, -2.0, 1.0))
CLASH = ["score", "predicted", "passages", "weight", "rank", "n_features", "label", "node", "_data", "_slice", "_in"]
OPERATORS = {
    "resampling": lambda s, d: resampling.resample(d, s.createDataFrame([("same text",), (None,)], "text string"), least_words=2, percent=50),
    "toxicity": lambda s, d: toxicity.judged(d, MODEL),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, rows, name):
    out = OPERATORS[name](spark, rows(DOCS, *ODD)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ODD)
    assert all(r.score is not None for r in out)
    same = [r for r in out if r.doc_id == 4]
    assert same[0].score == same[1].score
    if name == "resampling":
        assert {r.n_features for r in out if r.doc_id in (1, 2, 5)} == {0} and next(r for r in out if r.doc_id == 3).n_features == 90000
        assert sorted(r.rank for r in out if r["rank"]) == [1, 2]  # 3, 4, 4, the one without an id and 6 have two words
    assert OPERATORS[name](spark, spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_names(spark, rows, name):
    docs = rows(DOCS, *ODD[:2], ODD[3])
    plain = {r.doc_id: r.score for r in OPERATORS[name](spark, docs).collect()}
    for c in CLASH:
        docs = docs.selectExpr("*", f"'own' AS {c}")
    out = OPERATORS[name](spark, docs)
    assert len(set(out.columns)) == len(out.columns) and {r.doc_id: r.score for r in out.collect()} == plain
    assert "label" in out.columns and out.first().label == "own"
