"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import pytest

import corpus_pipeline
from gaugeloom.llm import bytecnn, crossparse, jaccard, licences, linechunks, maxscore, packing, pseudonyms, templates, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta epsilon zeta " * 20000
NET = bytecnn.fit([], [])
SAMPLE = {"en": ["the cat sat on the mat and the dog"], "de": ["der hund und die katze auf der matte"]}
ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, None), (3, "")]

ODD = [
    (1, None, "en", "a", 0), (2, "", None, None, None), (3, LONG, "en", "a", 1), (4, "same text here", "en", "a", 1), (4, "same text here", "en", "a", 1),
    (None, "no id at all", None, "a", 1), (5, "\n\n \n", "en", "a", 1), (6, "日本語 ünïcode \U0001f600 \u0000", "x", "a", 1)]
CLASH = ["score", "predicted", "lang_pred", "bits", "n_lines", "n_removed", "n_values", "labels", "spans", "n_words", "section", "n_tokens", "tokens", "c", "n",
         "_id", "words", "start", "h", "token", "label", "chunk"]

OPERATORS = {
    "pseudonyms": lambda s, d: pseudonyms.pseudonymise(d, "k"),
    "languages": lambda s, d: crossparse.identify(d, SAMPLE),
    "licences": lambda s, d: licences.scan_licences(d),
    "tokens": lambda s, d: tokens.line_tokens(d),
    "quality": lambda s, d: bytecnn.quality(d, NET),
    "leaks": lambda s, d: templates.find_leaks(d, s.createDataFrame(ITEMS, "item_id long, text string")),
    "packing": lambda s, d: packing.pack_documents(d),
    "groups": lambda s, d: jaccard.grouped(d),
    "lines": lambda s, d: linechunks.remove_repeated(d),
}
ONE_ROW_EACH = ("pseudonyms", "languages", "licences", "quality", "groups", "lines")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, rows, name):
    out = OPERATORS[name](spark, rows(DOCS, *ODD)).collect()
    if name in ONE_ROW_EACH:
        assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ODD)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, rows, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_names(spark, rows, name):
    docs = rows(DOCS, *ODD[:2], ODD[3])
    for c in CLASH:
        docs = docs.selectExpr("*", f"'own' AS {c}")
    assert OPERATORS[name](spark, docs).count() >= (0 if name == "leaks" else 3)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, rows, tmp_path, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = rows(DOCS, *ODD)
    out = stage(spark, docs, str(tmp_path))
    out.collect()
    assert name == "packing" or out.columns == docs.columns
    assert stage(spark, spark.createDataFrame([], DOCS), str(tmp_path)).collect() == []


def test_top_k_of_odd_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, None]), (100, [1.0, 2.0]), (1, None), (2, [float("nan"), 0.0]), (3, [0.5, -1.0]), (4, [0.5, -1.0]), (None, [1.0, 1.0]), (5, [1.0])],
                               "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    v = df.select(F.col("vec_id").alias("id"), maxscore.whole_numbers(F.col("embedding")).alias("v"))
    got = [tuple(r) for r in maxscore.top_k(v, v.where("id % 100 = 0"), 10).orderBy("rank").collect()]
    assert got == [(100, 1, 5, 1 << 20), (100, 2, 3, -1572864), (100, 3, 4, -1572864)]
    assert maxscore.top_k(v.limit(0), v.limit(0), 3).collect() == []
