import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gaugeloom.functions import jsonflat
from gaugeloom.functions.jsonflat import flatten_json, flatten_variant
from gaugeloom.sources.documents import parse_json_docs, read_json_files, read_json_lines
from helpers import T0, points, value

ROOM = {"temp": 21.5, "air": {"co2": 417, "dust": [3, 4]}, "room": "attic", "floor": "3rd", "open": None}
READ = {"temp": 21.5, "air_co2": 417.0, "air_dust_0": 3.0, "air_dust_1": 4.0}


def parse(rows, doc, keys=(), defaults=None, single=False):
    out = parse_json_docs(rows("doc string, collected_at timestamp", (doc, T0)), "json_test", list(keys), defaults, single=single)
    return [(t, f) for _, t, f in points(out.metrics)], out.errors.count()


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("defaults", [{}, {"site": "north"}, {"room": "cellar"}])
@pytest.mark.parametrize("keys", [(), ("room",), ("floor", "room"), ("absent", "open")])
def test_documents(rows, keys, defaults, single):
    # a tag of the document hides a default; a tag it lacks is left out
    tags = defaults | {k: ROOM[k] for k in keys if isinstance(ROOM.get(k), str)}
    for doc in (json.dumps(ROOM), "\n" + json.dumps(ROOM, indent=1) + "\n"):
        assert parse(rows, doc, keys, defaults, single) == ([(tags, READ)], 0)


def test_arrays(rows):
    halls = [{"hall": h, "seats": {"free": n}, "kind": "opera"} for h, n in (("north", 40), ("south", 0), ("west", 7))]
    doc = json.dumps(halls)
    free = [({}, {"seats_free": float(n)}) for n in (0, 40, 7)]
    assert parse(rows, doc) == (free, 0)
    assert parse(rows, doc, single=True) == ([({}, {"seats_free": 40.0})], 0)
    for keys in (("hall",), ("hall", "kind")):
        want = [({k: h[k] for k in keys}, {"seats_free": float(h["seats"]["free"])}) for h in halls]
        assert parse(rows, doc, keys) == (want, 0)
    assert parse(rows, "[]") == ([], 0)
    assert parse(rows, "[4]") == ([], 1)
    # an element without numbers is dropped and reported; the others stay
    assert parse(rows, '[{"n": 3}, {"word": "y"}, null, {"n": 8}]') == ([({}, {"n": 3.0}), ({}, {"n": 8.0})], 2)


def test_blank_and_invalid(rows):
    for blank in ("\n\t", ""):
        assert parse(rows, blank) == ([], 0)
        assert parse(rows, blank, single=True) == ([], 1)
    for bad in ("plain words", '{"temp": 21, "air": "co2": 4}', '{"a": NaN}', '{"a": 1e400}', "5", '"x"'):
        assert parse(rows, bad) == ([], 1), bad


def test_tag_texts(rows):
    doc = '{"a": 1, "n": 1e21, "f": 2.50, "t": true, "o": {"x": 1}, "z": null}'
    assert parse(rows, doc, ("n", "f", "t", "o", "z")) == (
        [({"n": "1000000000000000000000", "f": "2.5", "t": "true"}, {"a": 1.0})], 0)


NESTED = '{"a_": {"_b": [1, {"c": 2.5}, "t", true, null]}, "s": "x", "f": false, "d": 1, "d": 3, "": {"e": 4}}'


def test_flatten(rows):
    df = rows("x string", (NESTED,), (None,), ("broken",))
    nums, none, broken = [r[0] for r in df.select(flatten_json(F.col("x"))).collect()]
    want = {"a__b_0": 1.0, "a__b_1_c": 2.5, "d": 3.0, "e": 4.0}
    assert {k: value(v) for k, v in nums.items()} == want and none == {} and broken == {}
    full = df.select(flatten_json(F.col("x"), strings=True, bools=True)).first()[0]
    assert {k: value(v) for k, v in full.items()} == want | {"a__b_2": "t", "a__b_3": True, "s": "x", "f": False}


def test_flatten_without_python_agrees_down_to_its_depth(rows):
    doc = '{"a": {"b": [1, {"c": 2.5}, "t", true, null]}, "s": "x", "d": 3}'
    df = rows("x string", (doc,))
    out = df.select(flatten_variant(F.col("x"), 5).alias("r")).first().r
    assert out.complete and out.fields == {"a_b_0": 1.0, "a_b_1_c": 2.5, "d": 3.0}
    assert not df.select(flatten_variant(F.col("x"), 2).alias("r")).first().r.complete


def test_deep_document_is_flattened(rows):
    doc = '{"a":' * 200 + "1" + "}" * 200
    (got,) = rows("x string", (doc,)).select(flatten_json(F.col("x"))).first()
    assert list(got) == ["_".join("a" * 200)]


def test_any_depth_is_flattened_and_a_refused_document_is_told_from_an_empty_one(rows):
    n = 100_000
    deep = '{"a":' * n + "[7]" + "}" * n
    df = rows("doc string", (deep,), ("{}",), (deep[:-1],), (None,))
    got = [r.f for r in df.select(flatten_json(F.col("doc"), tell=True).alias("f")).collect()]
    assert len(got[0]) == 1 and len(next(iter(got[0]))) == 2 * n + 1 and got[1:] == [{}, None, {}]
    out = parse_json_docs(rows("doc string, collected_at timestamp", (deep, T0), (deep[:-1], T0)), "m")
    assert out.metrics.count() == 1 and out.errors.count() == 1


@given(st.recursive(st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8),
                    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=5), inner, max_size=4), max_leaves=20), st.sampled_from([None, 1]))
@settings(max_examples=200, deadline=None)
def test_the_deep_reader_reads_like_the_library(value, indent):
    text = f" {json.dumps(value, indent=indent)}\n"
    assert jsonflat.load_deep(text) == jsonflat.load(text)


@pytest.mark.parametrize("text", ["", "{", "[1,]", '{"a"}', '{"a":}', '{"a":1,}', "{,}", "[1 2]", "01", "1.", "-", "nul", "NaN", "[Infinity]", "1e999", '"a\n"', "{}x", "]", '{"a":1]', "[}"])
def test_the_deep_reader_refuses_like_the_library(text):
    for read in (jsonflat.load, jsonflat.load_deep):
        with pytest.raises(ValueError):
            read(text)


def test_files_and_lines(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(ROOM, indent=2))
    (tmp_path / "many.jsonl").write_text(f'{json.dumps(ROOM)}\n\n{{"a": 9}}\nbad\n')
    whole = parse_json_docs(read_json_files(spark, str(tmp_path / "one.json")), "j")
    assert [f for _, _, f in points(whole.metrics)] == [READ]
    lines = parse_json_docs(read_json_lines(spark, str(tmp_path / "many.jsonl")), "j", single=True)
    assert [f for _, _, f in points(lines.metrics)] == [{"a": 9.0}, READ] and lines.errors.count() == 2
