"""Inputs that must neither end a job nor vanish."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from gaugeloom.functions.jsonflat import flatten_json
from gaugeloom.operators.reshape import field_chunks
from gaugeloom.plans import database
from gaugeloom.sources.lines import from_lines

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def test_deep_json(rows):
    deep = '{"a":' * 5000 + "7" + "}" * 5000
    found = rows("t string", (deep,)).select(flatten_json(F.col("t")).alias("f")).first().f
    assert [v.f for v in found.values()] == [7.0] and next(iter(found)).count("a") == 5000


def test_half_surrogates(rows):
    found = rows("t string", (r'{"a":"x\ud800","\udc00b":1,"c":"😀"}',)).select(flatten_json(F.col("t"), strings=True).alias("f")).first().f
    assert {k: v.s or v.f for k, v in found.items()} == {"a": "x�", "�b": 1.0, "c": "\U0001f600"}


def test_lines_check_numbers_and_times(rows):
    lines = ["m v=1 99999999999999999999", "m v=1 1_000", "m v=1_0 5", "m v=1e999 5", "m v=1,w=2i 5", "m v=" + "9" * 30 + "i 5"]
    out = from_lines(rows("line string", *[(x,) for x in lines]))
    assert out.metrics.count() == 1 and out.errors.count() == 5


def test_fields_without_position_stay(rows):
    df = rows("k string, pos long, name string, value string", ("a", None, "x", "1"), ("a", 1, "y", "2"))
    assert [r.fields for r in field_chunks(df, ["k"], "pos", "name", "value").collect()] == [{"x": "1", "y": "2"}]


def test_idle_server_has_a_row(rows):
    tables = {
        "processlist": rows("server string, collected_at timestamp, id long, user string, command string, state string", ("own", T0, 1, "u", "Query", "init")),
        "servers": rows("server string, collected_at timestamp", ("own", T0), ("idle", T0))}
    out = database.process_list(tables, database.DatabaseConfig(own_connection=1)).table.collect()
    assert sorted(r.server for r in out) == ["idle", "own"]
    assert all(v == 0 for r in out for k, v in r.asDict().items() if k.startswith("threads_"))
