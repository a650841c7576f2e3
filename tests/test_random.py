"""Random inputs, one group holding most rows, against plain Python."""

import fnmatch
import json
import random
from datetime import timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from gaugeloom.functions import values
from gaugeloom.functions.jsonflat import flatten_json
from gaugeloom.model import FIELD_DDL
from gaugeloom.operators import records, reshape, stats
from gaugeloom.operators.filters import match
from gaugeloom.plans import database as db
from helpers import T0, value

RND = random.Random(7)


def skewed(n, keys):
    """Two thirds of the picks are the first key."""
    return [keys[0] if RND.random() < 0.67 else RND.choice(keys[1:]) for _ in range(n)]


def test_counters(rows):
    spec = [(i, k, RND.choice(("incr", "incr", "set")), RND.randint(-9, 9)) for i, k in enumerate(skewed(600, list("abcd")))]
    want = {}
    for _, k, op, v in spec:
        want[k] = v if op == "set" else want.get(k, 0) + v
    df = rows("seq bigint, measurement string, field string, tags map<string,string>, ts timestamp, op string, v bigint",
              *[(i, "m", k, {"x": "y"}, T0, op, v) for i, k, op, v in spec])
    assert {r.field: r.value for r in stats.counter_stats(df.repartition(5)).collect()} == want


def test_timing_means_truncate_like_the_reads_of_a_timer(rows):
    spec = [(i, k, RND.randint(0, 99), RND.randint(-50, 50)) for i, k in enumerate(skewed(500, list("abc")))]
    sums = {}
    for _, k, s, v in spec:
        sums.setdefault((k, s // 10 * 10), []).append(v)
    start = int(T0.timestamp())
    df = rows("seq bigint, measurement string, field string, tags map<string,string>, ts timestamp, op string, v bigint",
              *[(i, "m", k, {}, T0 + timedelta(seconds=s), "incr", v) for i, k, s, v in spec])
    got = {(r.field, r.slot - start): r.mean for r in stats.timing_stats(df, 10).collect()}
    assert got == {k: int(sum(v) / len(v)) for k, v in sums.items()}


def test_chunks_and_carry(rows):
    data = [(k, p, RND.choice((None, None, "x", "y"))) for p, k in enumerate(skewed(700, list("abc")))]
    df = rows("g string, p bigint, m string", *data).repartition(4)
    last, want = {}, {}
    for k, p, m in data:
        last[k] = m or last.get(k)
        want[k, p] = last[k]
    got = {(r.g, r.p): r.s for r in reshape.carry_forward(df, ["g"], "p", "m", "s", slice_rows=50).collect()}
    assert got == want
    kept = {}
    for k, p, m in data:
        if m:
            kept.setdefault(k, []).append(p)
    named = df.withColumns({"n": F.lpad(F.col("p").cast("string"), 5, "0"), "v": F.when(F.col("m").isNotNull(), F.col("p"))})
    chunks = reshape.field_chunks(named, ["g"], "p", "n", "v", 20, slice_rows=50).collect()
    assert {(r.g, r.chunk): sorted(r.fields.values()) for r in chunks} == {
        (k, i // 20): ps[i:i + 20] for k, ps in kept.items() for i in range(0, len(ps), 20)}


def test_null_group_is_kept(rows):
    df = rows("g string, p bigint", (None, 1), (None, 2), ("a", 5))
    assert sorted((r.p, r.rank) for r in reshape.ordered_rank(df, ["g"], "p").collect()) == [(1, 0), (2, 1), (5, 0)]


def test_latest_value_per_name(rows):
    data = [(k, i, RND.choice("mnop"), str(i)) for i, k in enumerate(skewed(300, ["s1", "s2", "s3"]))]
    want = {}
    for k, _, n, v in data:
        want.setdefault(k, {})[n] = v
    out = reshape.collect_fields(rows("s string, pos bigint, n string, v string", *data).repartition(4), ["s"], "pos", "n", "v")
    assert {r.s: dict(r.fields) for r in out.collect()} == want


def test_cursors_see_every_row_once(rows):
    data = [(k, i, T0 + timedelta(seconds=RND.randint(0, 300))) for i, k in enumerate(skewed(200, ["s1", "s2"]))]
    df = rows("server string, id bigint, end_time timestamp", *data)
    cursor, seen = None, []
    for limit in (100, 200, 301):
        landed = df.filter(F.col("end_time") < F.lit(T0 + timedelta(seconds=limit)))
        new = db.after_cursor(landed, cursor)
        picked = [(r.server, r.id, r.end_time) for r in new.collect()]
        seen += [i for _, i, _ in picked]
        cursor = rows("server string, end_time timestamp", *[tuple(r) for r in db.next_cursor(new, cursor).collect()])
    assert sorted(seen) == list(range(200))


def _split(fields, fixed, limit):
    texts = [f"{k}={v}i" for k, v in sorted(fields.items())]
    if fixed + sum(map(len, texts)) + len(texts) - 1 <= limit:
        return [sorted(fields)]
    out, used = [], 0
    for k, t in zip(sorted(fields), texts):
        if not out or used and len(t) + used + fixed >= limit:
            out.append([])
            used = 0
        used += len(t) + (1 if used else 0)
        out[-1].append(k)
    return out


def test_split_sizes(rows):
    docs = [{f"f{i:02}": RND.randint(0, 10 ** RND.randint(1, 9)) for i in range(RND.randint(1, 12))} for _ in range(40)]
    ddl = f"id bigint, measurement string, tags map<string,string>, fields map<string,{FIELD_DDL}>, time_ns bigint"
    df = rows(ddl, *[(i, "m", {"t": "v"}, {k: ("i", v, None, None, None) for k, v in d.items()}, 10**18) for i, d in enumerate(docs)])
    fixed = len("m,t=v") + 19 + 3
    for limit in (30, 45, 80, 400):
        got = {}
        for r in records.split_points(df, limit).collect():
            got.setdefault(r.id, []).append(sorted(r.fields))
        for i, d in enumerate(docs):
            assert sorted(got[i]) == sorted(_split(d, fixed, limit)), (limit, d)


def test_globs(rows):
    subjects = ["".join(RND.choice("ab.*x") for _ in range(RND.randint(0, 6))) for _ in range(80)]
    df = rows("s string", *[(s,) for s in subjects])
    for _ in range(12):
        patterns = ["".join(RND.choice(("a", "b", ".", "*", "?", "[ab]", "[!a]")) for _ in range(RND.randint(1, 4))) for _ in range(RND.randint(1, 3))]
        got = sorted(r.s for r in df.filter(match(F.col("s"), patterns)).collect())
        if any(c in p for p in patterns for c in "*?["):
            want = sorted(s for s in subjects if any(fnmatch.fnmatchcase(s, p) for p in patterns))
        else:
            want = sorted(s for s in subjects if s in patterns)
        assert got == want, patterns


def test_number_texts(rows):
    numbers = [RND.uniform(-1, 1) * 10 ** RND.randint(-12, 30) for _ in range(200)]
    got = [r[0] for r in rows("x double", *[(n,) for n in numbers]).select(values.plain_number(F.col("x"))).collect()]
    assert "e" not in "".join(got).lower()
    assert [float(t) for t in got] == numbers
    assert got == [format(Decimal(repr(n)).normalize(), "f") for n in numbers]


def _random_json(depth):
    pick = RND.random()
    if depth == 0 or pick < 0.4:
        return RND.choice([RND.randint(-99, 99), RND.random(), "t", True, None])
    if pick < 0.7:
        return {RND.choice(["a", "_b", "c_", "dd"]): _random_json(depth - 1) for _ in range(3)}
    return [_random_json(depth - 1) for _ in range(2)]


def _flat(v, name=""):
    name = name.strip("_")
    if isinstance(v, dict):
        return {k2: v2 for k, c in v.items() for k2, v2 in _flat(c, name + "_" + k + "_").items()}
    if isinstance(v, list):
        return {k2: v2 for i, c in enumerate(v) for k2, v2 in _flat(c, f"{name}_{i}_").items()}
    return {name: float(v)} if isinstance(v, (int, float)) and not isinstance(v, bool) else {}


def test_flatten(rows):
    docs = [_random_json(4) for _ in range(60)]
    out = rows("i int, x string", *[(i, json.dumps(d)) for i, d in enumerate(docs)]).select("i", flatten_json(F.col("x")).alias("f")).collect()
    for r in out:
        assert {k: value(v) for k, v in r.f.items()} == _flat(docs[r.i])

