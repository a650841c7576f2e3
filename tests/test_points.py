from pyspark.sql import functions as F

from gaugeloom.functions.values import float_field, int_field
from gaugeloom.model import series_id, to_long, to_wide
from gaugeloom.operators import inputs, points as P, records
from gaugeloom.operators.filters import FilterSpec, apply_filter, include_exclude, match, match_any
from gaugeloom.sources.lines import from_lines
from helpers import T0, only, points


def one(rows, name="m", tags=None, fields=None):
    """A point from plain values."""
    df = rows("c timestamp", (T0,))
    tag_map = F.create_map(*[F.lit(x) for kv in (tags or {}).items() for x in kv]) if tags else F.expr("map()").cast("map<string,string>")
    made = {k: (int_field(F.lit(v)) if type(v) is int else float_field(F.lit(v)) if isinstance(v, float) else
                P.field_of(F.lit(v), df.select(F.lit(v)).schema[0].dataType)) for k, v in (fields or {}).items()}
    field_map = F.create_map(*[x for k, v in made.items() for x in (F.lit(k), v)])
    return df.select(F.lit(name).alias("measurement"), tag_map.alias("tags"), field_map.alias("fields"), F.col("c").alias("ts"),
                     (F.unix_micros("c") * 1000).alias("time_ns"), F.lit("untyped").alias("mtype"),
                     F.lit(False).alias("is_aggregate"), F.lit("t").alias("source"))


def test_make_point_drops_absent_values(rows):
    df = rows("a double, b string, c timestamp, n bigint", (float("nan"), "", T0, 3), (1.5, "x\\", T0, None), (None, "t", T0, None))
    made = P.make_point(df, "m", {"tag": F.col("b")}, {"a": F.col("a"), "n": F.col("n")}, F.col("c"), mtype="gauge")
    assert points(made) == [("m", {}, {"a": 1.5}), ("m", {}, {"n": 3})]
    assert {r.mtype for r in made.collect()} == {"gauge"}


def test_empty_name_or_backslash_name_gives_nothing(rows):
    df = rows("a double, c timestamp", (1.0, T0))
    assert P.make_point(df, "", {}, {"a": F.col("a")}, F.col("c")).count() == 0
    assert P.make_point(df, "m\\", {}, {"a": F.col("a")}, F.col("c")).count() == 0


def test_rename_defaults_and_cleaning(rows):
    df = one(rows, "cpu", {"host": "a"}, {"x": 1, "bad\\": 2})
    cfg = inputs.InputConfig(name_prefix="p_", name_suffix="_s", tags={"host": "plugin", "dc": "plugin"},
                             global_tags={"dc": "global", "env": "prod", "empty": ""})
    assert only(inputs.normalise(df, cfg)) == ("p_cpu_s", {"host": "a", "dc": "plugin", "env": "prod"}, {"x": 1})
    assert only(inputs.normalise(df, inputs.InputConfig(name_override="o")))[0] == "o"


def test_tag_and_field_edits(rows):
    df = one(rows, "m", {"a": "1"}, {"x": 1})
    assert only(P.with_tag(df, "a", "2"))[1] == {"a": "2"}
    assert only(P.without_tag(df, "a"))[1] == {}
    assert only(P.with_field(df, "x", F.lit("t")))[2] == {"x": "t"}
    kept, errors = P.without_field(df, "x")
    assert kept.count() == 0 and errors.first().message == "cannot remove final field x of m"
    kept, errors = P.without_field(P.with_field(df, "y", F.lit(2.0)), "x")
    assert only(kept)[2] == {"y": 2.0} and errors.count() == 0
    assert df.select(P.has_tag("a"), P.has_tag("b"), P.has_field("x")).first()[:] == (True, False, True)
    assert P.as_aggregate(df).first().is_aggregate


PATTERNS = [
    (["pump"], {"pump"}, {"pump2", "apump", ""}), (["pump*"], {"pump", "pump2"}, {"apump"}),
    (["valve", "pump2"], {"valve", "pump2"}, {"pump"}), (["valve", "tank*", "pump"], {"valve", "tank", "tank_9", "pump"}, {"pump2"}),
    (["*k?[5-7]"], {"tank_6", "k_5"}, {"tank_8", "k6"}), (["[!p-t]ump"], {"dump", "lump"}, {"pump", "ump"}),
    (["{in,out}"], {"{in,out}"}, {"in"}), (["{in,out}", "f*"], {"in", "out", "flow"}, {"{in,out}"}),
    (["*low*"], {"slowly", "low"}, {"lw"}), (["*.csv"], {"x/y.csv"}, {"xcsv"}),
]


def test_pattern_lists(rows):
    for patterns, yes, no in PATTERNS:
        df = rows("x string", *[(s,) for s in yes | no])
        assert {r.x for r in df.filter(match(F.col("x"), patterns)).collect()} == yes, patterns
    assert match(F.col("x"), []) is None
    df = rows("x string", ("cpu",), ("mem",), ("",))
    assert [r.x for r in df.filter(include_exclude(F.col("x"), ["*"], ["m*", ""])).collect()] == ["cpu"]
    assert df.filter(match_any(F.col("x"), [])).count() == 0
    assert df.filter(match_any(F.col("x"), ["*"])).count() == 3
    assert [r.x for r in df.filter(match_any(F.col("x"), ["c*u", "c?u"])).collect()] == ["cpu"]


def test_point_filter(rows):
    df = one(rows, "cpu", {"host": "web1", "dc": "x"}, {"idle": 1, "user": 2})
    assert points(apply_filter(df, FilterSpec())) == points(df)
    assert apply_filter(df, FilterSpec(name_pass=["cpu*"], name_drop=["cpu"])).count() == 0
    assert only(apply_filter(df, FilterSpec(field_drop=["us*"])))[2] == {"idle": 1}
    assert apply_filter(df, FilterSpec(field_pass=["none"])).count() == 0
    assert only(apply_filter(df, FilterSpec(tag_include=["host"])))[1] == {"host": "web1"}
    assert only(apply_filter(df, FilterSpec(tag_exclude=["host"])))[1] == {"dc": "x"}
    assert apply_filter(df, FilterSpec(tag_pass={"host": ["db*"], "dc": ["x"]})).count() == 1
    assert apply_filter(df, FilterSpec(tag_pass={"dc": ["x"]}, tag_drop={"host": ["web*"]})).count() == 0
    assert apply_filter(df, FilterSpec(tag_pass={"dc": []})).count() == 0


def test_lines_and_round_trip(rows):
    df = one(rows, "m x", {"a b=c": "x,y", "t": "v"}, {"f": 'say "hi" \\ bye', "i": 1, "n": 15000000.0, "ok": True})
    stamp = int(T0.timestamp()) * 10**9
    text = records.to_lines(df).first().line
    assert text == rf'm\ x,a\ b\=c=x\,y,t=v f="say \"hi\" \\ bye",i=1i,n=15000000,ok=true {stamp}'
    back = from_lines(records.to_lines(df))
    assert points(back.metrics) == points(df) and back.errors.count() == 0
    assert back.metrics.first().time_ns == stamp and back.metrics.first().ts == df.first().ts


def test_bad_lines_become_errors(rows):
    good = from_lines(rows("line string", ("m f=1",), ("  ",), ("nofields",), ("m,tag f=1",), ('m f="x',), ("m f=1 12x",), ("m f=junk,g=2i 5",)))
    assert points(good.metrics) == [("m", {}, {"f": 1.0}), ("m", {}, {"g": 2})]
    assert good.errors.count() == 4


def test_flat_record(rows):
    df = one(rows, "m", {"a": "tag", "z": 'q"'}, {"a": 1, "b": 1.5, "c": "t", "d": True})
    assert records.to_records(df).first().record == '{"a":"tag","b":1.5,"c":"t","d":true,"z":"q\\""}'
    assert '"_measurement":"m"' in records.to_records(df, "_measurement", "_time").first().record


def test_split_points(rows):
    df = one(rows, "m", {"t": "v"}, {"a": 1, "b": 2, "c": 3})
    assert records.split_points(df, 1000).count() == 1
    assert points(records.split_points(df, 10)) == [("m", {"t": "v"}, {k: v}) for k, v in (("a", 1), ("b", 2), ("c", 3))]
    # "m,t=v" + time (19) + 3 = 27 bytes; "a=1i" + ",b=2i" are counted without their comma while packing
    assert [sorted(p[2]) for p in points(records.split_points(df, 36))] == [["a", "b"], ["c"]]
    whole = {k: v for _, _, f in points(records.split_points(df, 33)) for k, v in f.items()}
    assert whole == {"a": 1, "b": 2, "c": 3}


def test_long_wide_and_series(rows):
    df = one(rows, "m", {"t": "v"}, {"a": 1, "b": 2.0})
    assert sorted((r.field, r.kind) for r in to_long(df).collect()) == [("a", "i"), ("b", "f")]
    wide = to_wide(df, ["t"], {"a": "i", "b": "f"}, "m").first()
    assert (wide.t, wide.a, wide.b) == ("v", 1, 2.0)
    other = one(rows, "m", {"x": "1", "t": "v"}, {"a": 1})
    same = one(rows, "m", {"t": "v", "x": "1"}, {"a": 1})
    key = series_id(F.col("measurement"), F.col("tags"))
    assert other.select(key).first() == same.select(key).first() != df.select(key).first()


def test_round_time_and_default_time(rows):
    df = one(rows, "m", {}, {"a": 1}).withColumns({"time_ns": F.lit(1_500_000_000_600_000_001), "ts": F.lit(None).cast("timestamp")})
    out = inputs.round_time(df, 10**9).select("time_ns", F.unix_micros("ts")).first()
    assert out[:] == (1_500_000_001_000_000_000, 1_500_000_001_000_000)
    late = inputs.default_time(df.withColumns({"time_ns": F.lit(None).cast("bigint"), "collected_at": F.lit(T0)})).first()
    assert late.time_ns == int(T0.timestamp()) * 10**9


def test_observed_counts_without_extra_pass(rows):
    df, seen = inputs.observed(one(rows, "m", {}, {"a": 1}), "seen")
    df.count()
    assert seen.get["metrics_gathered"] == 1


def test_files_round_trip(spark, rows, tmp_path):
    from gaugeloom.sources import read_lines, write_points

    df = one(rows, "m", {"t": "v"}, {"a": 1}).unionByName(one(rows, "n", {}, {"b": 1.5}))
    write_points(df, str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert points(back) == points(df) and [r.source for r in back.select("source").distinct().collect()] == ["t"]
    records.write_lines(df, str(tmp_path / "l"))
    assert points(from_lines(read_lines(spark, str(tmp_path / "l"))).metrics) == points(df)
    records.write_records(df, str(tmp_path / "r"), order_by=("measurement",), name_key="_measurement")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == ['{"_measurement":"m","a":1,"t":"v"}', '{"_measurement":"n","b":1.5}']


def test_snapshot_reader_prunes(spark, tmp_path):
    from gaugeloom.sources import read_snapshots
    from helpers import snap

    both = snap(spark, "a", source="x").unionByName(snap(spark, "b", source="y", endpoint="f"))
    both.write.partitionBy("source").parquet(str(tmp_path / "in"))
    df = read_snapshots(spark, str(tmp_path / "in"), source="y", endpoint="f")
    assert [r.payload for r in df.collect()] == ["b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "EqualTo(endpoint,f)" in plan


def test_split_of_many_fields_keeps_them_in_order(rows):
    names = [f"f{i:05d}" for i in range(2000)]
    many = F.map_from_entries(F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda i: F.struct(F.format_string("f%05d", i), int_field(i))))
    df = one(rows, fields={"x": 1}).withColumn("fields", many)
    for limit in (1, 200, 10**6):
        parts = sorted(sorted(r.fields) for r in records.split_points(df, limit).select("fields").collect())
        assert [k for part in parts for k in part] == names
        assert len(parts) == {1: 2000, 10**6: 1}.get(limit, len(parts)) and (limit != 200 or 100 < len(parts) < 400)
