"""Point building, filters, text functions, sinks and self-statistics."""

from __future__ import annotations

from pyspark.sql import Observation, Window, functions as F

from gaugeloom.functions import maps, text, times, values
from gaugeloom.functions.jsonflat import flatten_json
from gaugeloom.model import Result, error_rows, series_id, series_key, to_long, to_wide
from gaugeloom.operators import filters, inputs, points as P, records, reshape, stats
from gaugeloom.operators.filters import FilterSpec
from gaugeloom.plans import registry
from gaugeloom.queries.common import K, event_points, events, joined, keys_text, load, num, query, stamp, tag
from gaugeloom.session import scratch_dir
from gaugeloom.sources.documents import parse_json_docs
from gaugeloom.sources.lines import from_lines


#: Inputs of the provided events.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query("point_build", f"""
SELECT event_id, event_type AS measurement, CAST(user_id AS VARCHAR) AS user_tag, event_type AS type_tag,
       value, {K} AS k, epoch_us(ts) * 1000 AS time_ns, 'untyped' AS mtype FROM events""")
def point_build(spark, d):
    return event_points(spark, d).select(
        "event_id", "measurement", tag("user").alias("user_tag"), tag("type").alias("type_tag"),
        num("value"), num("k", "i"), "time_ns", "mtype")


@query("integer_clamp", """
SELECT o_orderkey, least(CAST(o_orderkey AS HUGEINT) * 1000000000000000, CAST(9223372036854775807 AS HUGEINT))::BIGINT AS big FROM orders""")
def integer_clamp(spark, d):
    product = F.col("o_orderkey").cast("decimal(20,0)") * F.lit(10**15).cast("decimal(16,0)")
    df = load(spark, d, "orders").withColumn("u", F.least(product, F.lit(str(2**64 - 1)).cast("decimal(20,0)")))
    pts = P.make_point(df, "m", {}, {"big": F.col("u").cast("decimal(20,0)")}, stamp(), keep=("o_orderkey",))
    return pts.select("o_orderkey", num("big", "i"))


@query("name_rewrite", """
SELECT event_id, 'app_' || event_type || '_raw' AS renamed, 'pre_fixed' AS overridden FROM events""")
def name_rewrite(spark, d):
    pts = P.rename(event_points(spark, d), prefix="app_", suffix="_raw").withColumnRenamed("measurement", "renamed")
    both = P.rename(pts.withColumn("measurement", F.col("renamed")), override="fixed", prefix="pre_")
    return both.select("event_id", "renamed", F.col("measurement").alias("overridden"))


@query("default_tags", f"""
SELECT event_id, concat_ws(',', 'env=prod', 'region=' || CASE WHEN {K} % 3 = 0 THEN 'own' ELSE 'plugin' END,
       'type=' || event_type, 'user=' || user_id) AS tags FROM events""")
def default_tags(spark, d):
    pts = event_points(spark, d, region=F.when(F.col("k") % 3 == 0, "own"))
    out = P.default_tags(P.default_tags(pts, {"region": "plugin", "user": "nobody"}), {"env": "prod", "region": "global"})
    return out.select("event_id", maps.shown(F.col("tags")).alias("tags"))


@query("drop_bad_fields", f"""
WITH e AS (SELECT event_id, {K} AS k, value, event_type, user_id FROM events)
SELECT event_id,
  concat_ws(',', CASE WHEN k % 3 <> 0 THEN 'k' END, CASE WHEN NOT (k % 5 = 0 OR k % 7 = 0) THEN 'value' END) AS fields,
  CASE WHEN k % 4 <> 0 THEN 'type=' || event_type || ',' ELSE '' END || 'user=' || user_id AS tags
FROM e WHERE k % 3 <> 0 OR NOT (k % 5 = 0 OR k % 7 = 0)""")
def drop_bad_fields(spark, d):
    k = F.col("k")
    df = events(spark, d)
    value = F.when(k % 5 == 0, float("nan")).when(k % 7 == 0, float("-inf")).otherwise(F.col("value"))
    fields = F.create_map(F.lit("value"), values.float_field(value), F.lit("bad\\"), values.int_field(k),
                          F.lit("k"), values.int_field(F.when(k % 3 != 0, k)))
    tags = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("none"), F.lit(""),
                        F.lit("type"), F.when(k % 4 == 0, F.concat("event_type", F.lit("\\"))).otherwise(F.col("event_type")))
    raw = df.select("event_id", F.col("event_type").alias("measurement"), tags.alias("tags"), fields.alias("fields"))
    return P.clean(raw).select("event_id", keys_text("fields").alias("fields"), maps.shown(F.col("tags")).alias("tags"))


@query("tag_edits", f"""
SELECT event_id, 'a=' || {K} || ',user=' || user_id AS tags, {K} % 2 = 0 AS had_b FROM events""")
def tag_edits(spark, d):
    pts = event_points(spark, d, a=F.lit("old"), b=F.when(F.col("k") % 2 == 0, "x"))
    marked = pts.withColumn("had_b", P.has_tag("b"))
    out = P.without_tag(P.without_tag(P.with_tag(marked, "a", F.col("fields")["k"]["i"].cast("string")), "b"), "type")
    return out.select("event_id", maps.shown(F.col("tags")).alias("tags"), "had_b")


@query("field_edits", f"""
SELECT event_id, 'double,k' AS fields, value * 2 AS double, true AS had_k FROM events""")
def field_edits(spark, d):
    pts = event_points(spark, d).withColumn("had_k", P.has_field("k"))
    more = P.with_field(pts, "double", F.col("fields")["value"]["f"] * 2)
    kept, _ = P.without_field(more, "value")
    return kept.select("event_id", keys_text("fields").alias("fields"), num("double"), "had_k")


@query("last_field_error", f"""
SELECT event_type AS name, count(*) AS n FROM events WHERE {K} % 2 = 0 GROUP BY 1""")
def last_field_error(spark, d):
    df = events(spark, d)
    pts = P.make_point(df, F.col("event_type"), {}, {"value": F.col("value"), "k": F.when(F.col("k") % 2 != 0, F.col("k"))}, F.col("ts"))
    _, errors = P.without_field(pts, "value")
    return errors.groupBy(F.regexp_extract("message", r" of (.*)", 1).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("name_filter_glob", """
SELECT event_id, event_type AS measurement FROM events
WHERE (event_type GLOB 'c*' OR event_type GLOB '*ie*' OR event_type = 'error') AND NOT event_type GLOB '?lick'""")
def name_filter_glob(spark, d):
    spec = FilterSpec(name_pass=["c*", "*ie*", "error"], name_drop=["?lick"])
    return filters.name_filter(event_points(spark, d), spec).select("event_id", "measurement")


@query("name_filter_exact", """
SELECT event_id, event_type AS measurement FROM events WHERE event_type IN ('click', 'view')""")
def name_filter_exact(spark, d):
    return filters.name_filter(event_points(spark, d), FilterSpec(name_pass=["click", "view"])).select("event_id", "measurement")


@query("tag_filter", """
SELECT event_id FROM events
WHERE (CAST(user_id AS VARCHAR) GLOB '1*' OR CAST(user_id AS VARCHAR) GLOB '[2-4]?' OR event_type = 'view') AND event_type <> 'error'""")
def tag_filter(spark, d):
    spec = FilterSpec(tag_pass={"user": ["1*", "[2-4]?"], "type": ["view"]}, tag_drop={"type": ["error"], "absent": ["*"]})
    return filters.tag_value_filter(event_points(spark, d), spec).select("event_id")


@query("field_filter", """
SELECT event_id, 'k' AS fields FROM events WHERE event_type <> 'view'
UNION ALL SELECT event_id, 'k,w' FROM events WHERE event_type = 'view'""")
def field_filter(spark, d):
    df = events(spark, d)
    pts = P.make_point(df, "m", {}, {"value": F.col("value"), "k": F.col("k"), "w": F.when(F.col("event_type") == "view", F.col("k"))},
                       F.col("ts"), keep=("event_id",))
    out = filters.field_filter(pts, FilterSpec(field_pass=["?", "val*"], field_drop=["v*"]))
    return out.select("event_id", keys_text("fields").alias("fields"))


@query("field_filter_empties", """
SELECT event_id FROM events WHERE event_type = 'view'""")
def field_filter_empties(spark, d):
    df = events(spark, d)
    pts = P.make_point(df, "m", {}, {"value": F.col("value"), "w": F.when(F.col("event_type") == "view", F.col("k"))},
                       F.col("ts"), keep=("event_id",))
    return filters.field_filter(pts, FilterSpec(field_pass=["w"])).select("event_id")


@query("tag_key_filter", """SELECT event_id, 'type=' || event_type AS tags FROM events""")
def tag_key_filter(spark, d):
    spec = FilterSpec(tag_include=["*e*"], tag_exclude=["us*"])
    return filters.tag_key_filter(event_points(spark, d), spec).select("event_id", maps.shown(F.col("tags")).alias("tags"))


@query("include_exclude", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE (p_name GLOB '*ring*' OR p_name GLOB 'red*') AND NOT p_name GLOB '*blue*' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#17')""")
def include_exclude(spark, d):
    df = load(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    return df.filter(filters.include_exclude(F.col("p_name"), ["*ring*", "red*"], ["*blue*"])
                     & filters.include_exclude(F.col("p_brand"), ["Brand#1", "Brand#2", "Brand#17"]))


@query("point_filter", f"""
SELECT event_id, 'x_' || event_type AS measurement, 'type=' || event_type AS tags, 'value' AS fields, value FROM events
WHERE event_type IN ('click', 'view') AND NOT CAST(user_id AS VARCHAR) GLOB '*7'""")
def point_filter(spark, d):
    spec = FilterSpec(name_pass=["x_click", "x_view"], tag_drop={"user": ["*7"]}, field_drop=["k"], tag_exclude=["user"])
    out = inputs.normalise(event_points(spark, d), inputs.InputConfig(name_prefix="x_", filter=spec))
    return out.select("event_id", "measurement", maps.shown(F.col("tags")).alias("tags"), keys_text("fields").alias("fields"), num("value"))


_RAW_SQL = """
WITH raw AS (
  SELECT o_orderkey, unnest([CAST(o_orderkey AS VARCHAR), o_orderkey || '.5', ' ' || o_orderkey, o_orderkey || 'd', o_orderkey || 'e2',
    '-' || o_orderkey, '+' || o_orderkey, o_orderpriority, 'ON', 'off', 'Yes', 'NO', '', '99999999999999999999', '.' || o_orderkey]) AS raw,
    unnest(range(15)) AS slot FROM orders),
typed AS (
  SELECT *, CASE WHEN regexp_full_match(raw, '[+-]?[0-9]+') THEN try_cast(raw AS BIGINT) END AS as_int,
    CASE WHEN regexp_full_match(raw, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(raw AS DOUBLE) END AS as_float FROM raw)
"""


def _raw(spark, d):
    key = F.col("o_orderkey").cast("string")
    texts = [key, joined(key, ".5"), joined(" ", key), joined(key, "d"), joined(key, "e2"), joined("-", key), joined("+", key),
             F.col("o_orderpriority"), *map(F.lit, ("ON", "off", "Yes", "NO", "", "99999999999999999999")), joined(".", key)]
    return load(spark, d, "orders").select("o_orderkey", F.posexplode(F.array(*texts)).alias("slot", "raw"))


def _typed(df, fn):
    out = maps.once(df, v=fn(F.col("raw"))).filter(F.col("v").isNotNull())
    return out.select("o_orderkey", F.col("slot").cast("bigint").alias("slot"), "v.kind", "v.i", "v.f", "v.s")


@query("value_parse_v1", _RAW_SQL + """
SELECT o_orderkey, slot, 'f' AS kind, CAST(NULL AS BIGINT) AS i, f, CAST(NULL AS VARCHAR) AS s
FROM (SELECT *, CASE WHEN raw IN ('Yes', 'ON') THEN 1.0::DOUBLE WHEN raw IN ('No', 'OFF') THEN 0.0::DOUBLE ELSE as_float END AS f FROM typed)
WHERE f IS NOT NULL""")
def value_parse_v1(spark, d):
    return _typed(_raw(spark, d), lambda c: values.parse_value(c, 1))


@query("value_parse_v2", _RAW_SQL + """
SELECT o_orderkey, slot, CASE WHEN i IS NOT NULL THEN 'i' WHEN f IS NOT NULL THEN 'f' ELSE 's' END AS kind, i, f,
  CASE WHEN i IS NULL AND f IS NULL THEN raw END AS s
FROM (SELECT *, CASE WHEN lower(raw) = 'yes' OR raw = 'ON' THEN 1 WHEN lower(raw) = 'no' OR raw = 'OFF' THEN 0 ELSE as_int END AS i,
      CASE WHEN as_int IS NULL THEN as_float END AS f FROM typed) WHERE raw <> ''""")
def value_parse_v2(spark, d):
    return _typed(_raw(spark, d), lambda c: values.parse_value(c, 2))


@query("int_else_string", _RAW_SQL + """
SELECT o_orderkey, slot, CASE WHEN as_int IS NOT NULL THEN 'i' ELSE 's' END AS kind, as_int AS i, CAST(NULL AS DOUBLE) AS f,
  CASE WHEN as_int IS NULL THEN raw END AS s FROM typed""")
def int_else_string(spark, d):
    return _typed(_raw(spark, d), values.int_else_string)


@query("int_float_string", _RAW_SQL + """
SELECT o_orderkey, slot, CASE WHEN as_int IS NOT NULL THEN 'i' WHEN as_float IS NOT NULL THEN 'f' ELSE 's' END AS kind, as_int AS i,
  CASE WHEN as_int IS NULL THEN as_float END AS f, CASE WHEN as_int IS NULL AND as_float IS NULL THEN raw END AS s FROM typed""")
def int_float_string(spark, d):
    return _typed(_raw(spark, d), values.int_float_string)


@query("number_text", """
SELECT p_partkey, CAST(p_partkey * 10000000 AS VARCHAR) AS whole, p_partkey * 10000000 || '.5' AS half FROM part""")
def number_text(spark, d):
    big = F.col("p_partkey").cast("double") * 1e7
    return load(spark, d, "part").select("p_partkey", values.plain_number(big).alias("whole"), values.plain_number(big + 0.5).alias("half"))


@query("escape_text", r"""
SELECT doc_id, regexp_replace(text, '([," =])', '\\\1', 'g') AS tag_value, regexp_replace(source, '([, ])', '\\\1', 'g') AS name,
  regexp_replace(text, '(["\\])', '\\\1', 'g') AS string_field, true AS same FROM documents""")
def escape_text(spark, d):
    df = load(spark, d, "documents").select(
        "doc_id", "text", text.escape(F.col("text"), "tagval").alias("tag_value"), text.escape(F.col("source"), "name").alias("name"),
        text.escape(F.col("text"), "fieldval").alias("string_field"))
    return df.withColumn("same", text.unescape(F.col("string_field"), "fieldval") == F.col("text")).drop("text")


@query("snake_case", r"""
SELECT p_partkey, lower(regexp_replace(regexp_replace(w, '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '([a-z])([A-Z])', '\1_\2', 'g')) AS snake
FROM (SELECT p_partkey, 'HTTP' || upper(p_name[1]) || replace(p_name[2:], ' ', 'X') || 'ID' AS w FROM part)""")
def snake_case(spark, d):
    name = F.col("p_name")
    word = F.concat(F.lit("HTTP"), F.upper(F.substring(name, 1, 1)), F.replace(F.substring(name, F.lit(2), F.length(name)), F.lit(" "), F.lit("X")), F.lit("ID"))
    return load(spark, d, "part").select("p_partkey", text.snake_case(word).alias("snake"))


@query("split_list", """
SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '[,\\s]+'), lambda w: w <> ''), '|') AS words,
  len(list_filter(regexp_split_to_array(text, '[,\\s]+'), lambda w: w <> '')) AS n FROM documents""")
def split_list(spark, d):
    words = text.split_list(F.col("text"))
    return load(spark, d, "documents").select("doc_id", F.array_join(words, "|").alias("words"), F.size(words).cast("bigint").alias("n"))


@query("mask_url", r"""
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'get http(s)://XXX:XXX@' || regexp_replace(url, '^https?://', '') || ' failed'
  ELSE 'get ' || url || ' failed' END AS message FROM pages""")
def mask_url(spark, d):
    even = F.col("page_id") % 2 == 0
    shown = F.when(even, F.regexp_replace("url", "^(https?://)", "$1user:secret@")).otherwise(F.col("url"))
    return load(spark, d, "pages").select("page_id", text.mask_url(joined("get ", shown, " failed")).alias("message"))


@query("addresses", """
SELECT s_suppkey, 'db' || s_suppkey || ':33' || s_nationkey AS dsn, CASE WHEN s_nationkey % 2 = 0 THEN 'h' || s_suppkey END AS host,
  CASE WHEN s_nationkey % 2 = 0 THEN CASE WHEN s_nationkey % 4 = 0 THEN '2181' ELSE '99' END END AS port,
  'c' || s_suppkey AS cache_host, CASE WHEN s_nationkey % 3 = 0 THEN '6379' ELSE '' END AS cache_port,
  'threads_' || replace(lower(s_name), ' ', '_') || '_a_b' AS space_name FROM supplier""")
def addresses(spark, d):
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    df = load(spark, d, "supplier")
    dsn = joined("u:p@tcp(db", key, ":33", nation, ")/?tls=false")
    spot = F.when(nation % 4 == 0, joined("h", key)).when(nation % 2 == 0, joined("h", key, ":99")).otherwise(joined("h", key, ":1:2"))
    host, port, _ = text.host_port(spot, "2181")
    url = F.when(nation % 3 == 0, joined("c", key, ":6379")).otherwise(joined("tcp://:pw@c", key))
    cache_host, cache_port, _ = text.server_url(url)
    return df.select("s_suppkey", text.dsn_server(dsn).alias("dsn"), host.alias("host"), port.alias("port"), cache_host.alias("cache_host"),
                     cache_port.alias("cache_port"), text.namespace("threads", F.lower("s_name"), "a b").alias("space_name"))


@query("unquote_text", r"""
SELECT doc_id, regexp_replace(text, '[\n\r]', ' ', 'g') AS plain FROM documents""")
def unquote_text(spark, d):
    flat = F.regexp_replace("text", r"[\n\r]", " ")
    quoted = F.concat(F.lit('"'), text.escape(flat, "fieldval"), F.lit('"'))
    return load(spark, d, "documents").select("doc_id", text.unquote(quoted).alias("plain"))


@query("time_round", """
SELECT event_id, CAST(floor((epoch_us(ts) * 1000 + 500000000) / 1000000000.0::DECIMAL(38,1)) AS BIGINT) * 1000000000 AS by_second,
  CAST(((epoch_us(ts) // 1000 * 1000 + CASE WHEN epoch_us(ts) % 1000 >= 500 THEN 1000 ELSE 0 END)) AS BIGINT) * 1000 AS by_milli FROM events""")
def time_round(spark, d):
    pts = event_points(spark, d)
    pts = P.with_field(pts, "by_milli", times.round_ns(F.col("time_ns"), times.UNITS["ms"]))
    second = inputs.round_time(pts, interval_ns=10 * times.UNITS["s"])
    return second.select("event_id", F.col("time_ns").alias("by_second"), F.col("fields")["by_milli"]["i"].alias("by_milli"))


@query("epoch_ms", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS ms FROM events")
def epoch_ms(spark, d):
    return events(spark, d).select("event_id", times.epoch_ms(F.col("ts")).alias("ms"))


@query("json_flatten", f"""
SELECT event_id, {K}::DOUBLE AS a_b, value AS a_list_0, user_id::DOUBLE AS a_list_1_c, 3 AS n FROM events""")
def json_flatten(spark, d):
    df = events(spark, d)
    doc = joined('{"a":{"b_":', F.col("k"), ',"list":[', F.col("value"), ',{"c":', F.col("user_id"), '}]},"s":"', F.col("event_type"), '","t":true,"z":null}')
    flat = df.select("event_id", flatten_json(doc).alias("fields"))
    return flat.select("event_id", num("a_b"), num("a_list_0"), num("a_list_1_c"), F.size("fields").alias("n"))


@query("json_flatten_full", f"""
SELECT event_id, {K}::DOUBLE AS a_b, event_type AS s, user_id % 2 = 0 AS t, 3 AS n FROM events""")
def json_flatten_full(spark, d):
    df = events(spark, d)
    doc = joined('{"a":{"_b":', F.col("k"), '},"s":"', F.col("event_type"), '","t":', F.col("user_id") % 2 == 0, ',"z":null}')
    flat = df.select("event_id", flatten_json(doc, strings=True, bools=True).alias("fields"))
    return flat.select("event_id", num("a__b").alias("a_b"), num("s", "s"), num("t", "b"), F.size("fields").alias("n"))


@query("json_tags", f"""
SELECT epoch_us(ts) AS us, event_type AS kind, CAST({K} AS VARCHAR) AS k, CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS even,
  'default' AS site, value, 1 AS n FROM events""")
def json_tags(spark, d):
    df = events(spark, d)
    doc = joined('{"kind":"', F.col("event_type"), '","k":', F.col("k"), ',"even":', F.col("user_id") % 2 == 0, ',"v":', F.col("value"), ',"o":"text"}')
    out = parse_json_docs(df.select(doc.alias("doc"), "ts"), "j", ["kind", "k", "even", "gone"], {"site": "default", "kind": "none"}, ts="ts")
    return out.metrics.select(F.unix_micros("ts").alias("us"), *[tag(t).alias(t) for t in ("kind", "k", "even", "site")],
                              num("v").alias("value"), F.size("fields").alias("n"))


@query("json_array", f"""
WITH e AS (SELECT event_id, event_type, {K} AS k, value FROM events)
SELECT CAST(event_id AS VARCHAR) AS id, 'point' AS outcome, count(*) AS n, CAST(sum(k) AS BIGINT) AS total
FROM (SELECT event_id, k FROM e WHERE event_type NOT IN ('error', 'view') UNION ALL SELECT event_id, k + 1 FROM e WHERE event_type NOT IN ('error', 'view')) GROUP BY 1
UNION ALL SELECT 'bad', 'error', count(*), 0::BIGINT FROM e WHERE event_type = 'error'""")
def json_array(spark, d):
    df = events(spark, d)
    kind = F.col("event_type")
    pair = joined('[{"id":"', F.col("event_id"), '","k":', F.col("k"), '},{"id":"', F.col("event_id"), '","k":', F.col("k") + 1, "}]")
    doc = F.when(kind == "error", joined('{"id":', F.col("event_id"))).when(kind == "view", "  \n").otherwise(pair)
    out = parse_json_docs(df.select(doc.alias("doc"), "ts"), "j", ["id"], ts="ts")
    good = out.metrics.groupBy(tag("id").alias("id"), F.lit("point").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("fields")["k"]["f"].cast("bigint")).alias("total"))
    bad = out.errors.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bad").alias("id"), F.lit("error").alias("outcome"), "n", F.lit(0).cast("bigint").alias("total"))
    return good.unionByName(bad)


@query("json_single_lines", f"""
SELECT CAST(event_id AS VARCHAR) AS id, 'point' AS outcome, {K} AS total FROM events WHERE event_type NOT IN ('error', 'view')
UNION ALL SELECT 'bad', 'error', count(*) FROM events WHERE event_type IN ('error', 'view')""")
def json_single_lines(spark, d):
    """One point a line: the first of an array counts, a line without a point is an error."""
    df, kind = events(spark, d), F.col("event_type")
    one = joined('{"id":"', F.col("event_id"), '","k":', F.col("k"), "}")
    doc = (F.when(kind == "error", joined("[", F.col("event_id"))).when(kind == "view", " \t").when(kind == "click", one)
           .otherwise(F.concat(F.lit("["), one, F.lit(',{"id":"x","k":0}]'))))
    out = parse_json_docs(df.select(doc.alias("doc"), "ts"), "j", ["id"], ts="ts", single=True)
    good = out.metrics.select(tag("id").alias("id"), F.lit("point").alias("outcome"), F.col("fields")["k"]["f"].cast("bigint").alias("total"))
    return good.unionByName(out.errors.agg(F.count(F.lit(1)).alias("total")).select(F.lit("bad").alias("id"), F.lit("error").alias("outcome"), "total"))


_LINE_SQL = f"""'ev\\ ' || event_type || ',type=' || event_type || ',us\\=er=' || user_id || ' k=' || {K} || 'i,ok=' ||
  CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END || ',s="' || replace(replace(props, '\\', '\\\\'), '"', '\\"') || '" ' || (epoch_us(ts) * 1000)"""


def _hard_points(spark, d):
    df = events(spark, d)
    return P.make_point(df, joined("ev ", F.col("event_type")), {"us=er": F.col("user_id"), "type": F.col("event_type")},
                        {"k": F.col("k"), "s": F.col("props"), "ok": F.col("user_id") % 2 == 0}, F.col("ts"), keep=("event_id",))


@query("line_protocol", f"SELECT event_id, {_LINE_SQL} AS line FROM events")
def line_protocol(spark, d):
    return _hard_points(spark, d).select("event_id", records.line_text().alias("line"))


@query("line_roundtrip", """
SELECT CAST(doc_id AS VARCHAR) AS id, text, lang || ' ' || source AS place, n_chars FROM documents""")
def line_roundtrip(spark, d):
    df = load(spark, d, "documents")
    pts = P.make_point(df, "doc,um ent", {"place": F.concat_ws(" ", "lang", "source"), "id": F.col("doc_id")},
                       {"text": F.col("text"), "n_chars": F.col("n_chars")}, stamp())
    back = from_lines(records.to_lines(pts)).metrics
    return back.filter(F.col("measurement") == "doc,um ent").select(tag("id").alias("id"), num("text", "s"), tag("place").alias("place"), num("n_chars", "i"))


@query("line_errors", """
SELECT count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type NOT IN ('error', 'view')) AS points FROM events""")
def line_errors(spark, d):
    kind = F.col("event_type")
    line = F.when(kind == "error", "nofields").when(kind == "view", "").otherwise(joined("m value=", F.col("value")))
    out = from_lines(load(spark, d, "events").select(line.alias("line")))
    null = F.lit(None).cast("bigint")
    return (out.errors.agg(F.count(F.lit(1)).alias("errors")).withColumn("points", null)
            .unionByName(out.metrics.agg(F.count(F.lit(1)).alias("points")).withColumn("errors", null))
            .agg(F.max("errors").alias("errors"), F.max("points").alias("points")))


@query("point_split", f"""
WITH s AS (SELECT event_id, 25 + 2 * (3 + length(CAST({K} AS VARCHAR))) + 3 + length(CAST(user_id AS VARCHAR)) AS whole FROM events)
SELECT event_id, 'a,b,c' AS fields FROM s WHERE whole <= 40
UNION ALL SELECT event_id, unnest(['a,b', 'c']) FROM s WHERE whole > 40""")
def point_split(spark, d):
    # Name, time and separators take 23 bytes, each field its text; two fields fit under the limit, three not always.
    df = events(spark, d)
    pts = P.make_point(df, "m", {}, {"a": F.col("k"), "b": F.col("user_id"), "c": F.col("k")}, F.col("ts"), keep=("event_id",))
    return records.split_points(pts, 40).select("event_id", keys_text("fields").alias("fields"))


@query("flat_record", f"""
SELECT event_id, '{{"k":' || {K} || ',"ok":' || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END || ',"s":"' || replace(props, '"', '\\"') ||
  '","type":"' || event_type || '","us=er":"' || user_id || '"}}' AS record FROM events""")
def flat_record(spark, d):
    return _hard_points(spark, d).select("event_id", records.flat_record().alias("record"))


@query("long_form", f"""
SELECT event_id, 'value' AS field, 'f' AS kind, CAST(NULL AS BIGINT) AS i, value AS f FROM events
UNION ALL SELECT event_id, 'k', 'i', {K}, NULL FROM events""")
def long_form(spark, d):
    return to_long(event_points(spark, d)).select("event_id", "field", "kind", "i", "f")


@query("series_count", """
SELECT count(*) AS points, count(DISTINCT event_type || '/' || user_id) AS series FROM events""")
def series_count(spark, d):
    per = event_points(spark, d).groupBy(series_key(F.col("measurement"), F.col("tags")).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("points"), F.count(F.lit(1)).alias("series"))


@query("series_ids", """
SELECT event_type AS measurement, CAST(user_id AS VARCHAR) AS user_tag, count(*) AS n FROM events GROUP BY event_type, user_id""")
def series_ids(spark, d):
    """Points grouped by their 64-bit series number alone, whose tags were added in either order."""
    df = event_points(spark, d)
    user, kind = F.create_map(F.lit("user"), tag("user")), F.create_map(F.lit("type"), tag("type"))
    either = df.withColumn("tags", F.when(F.col("event_id") % 2 == 0, F.map_concat(user, kind)).otherwise(F.map_concat(kind, user)))
    per = either.groupBy(series_id(F.col("measurement"), F.col("tags")).alias("id")).agg(
        F.min("measurement").alias("measurement"), F.min(tag("user")).alias("user_tag"), F.count(F.lit(1)).alias("n"))
    return per.drop("id")


@query("ordered_sink", "SELECT count(*) AS records, 0::BIGINT AS inversions, min(epoch_us(ts)) * 1000 AS first_ns, max(epoch_us(ts)) * 1000 AS last_ns FROM events")
def ordered_sink(spark, d):
    """Records written in order of time and read back in the order they stand in."""
    path = scratch_dir(spark, "ordered")
    records.write_records(event_points(spark, d), path, order_by=("time_ns",), time_key="t")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        F.get_json_object("value", "$.t").cast("bigint").alias("t"))
    before = F.lag("t").over(Window.partitionBy("file").orderBy("block", "at"))
    files = lines.withColumn("back", (before > F.col("t")).cast("bigint")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("back").alias("back"), F.min("t").alias("low"), F.max("t").alias("high"))
    # One row a file from here on.
    last = F.max("high").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("back", F.coalesce("back", F.lit(0)) + F.coalesce((last > F.col("low")).cast("bigint"), F.lit(0))).agg(
        F.sum("n").alias("records"), F.sum("back").alias("inversions"), F.min("low").alias("first_ns"), F.max("high").alias("last_ns"))


@query("latest_fields", """
WITH r AS (SELECT o_custkey AS server, o_orderpriority AS field, o_orderkey AS pos, o_orderstatus AS v FROM orders),
m AS (SELECT server, field, max_by(v, pos) AS v FROM r GROUP BY ALL)
SELECT server, string_agg(field || '=' || v, ',' ORDER BY field) AS fields FROM m GROUP BY server""")
def latest_fields(spark, d):
    rows = load(spark, d, "orders").select(
        F.col("o_custkey").alias("server"), F.col("o_orderpriority").alias("field"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("v"))
    out = reshape.collect_fields(rows, ["server"], "pos", "field", "v")
    return out.select("server", maps.shown(F.col("fields")).alias("fields"))


@query("section_carry", """
SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS section FROM events""")
def section_carry(spark, d):
    rows = load(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("mark"))
    return reshape.carry_forward(rows, ["user_id"], "event_id", "mark", "section").select("event_id", "section")


def stat_events(spark, d):
    """Purchases set their counter, everything else adds to it."""
    df = events(spark, d)
    return df.select(F.col("event_id").alias("seq"), F.lit("web").alias("measurement"), F.concat(F.lit("f"), F.col("k") % 3).alias("field"),
                     F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("tags"), "ts",
                     F.when(F.col("event_type") == "purchase", "set").otherwise("incr").alias("op"), F.col("k").alias("v"))


STAT_SQL = f"""
WITH e AS (SELECT event_id AS seq, 'f' || ({K} % 3) AS field, user_id, CASE WHEN event_type = 'purchase' THEN 'set' ELSE 'incr' END AS op, {K} AS v, ts FROM events),
s AS (SELECT user_id, field, max(seq) AS set_seq, max_by(v, seq) AS set_v FROM e WHERE op = 'set' GROUP BY ALL),
c AS (SELECT e.user_id, e.field, CAST(coalesce(max(set_v), 0) + coalesce(sum(v) FILTER (op = 'incr' AND seq > coalesce(set_seq, -1)), 0) AS BIGINT) AS value
      FROM e LEFT JOIN s USING (user_id, field) GROUP BY ALL)
"""


@query("counter_stat", STAT_SQL + "SELECT CAST(user_id AS VARCHAR) AS user_tag, field, value FROM c")
def counter_stat(spark, d):
    return stats.counter_stats(stat_events(spark, d)).select(tag("user").alias("user_tag"), "field", "value")


@query("stat_regroup", STAT_SQL + """
SELECT 'internal_web' AS measurement, CAST(user_id AS VARCHAR) AS user_tag, string_agg(field || '=' || value, ',' ORDER BY field) AS fields FROM c GROUP BY user_id""")
def stat_regroup(spark, d):
    out = stats.regroup(stats.counter_stats(stat_events(spark, d)))
    return out.select("measurement", tag("user").alias("user_tag"), maps.shown(F.transform_values("fields", lambda _, v: values.field_text(v))).alias("fields"))


_TIMING_SQL = f"""
WITH e AS (SELECT user_id, 'f' || ({K} % 3) AS field, {K} AS v, CAST(floor(epoch(ts)) AS BIGINT) // 86400 * 86400 AS slot FROM events),
m AS (SELECT user_id, field, slot, CAST(sum(v) // count(*) AS BIGINT) AS mean FROM e GROUP BY ALL)
"""


@query("timing_stat", _TIMING_SQL + "SELECT CAST(user_id AS VARCHAR) AS user_tag, field, slot, mean FROM m")
def timing_stat(spark, d):
    return stats.timing_stats(stat_events(spark, d), 86400).select(tag("user").alias("user_tag"), "field", "slot", "mean")


@query("timing_reads", _TIMING_SQL + """
, r AS (SELECT DISTINCT user_id, slot FROM e), q AS (SELECT user_id, slot, unnest(['f0', 'f1', 'f2']) AS field FROM r)
SELECT CAST(q.user_id AS VARCHAR) AS user_tag, q.field, q.slot,
  coalesce(last_value(mean IGNORE NULLS) OVER (PARTITION BY q.user_id, q.field ORDER BY q.slot ROWS UNBOUNDED PRECEDING), 0) AS value
FROM q LEFT JOIN m ON q.user_id = m.user_id AND q.field = m.field AND q.slot = m.slot""")
def timing_reads(spark, d):
    means = stats.timing_stats(stat_events(spark, d), 86400)
    reads = means.select("measurement", "pairs", "slot").distinct().select(
        "measurement", "pairs", "slot", F.explode(F.array(*map(F.lit, ("f0", "f1", "f2")))).alias("field"))
    return stats.fill_reads(means, reads).select(tag("user").alias("user_tag"), "field", "slot", "value")


@query("self_metrics", """
SELECT 'internal_gather' AS measurement, event_type AS input, count(*) AS metrics_gathered, CAST(NULL AS BIGINT) AS gather_errors FROM events GROUP BY event_type
UNION ALL SELECT 'internal_agent', NULL, count(*), (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') FROM events""")
def self_metrics(spark, d):
    """Counted by the one write of the points of all event types and of the refused orders."""
    null = F.lit(None).cast("timestamp")
    refused = error_rows(load(spark, d, "orders").filter(F.col("o_orderstatus") == "F"), "orders", joined("refused ", F.col("o_orderkey")), ts=null)
    rows, seen = registry.tagged(Result(event_points(spark, d), refused)), Observation("self metrics")
    counts = [F.count_if(F.col("point.measurement") == t).alias(t) for t in EVENT_TYPES]
    rows.observe(seen, *counts, F.count_if(F.col("kind") == "error").alias("errors")).write.partitionBy("kind").parquet(scratch_dir(spark, "tagged"))
    gathered = {t: n for t in EVENT_TYPES if (n := inputs.counted(seen, t))}
    out = stats.run_points(spark, gathered, inputs.counted(seen, "errors"), stamp())
    return out.select("measurement", F.try_element_at("tags", F.lit("input")).alias("input"), num("metrics_gathered", "i"), num("gather_errors", "i"))


@query("default_time", f"""
SELECT event_id, CASE WHEN {K} % 2 = 0 THEN epoch_us(ts) * 1000 ELSE 1706745600000000000 END AS time_ns FROM events""")
def default_time(spark, d):
    timed = F.col("fields")["k"]["i"] % 2 == 0
    pts = event_points(spark, d).withColumns({"ts": F.when(timed, F.col("ts")), "time_ns": F.when(timed, F.col("time_ns")), "collected_at": stamp()})
    return inputs.default_time(pts).select("event_id", "time_ns")


@query("first_rows", """
SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_rows(spark, d):
    df = events(spark, d).select("event_id", "user_id", "ts")
    return reshape.first_row(df, ["user_id"], [F.asc("ts"), F.asc("event_id")]).select("event_id")


@query("wide_form", f"""
SELECT epoch_us(ts) AS us, CAST(user_id AS VARCHAR) AS user, value, {K} AS k FROM events WHERE event_type = 'view'""")
def wide_form(spark, d):
    wide = to_wide(event_points(spark, d), ["user"], {"value": "f", "k": "i"}, "view")
    return wide.select(F.unix_micros("ts").alias("us"), "user", "value", "k")


@query("trace_lines", f"SELECT '> ' || {_LINE_SQL} AS line FROM events")
def trace_lines(spark, d):
    return records.trace_lines(_hard_points(spark, d))


@query("value_types", """
SELECT CASE event_type WHEN 'click' THEN 'counter' WHEN 'view' THEN 'gauge' ELSE 'histogram' END AS mtype, count(*) AS n FROM events GROUP BY 1""")
def value_types(spark, d):
    pts = event_points(spark, d)
    kind = F.col("measurement")
    split = [inputs.with_type(pts.filter(cond), m) for cond, m in (
        (kind == "click", "counter"), (kind == "view", "gauge"), (~kind.isin("click", "view"), "histogram"))]
    return split[0].unionByName(split[1]).unionByName(split[2]).groupBy("mtype").agg(F.count(F.lit(1)).alias("n"))
