"""Physical plans of the shapes that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators.filters import FilterSpec, name_filter
from gaugeloom.operators.points import make_point
from gaugeloom.plans import database as db
from gaugeloom.queries import QUERIES
from gaugeloom.sources.landing import TABLES, read_table

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the provided tables")


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def io_waits(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "t")
    spark.createDataFrame([], TABLES["table_io_waits"]).write.parquet(path)
    return {"table_io_waits": read_table(spark, path, "table_io_waits")}


def test_wide_table_prunes_columns_and_pushes_filters(io_waits):
    table = db.table_io_waits(io_waits).table
    text = plan(table.filter(F.col("object_schema") == "shop").select("object_name", "table_io_waits_total_fetch"))
    assert "EqualTo(object_schema,shop)" in text and "Exchange" not in text
    assert "ReadSchema: struct<object_schema:string,object_name:string,count_fetch:double>" in text


def test_points_are_made_without_shuffle_or_python(io_waits):
    text = plan(db.table_io_waits(io_waits).points())
    assert "Exchange" not in text and "Python" not in text
    assert "Not(In(object_schema, [mysql,performance_schema]))" in text


def test_exact_names_reach_the_scan(spark, io_waits):
    df = io_waits["table_io_waits"]
    pts = make_point(df, F.col("object_name"), {}, {"n": F.col("count_fetch")}, F.col("collected_at"))
    assert "In(object_name, [a,b])" in plan(name_filter(pts, FilterSpec(name_pass=["a", "b"])))
    assert "StringStartsWith(object_name,net)" in plan(name_filter(pts, FilterSpec(name_pass=["net*"])))


@needs_tables
@pytest.mark.parametrize("name, node, times", [
    ("node_sections", "ArrowEvalPython", 1), ("json_flatten", "ArrowEvalPython", 1), ("json_tags", "ArrowEvalPython", 1),
    ("line_roundtrip", "ArrowEvalPython", 1), ("node_sections", "from_json(", 1), ("amqp_queues", "from_json(", 1),
    ("xml_status", "from_xml(", 1), ("cluster_health", "from_json(", 1)])
def test_replies_are_parsed_once(spark, name, node, times):
    assert plan(QUERIES[name](spark, SF)).count(node) == times


@needs_tables
@pytest.mark.parametrize("name", ["digest_topk", "first_rows"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial") and text.count("WindowGroupLimit") == 2


@needs_tables
def test_no_query_builds_a_product_or_forces_a_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, fn in QUERIES.items():
            if not name.startswith("stream"):
                text = plan(fn(spark, SF))
                assert "CartesianProduct" not in text and "NestedLoop" not in text and "Broadcast" not in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@needs_tables
@pytest.mark.parametrize("name", ["info_parse", "mntr_parse", "xml_status", "node_sections", "line_protocol", "point_filter", "json_array"])
def test_row_jobs_do_not_shuffle_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "SortMergeJoin" not in text and (name == "json_array" or "Exchange" not in text)
