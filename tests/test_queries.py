"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import oracle
from gaugeloom.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the provided tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert name in ORACLES
    oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], SF)


def test_queries_do_not_depend_on_the_session_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("point_build", "log_totals", "cursor_batch", "statement_history", "thread_state_pivot", "stream_points"):
            oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry_point(spark):
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    row = entry.entry(spark).first()
    assert row.record.startswith('{"k":')
