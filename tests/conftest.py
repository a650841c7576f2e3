import os

import pytest

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gaugeloom.session import build_session

    session = build_session(
        "gaugeloom-tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """DataFrame of literal rows under a DDL schema."""
    return lambda ddl, *data: spark.createDataFrame(list(data), ddl)
