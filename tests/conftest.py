import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from celltide.session import build_session, drop_scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", 4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
