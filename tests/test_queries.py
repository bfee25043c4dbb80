"""Every registered query against its SQL twin, and its plan."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from tests.conftest import SF_DIR
from workload.oracle import ORACLE
from workload.registry import QUERIES
from workload.standins import RAW, table

NAMES = list(QUERIES)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, connection, name):
    """Equal rows, from a plan without cross joins or Python."""
    df = queries()[name](spark, SF_DIR)
    physical = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    for operator in FORBIDDEN:
        assert operator not in physical
    assert compare(name, df.toPandas(), connection, digits=12) == ""


def test_quality_checks_find_violations(spark):
    """The checks see something to find: all of them at 0 would pass without checks too."""
    broken = {(r["table_name"], r["column_name"]) for r in QUERIES["quality_of_staged"](spark, SF_DIR).collect()
              if r["violations"]}
    assert {("music_charts_historical", "track_id"), ("music_charts_historical", "position"),
            ("music_charts", "daily_rank"), ("podcast_charts", "rank")} <= broken


@pytest.mark.parametrize("raw_name, source", [
    ("music_charts", "lineitem"), ("music_charts_historical", "lineitem"), ("podcast_reviews", "orders"),
    ("podcast_shows", "part"), ("podcast_charts", "events"),
])
def test_stand_ins_hold_every_row(spark, raw_name, source):
    assert RAW[raw_name](spark, SF_DIR).count() == table(spark, SF_DIR, source).count()


def test_entry(spark):
    assert entry(spark).count() > 0
