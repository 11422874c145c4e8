"""Every registered query against its SQL, and a smoke run of those without one."""

import os

import pytest
from crosscheck import compare, duck

import __spark_entry__ as entry_points
from colloquy.plans.oracles import SMALL_ORACLES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, con):
    assert compare(name, spark, con, FOLDER, QUERIES, ORACLES) is None


@pytest.mark.parametrize("name", sorted(SMALL_ORACLES))
@pytest.mark.skipif(not FOLDER.endswith("sf0.001"), reason="too slow in SQL")
def test_query_equals_slow_sql_on_small_tables(name, spark, con):
    assert compare(name, spark, con, FOLDER, QUERIES, SMALL_ORACLES) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(name, spark):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert {r["metric"] for r in entry_points.entry(spark).collect()} == {
        "bleu", "rouge1", "rouge2", "rougeL", "avg_pred_length", "avg_latency_ms"
    }
