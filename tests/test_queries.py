"""Registered queries against their SQL on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry
from check import canonical

duckdb = pytest.importorskip("duckdb")
HERE = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(HERE), reason="no test data")

# One of each kind; check.py compares all of them.
COMPARED = [
    "behavior_parse",
    "access_log_parse",
    "behavior_quarantine",
    "salted_partial_count",
    "pv_table_total",
    "hot_items_topn",
    "topn_rank_max",
    "late_revision",
    "changelog_materialize",
    "pv_retract_changelog",
    "hot_urls_report",
    "pv_changes_stream",
]


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{HERE}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    own = {query.__name__ for query in entry._QUERIES}
    assert own == set(entry._own_sql())
    assert own <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", COMPARED)
def test_equals_sql(spark, tables, name):
    got = canonical(entry.queries()[name](spark, HERE).toPandas())
    want = canonical(tables.sql(entry.oracle_sql()[name]).df())
    assert len(got) > 0
    assert list(got.columns) == list(want.columns)
    assert list(map(str, got.dtypes)) == list(map(str, want.dtypes))
    assert got.equals(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_end", "rk", "item_id", "count"]


@pytest.mark.parametrize(
    "name", ["hot_urls_topn", "pv_salted_total", "topn_rank_max", "hot_items_report"]
)
def test_no_python_in_the_plan(spark, plan, name):
    text = plan(entry.queries()[name](spark, HERE))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert operator not in text
