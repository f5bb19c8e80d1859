"""Every named query against its independent SQL on the provided tables."""

from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="provided tables not found")

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_is_the_flagship(spark):
    assert entry_points.entry(spark).count() == 7


def test_comparison_notices_a_changed_value(spark, duck):
    changed = ORACLE["feed_dau"].replace("count(DISTINCT user_id) AS dau", "count(*) AS dau")
    assert changed != ORACLE["feed_dau"]
    assert differences(QUERIES["feed_dau"](spark, FOLDER), duck, changed)
