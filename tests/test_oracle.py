"""Every registered query against its SQL twin on the smallest shared tables."""

import re
from pathlib import Path

import pytest

import oracle

SF = "/root/testdata/sf0.001"
OPTIONAL = re.compile(r"op\d+_|pipeline$")  # queries of the optional subpackage have tests of their own
SQL = [name for name in oracle.registry.oracle_sql() if not OPTIONAL.match(name)]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables not present")


def test_every_query_has_sql():
    assert set(SQL) == {name for name in oracle.registry.queries() if not OPTIONAL.match(name)}


def test_entry(spark):
    result = oracle.registry.entry(spark)
    assert sorted(result.columns) == ["category_name", "sentiment_category", "tweet_count"]
    assert result.limit(1).count() == 1


def test_correlations_have_values(spark):
    """Both sentiments occur, so the statistic is compared on numbers and not on nulls only."""
    rows = oracle.registry.queries()["point_biserial"](spark, SF).collect()
    assert sum(r["p_value"] is not None for r in rows) >= 3


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert oracle.compare(spark, name, SF) is None
