"""Every query with an SQL text gives that text's rows; the others give rows."""

import pytest
from compare import differences, run_sql

import __spark_entry__ as registered

ORACLES = registered.oracle_sql()
ROWS_ONLY = sorted(set(registered.queries()) - set(ORACLES))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, name):
    assert differences(registered.queries()[name](spark, small), run_sql(small, ORACLES[name])) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, small, name):
    assert registered.queries()[name](spark, small).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(registered.queries())


def test_entry(spark):
    rows = registered.entry(spark)
    assert rows.columns == ["user_idx", "item_idx", "relevance", "price", "rank"]
    assert rows.count() == 150 * 5
