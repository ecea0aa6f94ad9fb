"""Every query of the catalog against its checking SQL."""

import pytest
from compare import assert_same

import __spark_entry__ as entry_module
from revtrellis.catalog.registry import checking_sql, spark_queries

QUERIES, CHECKS = spark_queries(), checking_sql()


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry_offers_the_catalog():
    assert set(QUERIES) <= set(entry_module.queries()) and set(CHECKS) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_check(spark, duck, testdata, name):
    assert_same(QUERIES[name](spark, testdata).toArrow(), duck.execute(CHECKS[name]).to_arrow_table())


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns[:3] == ["market_segment", "sort_id", "metric"]
    assert df.count() > 0
