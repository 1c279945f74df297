"""Every registered query against its DuckDB statement on the smallest test data."""

import pytest

import __spark_entry__ as entry
import parity

FOLDER = "/root/testdata/sf0.001"
QUERIES, STATEMENTS = entry.queries(), entry.oracle_sql()
WITHOUT_STATEMENT = set(entry.LLM_QUERIES) - set(entry.LLM_ORACLES)


@pytest.fixture(scope="module")
def con():
    return parity.connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) - set(STATEMENTS) == WITHOUT_STATEMENT
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_result(spark, con, name):
    assert parity.difference(QUERIES[name](spark, FOLDER), con, STATEMENTS[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 25


def test_views_reconcile(spark):
    """The totals of different views over the same population agree."""
    from pyspark.sql import functions as F

    from exportlens.plans import view_builders
    from exportlens.registry import loaded_tables

    tables, views = loaded_tables(spark, FOLDER), view_builders("2001-08-01")
    frame = {n: views[n](tables) for n in ("executive_revenue", "channel_performance", "product_export_scorecard",
                                           "market_entry_readiness", "master_summary", "seasonal_intelligence")}
    total = lambda n, c: frame[n].agg(F.sum(c)).first()[0]
    revenue = "total_revenue_usd"
    assert total("executive_revenue", revenue) == total("channel_performance", revenue)
    assert total("executive_revenue", revenue) == total("product_export_scorecard", revenue)
    assert total("market_entry_readiness", revenue) == total("master_summary", revenue)
    assert total("market_entry_readiness", revenue) == total("seasonal_intelligence", revenue)
    assert total("executive_revenue", revenue) > total("master_summary", revenue)
    for column, other in [("total_returns", "total_returns"), ("return_loss_usd", "total_return_loss_usd"),
                          ("total_demurrage_usd", "total_demurrage_usd")]:
        assert total("market_entry_readiness", column) == total("product_export_scorecard", column)
        assert total("market_entry_readiness", column) == total("master_summary", other)
