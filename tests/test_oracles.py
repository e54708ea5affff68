"""Every registered query equals its DuckDB oracle (order-insensitive, like the driver's check)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, con)
    assert ok, msg


def test_rows_only_queries_run(spark):
    # every query has an oracle today; a query registered without one must at least run
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, SF_SMALL).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["day", "category_id", "revenue", "orders", "rank"]


# Segmented scans must not depend on the segment width (it only decides task sizes).
SEGMENTED = ("running_balance", "status_transitions", "odds_at_placement", "odds_periods", "outages", "request_rate",
             "job_stats", "period_rules", "up_timeline", "apply_ledger")


@pytest.mark.parametrize("name", SEGMENTED)
def test_segment_width_does_not_change_results(spark, con, name):
    from tillbook.operators.windows import SEGMENT_CONF

    spark.conf.set(SEGMENT_CONF, "3600")
    try:
        ok, msg = compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, con)
    finally:
        spark.conf.unset(SEGMENT_CONF)
    assert ok, msg


def test_flagship_pushes_filters_and_prunes_columns(spark):
    """A01 reads only the columns it needs and hands the date filter to the Parquet scan."""
    import re

    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    scans = {m.group(2): set(re.sub(r"#\d+L?", "", m.group(1)).split(","))
             for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: [^\[]*\[[^\]]*/(\w+)\.parquet\]", plan)}
    assert scans["lineitem"] == {"l_orderkey", "l_partkey", "l_quantity"}
    assert scans["orders"] == {"o_orderkey", "o_orderstatus", "o_orderdate"}
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
