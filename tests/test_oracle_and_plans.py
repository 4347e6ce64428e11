"""Every registered query against its DuckDB oracle (sf0.001), and the plan
properties the operators are built for."""

import contextlib
import io
import re

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from retail_insights.plans.oracle import ORACLE_SQL
from retail_insights.plans.registry import QUERIES
from tools.check_oracle import duck_connect, rows_of

# Row counts at sf0.001 (build plan, section 7.4, plus the B3 sides and the top five).
EXPECTED_ROWS = {
    "top_customers": 59, "churn_risk": 25, "high_risk_default": 1, "high_risk_recent": 0,
    "high_risk_strict": 0, "interactions": 600, "tickets": 201, "omni_channel": 65,
    "sales_fact": 6000, "peak_sales_months": 80, "best_customer_products": 353,
    "purchase_trend": 1387, "retention": 7, "product_mom_growth": 4950, "yoy_by_product": 353,
    "yoy_by_category": 241, "segments": 136, "suspicious_logins": 2, "high_risk_orders": 29,
    "best_customers": 5, "yoy_by_product_wide": 5933, "monthly_rollup": 5933,
    "product_growth_positions": 4950, "purchase_trend_positions": 1387,
}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_contract_keys():
    assert set(QUERIES) == set(ORACLE_SQL) == set(EXPECTED_ROWS)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "customer_id", "full_name", "email", "total_spent",
                          "total_orders", "last_purchase_date", "spending_rank"]
    assert df.count() == 59


@pytest.mark.parametrize("name", sorted(EXPECTED_ROWS))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert len(s_rows) == EXPECTED_ROWS[name]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)


def _plan(df):
    """The physical plan as ``explain()`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(EXPECTED_ROWS))
def test_no_python_in_any_plan(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)


def test_top_customers_plan(spark):
    plan = _plan(entry.queries()["top_customers"](spark, SF_SMALL))
    # The as-of window reaches the orders scan as a pushed predicate.
    assert "GreaterThanOrEqual(o_orderdate,2000-08-01T00:00)" in plan
    # rank <= k is applied per task before the shuffle by country.
    assert "WindowGroupLimit" in plan and ", Partial" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double," \
           "o_orderdate:timestamp_ntz>" in plan


def test_churn_plan_has_no_window(spark):
    plan = _plan(entry.queries()["churn_risk"](spark, SF_SMALL))
    assert "Window" not in plan
    assert plan.count("Exchange") == 1


def test_omni_channel_is_one_aggregate(spark):
    from retail_insights import omni_channel
    from retail_insights.sources.fixture import AS_OF, Fixture
    f = Fixture(spark, SF_SMALL)
    # Flat inputs, so the plan shows the operator alone.
    inter = spark.createDataFrame([], "CustomerID bigint, Timestamp timestamp, Channel string, "
                                      "Action string")
    tickets = spark.createDataFrame([], "CustomerID bigint, TicketID string, Timestamp timestamp, "
                                        "Status string")
    plan = _plan(omni_channel(inter, f.orders(), tickets, AS_OF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("name", ["suspicious_logins", "high_risk_default", "high_risk_recent", "high_risk_strict",
                                  "omni_channel"])
def test_event_time_reaches_the_scan(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    scans = [x for x in plan.splitlines() if "FileScan" in x and "events.parquet" in x]
    assert scans and all("GreaterThanOrEqual(ts," in x for x in scans)


def test_campaign_documents_need_no_shuffle(spark):
    plan = _plan(entry.queries()["interactions"](spark, SF_SMALL))
    assert "Exchange" not in plan and "collect_list" not in plan
