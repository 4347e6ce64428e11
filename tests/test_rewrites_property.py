"""Property tests: the operators equal plain computations on random inputs (NULLs, ties, gaps, single rows included)."""

import datetime as dt
from decimal import Decimal

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_churn_risk import churn_by_hand
from test_engagement import tally

from retail_insights import churn_risk, flatten_interactions, omni_channel, yearly_retention
from retail_insights.schemas import ENTERPRISE_CAMPAIGN

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.datetime(2020, 1, 1)

order_rows = st.lists(
    st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 400)), st.integers(0, 23)),
    min_size=0, max_size=30)


@SETTINGS
@given(order_rows)
def test_churn_equals_hand_computation(spark, data):
    orders = spark.createDataFrame(
        [(i, c, None if d is None else BASE + dt.timedelta(days=d, hours=h), 1.0)
         for i, (c, d, h) in enumerate(data)],
        "order_id bigint, customer_id bigint, order_date timestamp, total_amount double")
    as_of = dt.date(2021, 6, 1)
    assert rows(churn_risk(orders, as_of, 1.5)) == churn_by_hand(orders, as_of, 1.5)


def retention_by_hand(data):
    """Sets of buyers per year, in plain Python."""
    buyers = {}
    for customer, year in data:
        buyers.setdefault(year, set()).update([] if customer is None else [customer])
    out = [(y, len(c), len(c & buyers.get(y - 1, set())) if y is not None else 0) for y, c in buyers.items()]
    return sorted(out, key=lambda t: tuple((v is None, v) for v in t))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                          st.one_of(st.none(), st.integers(2015, 2022))), max_size=40))
def test_retention_equals_sets(spark, data):
    sales = spark.createDataFrame(data, "customer_id bigint, order_year int")
    got = rows(yearly_retention(sales).drop("retention_rate_pct"))
    assert got == retention_by_hand(data)


interaction = st.tuples(st.sampled_from(["Email", "Web", "App", "Fax"]),
                        st.sampled_from(["Opened", "Clicked", "Converted"]),
                        st.integers(0, 200))


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.lists(interaction, max_size=4))),
             max_size=8),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 200),
                       st.one_of(st.none(), st.integers(0, 999))), max_size=10),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 200),
                       st.sampled_from(["Open", "Resolved", "Pending"])), max_size=10),
)
def test_omni_union_equals_full_outer_joins(spark, campaigns, orders, tickets):
    day = lambda d: BASE + dt.timedelta(days=d)
    camp = spark.createDataFrame(
        [(c, "K", (0, 0), None if its is None else
          [(f"i{n}", day(d), ch, a) for n, (ch, a, d) in enumerate(its)])
         for c, its in campaigns], ENTERPRISE_CAMPAIGN)
    ords = spark.createDataFrame(
        [(i, c, day(d), None if a is None else Decimal(a)) for i, (c, d, a) in enumerate(orders)],
        "order_id bigint, customer_id bigint, order_date timestamp, total_amount decimal(12,2)")
    tix = spark.createDataFrame(
        [(c, f"t{i}", day(d), s) for i, (c, d, s) in enumerate(tickets)],
        "CustomerID bigint, TicketID string, Timestamp timestamp, Status string")
    inter = flatten_interactions(camp)
    as_of = dt.date(2020, 6, 1)
    assert rows(omni_channel(inter, ords, tix, as_of, 90)) == \
        tally(inter, ords, tix, as_of, 90)
