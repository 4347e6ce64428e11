import datetime as dt
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from retail_insights import (
    customer_segments,
    peak_sales_months,
    product_growth,
    purchase_trend,
    sales_fact,
    with_history,
    yearly_retention,
    yoy_comparison,
)
from retail_insights.plans.registry import all_sales
from retail_insights.sources.fixture import Fixture

SALES = ("order_id bigint, customer_id bigint, order_date timestamp, product_id bigint, "
         "quantity int, unit_price decimal(10,2), sales_amount decimal(21,2), order_year int, "
         "order_month int")
D = Decimal


def _sales(spark, lines):
    """lines: (order_id, customer, product, year, month, quantity, unit_price)."""
    out = []
    for o, c, p, y, m, q, u in lines:
        out.append((o, c, dt.datetime(y, m, 3), p, q, D(u), D(u) * q, y, m))
    return spark.createDataFrame(out, SALES)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [(10, "bolt", "HW"), (11, "nut", "HW"), (12, "saw", "TOOLS")],
        "product_id bigint, name string, category string")


def test_sales_fact_joins_and_derives(spark):
    orders = spark.createDataFrame(
        [(1, 7, dt.datetime(2021, 5, 9), D("0")), (2, 8, dt.datetime(2021, 6, 1), D("0"))],
        "order_id bigint, customer_id bigint, order_date timestamp, total_amount decimal(12,2)")
    items = spark.createDataFrame(
        [(1, 10, 2, D("1.25")), (1, 99, 1, D("5.00")), (3, 10, 1, D("1.00")), (2, 11, 3, D("2.00"))],
        "order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2)")
    products = spark.createDataFrame([(10, "bolt", "HW"), (11, "nut", "HW")],
                                     "product_id bigint, name string, category string")
    fact = sales_fact(orders, items, products)
    assert [f.dataType.simpleString() for f in fact.schema.fields][6] == "decimal(21,2)"
    # Line with an unknown product and line of an unknown order drop out.
    assert rows(fact) == [
        (1, 7, dt.datetime(2021, 5, 9), 10, 2, D("1.25"), D("2.50"), 2021, 5),
        (2, 8, dt.datetime(2021, 6, 1), 11, 3, D("2.00"), D("6.00"), 2021, 6),
    ]


def test_with_history_conforms_by_name(spark):
    current = _sales(spark, [(1, 1, 10, 2021, 1, 1, "2.00")])
    # Archive with int keys, a string date and shuffled column order.
    history = spark.createDataFrame(
        [(3, "2019-02-01 00:00:00", 5, 10, 2, D("1.00"), D("2.00"), 2019, 2, 9)],
        "order_month int, order_date string, customer_id int, product_id int, quantity int, "
        "unit_price decimal(10,2), sales_amount decimal(21,2), order_year int, extra int, "
        "order_id int").select("order_id", "customer_id", "order_date", "product_id", "quantity",
                               "unit_price", "sales_amount", "order_year", "order_month")
    history = history.withColumn("order_month", F.lit(2)).withColumn("order_id", F.lit(3))
    both = with_history(current, history)
    assert both.schema == current.schema
    assert rows(both, "order_id", "customer_id", "order_date", "order_month") == [
        (1, 1, dt.datetime(2021, 1, 3), 1), (3, 5, dt.datetime(2019, 2, 1), 2)]


def test_purchase_trend_previous_present_month_and_calendar(spark):
    sales = _sales(spark, [
        (1, 1, 10, 2020, 1, 1, "100.00"), (1, 1, 11, 2020, 1, 1, "50.00"),
        (2, 1, 10, 2020, 1, 1, "50.00"),                       # Jan: 2 orders, 3 lines, 200
        (3, 1, 10, 2020, 3, 1, "300.00"),                      # Mar (Feb missing)
        (4, 1, 10, 2020, 4, 1, "0.00"),                        # Apr: 0
        (5, 1, 10, 2020, 5, 1, "10.00"),                       # May after a zero month
    ])
    trend = purchase_trend(sales)
    assert rows(trend, "customer_id", "order_year", "order_month", "orders_per_month", "monthly_spent",
                "previous_month_spent", "spending_growth_pct", "avg_order_value", "avg_spend_per_order") == [
        (1, 2020, 1, 2, D("200.00"), None, None, 200.0 / 3, 100.0),
        (1, 2020, 3, 1, D("300.00"), D("200.00"), 50.0, 300.0, 300.0),
        (1, 2020, 4, 1, D("0.00"), D("300.00"), -100.0, 0.0, 0.0),
        (1, 2020, 5, 1, D("10.00"), D("0.00"), None, 10.0, 10.0),
    ]
    cal = {(r.order_year, r.order_month): r.previous_month_spent for r in purchase_trend(sales, calendar=True).collect()}
    assert cal[(2020, 3)] is None and cal[(2020, 4)] == D("300.00")


def test_yearly_retention(spark):
    sales = _sales(spark, [
        (1, 1, 10, 2019, 1, 1, "1"), (2, 1, 10, 2020, 1, 1, "1"), (3, 1, 10, 2020, 5, 1, "1"),
        (4, 2, 10, 2018, 1, 1, "1"), (5, 2, 10, 2020, 1, 1, "1"),    # gap year: not retained
        (6, 3, 10, 2020, 1, 1, "1"), (7, 3, 10, 2021, 1, 1, "1"),
    ])
    assert rows(yearly_retention(sales)) == [
        (2018, 1, 0, 0.0), (2019, 1, 0, 0.0), (2020, 3, 1, 33.33), (2021, 1, 1, 100.0)]


def test_product_growth_and_zero_previous(spark, products):
    sales = _sales(spark, [
        (1, 1, 10, 2020, 1, 2, "0.00"), (2, 2, 10, 2020, 2, 3, "5.00"),
        (3, 1, 10, 2020, 2, 1, "5.00"), (4, 1, 99, 2020, 2, 1, "5.00"),  # 99: no product row
        (5, 1, 11, 2020, 6, 1, "8.00"), (6, 1, 11, 2020, 7, 1, "6.00"),
    ])
    got = rows(product_growth(sales, products))
    assert got == [
        (2020, 1, 10, "bolt", "HW", 2, D("0.00"), None, None),
        (2020, 2, 10, "bolt", "HW", 4, D("20.00"), D("0.00"), None),
        (2020, 6, 11, "nut", "HW", 1, D("8.00"), None, None),
        (2020, 7, 11, "nut", "HW", 1, D("6.00"), D("8.00"), -25.0),
    ]


def test_yoy_comparison_grains(spark, products):
    sales = _sales(spark, [
        (1, 1, 10, 2019, 3, 1, "10.00"), (2, 1, 10, 2020, 3, 1, "15.00"),
        (3, 1, 11, 2020, 3, 1, "5.00"), (4, 1, 11, 2021, 3, 1, "2.00"),
        (5, 1, 12, 2021, 3, 1, "8.00"), (6, 2, 10, 2020, 3, 1, "1.00"),
    ])
    by_product = rows(yoy_comparison(sales, products, n=1))
    assert by_product == [
        (1, 10, "bolt", "HW", 2019, 3, D("10.00"), None, None),
        (1, 10, "bolt", "HW", 2020, 3, D("15.00"), D("10.00"), 50.0),
        (1, 11, "nut", "HW", 2020, 3, D("5.00"), None, None),
        (1, 11, "nut", "HW", 2021, 3, D("2.00"), D("5.00"), -60.0),
        (1, 12, "saw", "TOOLS", 2021, 3, D("8.00"), None, None),
    ]
    by_category = rows(yoy_comparison(sales, products, n=1, grain="category"))
    assert by_category == [
        (1, "HW", 2019, 3, D("10.00"), None, None),
        (1, "HW", 2020, 3, D("20.00"), D("10.00"), 100.0),
        (1, "HW", 2021, 3, D("2.00"), D("20.00"), -90.0),
        (1, "TOOLS", 2021, 3, D("8.00"), None, None),
    ]
    with pytest.raises(ValueError):
        yoy_comparison(sales, products, grain="brand")


def test_segments_boundaries(spark):
    lines = []
    lines += [(i, 1, 10, 2021, 1, 1, "100.00") for i in range(10)]        # 10 lines, 1000: high
    lines += [(20 + i, 2, 10, 2021, 1, 1, "100.00") for i in range(9)]    # 9 lines, 900: regular
    lines += [(40 + i, 3, 10, 2021, 1, 1, "99.98") for i in range(5)]     # 499.90: occasional
    lines += [(60, 4, 10, 2021, 1, 1, "5000.00")]                         # 1 line: occasional
    segments = customer_segments(_sales(spark, lines))
    assert rows(segments, "customer_id", "customer_segment", "purchase_count", "order_count") == [
        (1, "High-Value Customer", 10, 10), (2, "Regular Customer", 9, 9), (3, "Occasional Buyer", 5, 5),
        (4, "Occasional Buyer", 1, 1)]


def test_peak_months(spark):
    sales = _sales(spark, [(1, 1, 10, 2020, 1, 1, "1.50"), (2, 2, 10, 2020, 1, 2, "1.00"),
                           (3, 1, 10, 2021, 12, 1, "9.00")])
    assert rows(peak_sales_months(sales)) == [("2020-01", D("3.50")), ("2021-12", D("9.00"))]


def test_fixture_history_split_covers_all_lines(spark):
    f = Fixture(spark, SF_SMALL)
    assert all_sales(f).count() == f.raw("lineitem").count()


def test_presented_orders_like_the_source(spark):
    from retail_insights.plans.presentation import presented
    sales = _sales(spark, [(1, 1, 10, 2020, 1, 1, "1.50"), (2, 2, 10, 2020, 2, 2, "9.00"),
                           (3, 1, 10, 2021, 12, 1, "3.00")])
    out = presented(peak_sales_months(sales), "peak_sales_months").collect()
    assert [r.year_month for r in out] == ["2020-02", "2021-12", "2020-01"]
    assert presented(sales, "unknown") is sales


def test_positions_are_those_of_one_sorted_list(spark):
    from retail_insights.plans.presentation import positioned, presented
    data = [(f"20{y:02d}-{m:02d}", None if (y + m) % 5 == 0 else D(str((y * 7 + m) % 11))) for y in range(60) for m in range(1, 13)]
    df = spark.createDataFrame(data, "year_month string, monthly_product_sales decimal(31,2)").repartition(7)
    got = positioned(df, "peak_sales_months")
    assert got.columns == ["year_month", "monthly_product_sales", "position"]
    want = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r[0], r[1]) for r in sorted(got.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in got.collect()) == list(range(1, len(data) + 1))
    assert [r[1] for r in presented(df, "peak_sales_months").collect()] == [r[1] for r in want]
    assert positioned(df.limit(0), "peak_sales_months").count() == 0
    # One value in a third of the rows still gets each place once.
    hot = positioned(spark.range(900).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).repartition(5), "unknown")
    assert [(r.k, r.v) for r in sorted(hot.collect(), key=lambda r: r.position)] == sorted((i % 3, i) for i in range(900))
