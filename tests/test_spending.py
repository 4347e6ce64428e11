import datetime as dt
from decimal import Decimal

from conftest import rows

from retail_insights import best_customer_products, best_customers, top_customers

CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "email", "country"]


def test_text_keys_and_dates_within_a_year(spark):
    orders = spark.createDataFrame(
        [("A-7", "2023-11-02", 40.5, "o-1"), ("A-7", "2024-02-10", 60.0, "o-2"), ("A-7", "2022-01-05", 900.0, "o-3"),
         ("B-2", "2024-05-20", 75.25, "o-4")],
        ["customer_id", "order_date", "total_amount", "order_id"])
    customers = spark.createDataFrame(
        [("A-7", "Ines", "Moreau", "im@shop.test", "United Emirates"),
         ("B-2", "Tarek", "Olin", "to@shop.test", "United Emirates")], CUSTOMER_COLS)
    columns = ("customer_id", "full_name", "total_spent", "total_orders", "spending_rank")
    # The order of 2022 lies outside the year before the as-of date.
    assert rows(top_customers(orders, customers, as_of="2024-06-30"), *columns) == [
        ("A-7", "Ines Moreau", 100.5, 2, 1), ("B-2", "Tarek Olin", 75.25, 1, 2)]
    # Half a year later only the spring order is left.
    assert rows(top_customers(orders, customers, as_of="2025-03-01"), *columns) == [
        ("B-2", "Tarek Olin", 75.25, 1, 1)]


def _orders(spark, spend):
    return spark.createDataFrame(
        [(i, c, dt.datetime(2025, 1, 10), Decimal(str(a))) for i, (c, a) in enumerate(spend)],
        "order_id bigint, customer_id bigint, order_date timestamp, total_amount decimal(12,2)")


def test_rank_ties_can_exceed_k_and_country_pattern(spark):
    spend = [(c, 100 - c) for c in range(1, 10)] + [(10, 50), (11, 50), (12, 10)]
    orders = _orders(spark, spend)
    customers = spark.createDataFrame(
        [(c, f"F{c}", f"L{c}", f"{c}@x", "United Kingdom") for c in range(1, 13)]
        + [(20, "A", "B", "a@x", "United"), (21, "C", None, "c@x", "United States")],
        CUSTOMER_COLS)
    orders = orders.unionByName(_orders(spark, [(20, 999), (21, 999)]))
    out = top_customers(orders, customers, as_of=dt.date(2025, 2, 1))
    ranks = rows(out, "customer_id", "spending_rank")
    # Customers 10 and 11 tie at rank 10: both kept, 12 dropped.
    assert [r for r in ranks if r[0] < 20] == [(c, c) for c in range(1, 11)] + [(11, 10)]
    # 'United' has no trailing space and does not match 'United %'.
    assert 20 not in [r[0] for r in ranks]
    # A NULL part makes the whole name NULL (concat semantics).
    assert rows(out.filter("customer_id = 21"), "full_name") == [(None,)]


def test_window_is_inclusive_at_start(spark):
    orders = spark.createDataFrame(
        [(1, 1, dt.datetime(2024, 1, 1), Decimal("5.00")),
         (2, 2, dt.datetime(2023, 12, 31, 23, 59), Decimal("7.00"))],
        "order_id bigint, customer_id bigint, order_date timestamp, total_amount decimal(12,2)")
    customers = spark.createDataFrame(
        [(1, "a", "b", "e", "United X"), (2, "c", "d", "f", "United X")], CUSTOMER_COLS)
    out = top_customers(orders, customers, as_of=dt.date(2024, 12, 31), days=365)
    assert rows(out, "customer_id") == [(1,)]


def _sales(spark, lines):
    return spark.createDataFrame(
        [(i, c, dt.datetime(y, m, 1), p, 1, Decimal(str(a)), Decimal(str(a)), y, m)
         for i, (c, p, y, m, a) in enumerate(lines)],
        "order_id bigint, customer_id bigint, order_date timestamp, product_id bigint, "
        "quantity int, unit_price decimal(10,2), sales_amount decimal(21,2), order_year int, "
        "order_month int")


def test_best_customers_tie_break_and_products(spark):
    sales = _sales(spark, [
        (1, 10, 2020, 1, 50), (2, 10, 2020, 1, 50), (3, 10, 2020, 1, 40),
        (1, 11, 2020, 1, 5), (1, 10, 2020, 2, 1), (1, 12, 2020, 1, 3)])
    # 1 has 59, 2 has 50, 3 has 40: n=2 keeps 1 and 2; a tie is broken by id.
    assert rows(best_customers(sales, 2)) == [(1,), (2,)]
    products = spark.createDataFrame(
        [(10, "bolt", "HW"), (11, "bolt", "HW"), (12, "nut", "HW")],
        "product_id bigint, name string, category string")
    out = best_customer_products(sales, products, n=1)
    # Products 10 and 11 share a name but stay separate rows.
    assert rows(out) == [
        (1, "2020-01", 1, "bolt", "HW", Decimal("5.00")),
        (1, "2020-01", 1, "bolt", "HW", Decimal("50.00")),
        (1, "2020-01", 1, "nut", "HW", Decimal("3.00")),
        (1, "2020-02", 1, "bolt", "HW", Decimal("1.00")),
    ]
