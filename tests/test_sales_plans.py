"""Plans of the sales queries: best customers as predicates, exact order counts
on the join's partitioning, and the monthly rollup."""

import contextlib
import datetime as dt
import io
import os
import re
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from retail_insights import operators as op
from retail_insights.plans import registry, rollup
from retail_insights.schemas import SALES
from retail_insights.sources.fixture import Fixture

SHUFFLE_JOINS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def shuffle_joins(spark):
    old = {k: spark.conf.get(k, None) for k in SHUFFLE_JOINS}
    for k, v in SHUFFLE_JOINS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def scans(plan, table):
    return [x for x in plan.splitlines() if "FileScan" in x and f"{table}.parquet" in x]


def exchanges(plan):
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition)", plan)


@pytest.mark.parametrize("name", ["best_customer_products", "yoy_by_product", "yoy_by_product_wide", "yoy_by_category"])
def test_best_customers_reach_the_order_scan(spark, shuffle_joins, monkeypatch, name):
    first = []
    monkeypatch.setattr(op, "top_customer_ids", lambda sales, n: first.append(plan_of(sales.groupBy("customer_id").agg(
        F.sum("sales_amount")))) or list(range(1, n + 1)))
    plan = plan_of(registry.QUERIES[name](spark, SF_SMALL))
    assert len(first) == 1
    assert len(scans(plan, "lineitem")) + len(scans(first[0], "lineitem")) == 2
    assert all("o_custkey" in x.split("PushedFilters")[1] for x in scans(plan, "orders"))
    assert "LeftSemi" not in "".join(x for x in plan.splitlines() if "customer_id" in x)
    assert len(exchanges(plan)) + len(exchanges(first[0])) < 12


def test_named_customers_equal_the_semi_join(spark):
    f = Fixture(spark, SF_SMALL)
    sales = registry.all_sales(f)
    ids = op.top_customer_ids(sales, 7)
    assert ids == [r[0] for r in op.best_customers(sales, 7).collect()] and len(ids) == 7
    by_join = op.yoy_comparison(sales, f.products(), n=7)
    assert rows(op.yoy_comparison(registry.unchecked_sales(f, ids), f.products(), top=ids)) == rows(by_join)
    top = spark.createDataFrame([(i,) for i in ids], "customer_id long")
    assert rows(op.best_customer_products(sales, f.products(), top=top)) == rows(
        op.best_customer_products(sales, f.products(), top=[*ids, None]))
    assert op.of_customers(sales, []).count() == 0
    with pytest.raises(ValueError):
        op.top_customer_ids(sales, op.spending.MAX_NAMED + 1)


def test_unknown_products_drop_out_once_or_twice(spark):
    f = Fixture(spark, SF_SMALL)
    some = f.products().where("product_id % 3 > 0")
    checked = op.sales_fact(f.orders(), f.order_items(), some)
    assert 0 < checked.count() < f.order_items().count()
    assert rows(checked) == rows(op.sales_fact(f.orders(), op.known_lines(f.order_items(), some)))
    plain = op.sales_fact(f.orders(), f.order_items())
    assert rows(op.product_growth(plain, some)) == rows(op.product_growth(checked, some))
    assert rows(op.yoy_comparison(plain, some, top=[1, 2, 3])) == rows(op.yoy_comparison(checked, some, top=[1, 2, 3]))


@pytest.mark.parametrize("name", ["purchase_trend", "segments"])
def test_orders_are_counted_on_the_join_partitioning(spark, shuffle_joins, name):
    plan = plan_of(registry.QUERIES[name](spark, SF_SMALL))
    assert "distinct" not in plan and len(scans(plan, "lineitem")) == 1
    # The order key is shuffled for the join alone, once on each side.
    assert len([x for x in exchanges(plan) if re.search(r"o_orderkey|l_orderkey|order_id", x)]) == 2


def test_order_counts_equal_distinct_counts(spark):
    sales = registry.all_sales(Fixture(spark, SF_SMALL))
    # Orders over several months, customers and lines without ids.
    odd = sales.limit(0).unionByName(spark.createDataFrame(
        [(o, c, None, p, 1, Decimal("2.00"), a and Decimal(a), y, m) for o, c, p, a, y, m in [
            (1, 1, 5, "2.00", 2020, 1), (1, 1, 5, "2.00", 2020, 2), (1, 2, 5, "2.00", 2020, 1),
            (None, 1, 6, "3.00", 2020, 1), (None, 1, 7, "3.00", 2020, 1), (2, None, 5, None, None, None),
            (2, None, 6, "1.00", None, None)]], SALES))
    both = sales.unionByName(odd)
    month = ["customer_id", "order_year", "order_month"]
    want = both.groupBy(*month).agg(F.count_distinct("order_id"), F.sum("sales_amount"))
    assert rows(op.purchase_trend(both), *month, "orders_per_month", "monthly_spent") == rows(want)
    want = both.groupBy("customer_id").agg(F.count("order_id"), F.sum("sales_amount"), F.count_distinct("order_id"))
    got = op.customer_segments(both)
    assert rows(got, "customer_id", "purchase_count", "total_spent", "order_count") == rows(want)
    assert got.schema["total_spent"].dataType.simpleString() == "decimal(31,2)"


def _line(order, customer, product, day, quantity=1, price="2.00"):
    when = day and dt.datetime(*day)
    p = Decimal(price)
    return (order, customer, when, product, quantity, p, p * quantity, when and when.year, when and when.month)


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_rollup_of_late_repeated_and_replaced_batches(spark, tmp_path):
    fact, kept = str(tmp_path / "fact"), str(tmp_path / "rollup")
    load = lambda name, lines: rollup.load_sales(spark, spark.createDataFrame(lines, SALES), name, fact, kept)

    def check(*batches):
        want = op.monthly_rollup(spark.createDataFrame([x for b in batches for x in b], SALES))
        got = rollup.read_rollup(spark, kept).select(want.columns)
        assert got.dtypes == want.dtypes and rows(got) == rows(want)

    a = [_line(1, 1, 10, (2020, 1, 3)), _line(1, 1, 10, (2020, 1, 3), 4), _line(2, 2, 11, (2020, 2, 9)), _line(9, 3, 12, None)]
    assert load("a", a) == {(2020, 1), (2020, 2), (None, None)}
    check(a)
    january = {f for f in _files(kept) if "order_month=1/" in f}
    b = [_line(3, 1, 10, (2020, 2, 28), 2), _line(4, 1, 10, (2021, 3, 1)), _line(5, None, 10, (2021, 3, 1))]  # February is late
    assert load("b", b) == {(2020, 2), (2021, 3)}
    check(a, b)
    assert {f for f in _files(kept) if "order_year=2020/order_month=1/" in f} == january
    load("b", b)  # loaded again: nothing doubles
    check(a, b)
    c = [_line(4, 1, 10, (2021, 3, 1)), _line(6, 2, 12, (2021, 4, 1), 7)]  # b delivered again, without February
    assert load("b", c) == {(2020, 2), (2021, 3), (2021, 4)}
    check(a, c)
    assert load("b", []) == {(2021, 3), (2021, 4)}
    check(a)
    assert rollup.read_fact(spark, fact).count() == len(a)
    with pytest.raises(ValueError):
        load("x/y", a)


def test_a_lost_load_is_repeated(spark, tmp_path, monkeypatch):
    fact, kept = str(tmp_path / "fact"), str(tmp_path / "rollup")
    first = spark.createDataFrame([_line(1, 1, 10, (2020, 1, 3)), _line(2, 1, 10, (2020, 2, 3))], SALES)
    second = spark.createDataFrame([_line(1, 1, 10, (2020, 1, 3), 5)], SALES)
    rollup.load_sales(spark, first, "a", fact, kept)
    with monkeypatch.context() as m:
        m.setattr(rollup, "delete_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            rollup.load_sales(spark, second, "a", fact, kept)
    rollup.load_sales(spark, second, "a", fact, kept)
    assert rows(rollup.read_rollup(spark, kept), *op.monthly_rollup(second).columns) == rows(op.monthly_rollup(second))


def test_month_operators_take_the_rollup(spark, tmp_path):
    f = Fixture(spark, SF_SMALL)
    sales = registry.all_sales(f)
    rollup.load_sales(spark, sales, "all", str(tmp_path / "fact"), str(tmp_path / "rollup"))
    months = rollup.read_rollup(spark, str(tmp_path / "rollup"))
    assert rows(op.peak_sales_months(months)) == rows(op.peak_sales_months(sales))
    ids = op.top_customer_ids(sales, 20)
    assert op.top_customer_ids(months, 20) == ids
    for make in (lambda s: op.best_customer_products(s, f.products(), top=ids), lambda s: op.product_growth(s, f.products()),
                 lambda s: op.yoy_comparison(s, f.products(), top=ids),
                 lambda s: op.yoy_comparison(s, f.products(), top=ids, grain="category")):
        assert make(months).dtypes == make(sales).dtypes
        assert rows(make(months)) == rows(make(sales))
