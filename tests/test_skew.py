"""A hot key holding a third of all rows: results stay whole and exact, and
the order/line join is split by AQE's skew handling.

The skewed tables are derived from the sf0.01 test tables: every third line
is moved to one order, and every third order to one customer.
"""

import contextlib
import io
import re

import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from retail_insights import churn_risk, purchase_trend, sales_fact
from retail_insights.sources.fixture import AS_OF, Fixture

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    # The hot partition repeats one key and compresses well; measured on
    # disk it is a smaller multiple of the median than its row count.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    # A partition is split along the map tasks that wrote it: small stages keep theirs.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}
HOT_ORDER = 7
HOT_CUSTOMER = 1


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark):
    f = Fixture(spark, SF_MID)
    # AQE splits a skewed partition along map outputs; the test file is one
    # row group, so spread it over 8 inputs as a multi-file table would be.
    items = f.order_items().repartition(8).withColumn(
        "order_id",
        F.when(F.xxhash64("order_id", "product_id", "quantity") % 3 == 0, F.lit(HOT_ORDER))
        .otherwise(F.col("order_id")))
    orders = f.orders().withColumn(
        "customer_id",
        F.when(F.col("order_id") % 3 == 0, F.lit(HOT_CUSTOMER)).otherwise(F.col("customer_id")))
    return f, orders, items


def _final_plan(df):
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_order_join_is_split_and_exact(spark, skew_conf):
    f, orders, items = _skewed(spark)
    # The order/line join as a cluster plans it: both sides shuffled on
    # order_id, then re-aggregated by customer (so AQE may split the hot
    # order's partition without breaking a required distribution).
    joined = orders.select("order_id", "customer_id").join(items, "order_id")
    per_customer = joined.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    plan = _final_plan(per_customer)
    assert "isFinalPlan=true" in plan
    assert re.search(r"AQEShuffleRead .*skewed", plan)
    n_hot = items.filter(F.col("order_id") == HOT_ORDER).count()
    assert n_hot > items.count() / 4
    assert per_customer.agg(F.sum("n")).collect()[0][0] == items.count()
    # The sales fact keeps every line of the hot order.
    fact = sales_fact(orders, items, f.products())
    assert fact.filter(F.col("order_id") == HOT_ORDER).count() == n_hot
    assert fact.count() == items.count()


def test_hot_customer_operators_are_exact(spark, skew_conf):
    f, orders, items = _skewed(spark)
    out = churn_risk(orders, AS_OF).filter(F.col("customer_id") == HOT_CUSTOMER).collect()
    n_hot = orders.filter(F.col("customer_id") == HOT_CUSTOMER).count()
    assert n_hot > orders.count() / 4
    # Either flagged with its full order count or not flagged at all.
    assert all(r.total_orders == n_hot for r in out)
    fact = sales_fact(orders, f.order_items(), f.products())
    trend = purchase_trend(fact).filter(F.col("customer_id") == HOT_CUSTOMER)
    total = trend.agg(F.sum("monthly_spent")).collect()[0][0]
    direct = fact.filter(F.col("customer_id") == HOT_CUSTOMER).agg(F.sum("sales_amount")) \
        .collect()[0][0]
    assert total == direct


def test_hot_product_in_the_sales_fact(spark, skew_conf):
    f = Fixture(spark, SF_MID)
    items = f.order_items().repartition(8).withColumn(
        "product_id", F.when(F.xxhash64("order_id", "quantity") % 3 == 0, F.lit(11).cast("bigint"))
        .otherwise(F.col("product_id")))
    fact = sales_fact(f.orders(), items, f.products())
    plan = _final_plan(fact.groupBy("order_year").agg(F.count(F.lit(1)).alias("n")))
    # The join with the products is split at the hot product.
    assert re.search(r"SortMergeJoin\(skew=true\) \[product_id", plan)
    assert fact.count() == items.count()
    hot = items.filter(F.col("product_id") == 11)
    assert hot.count() > items.count() / 4
    assert fact.filter(F.col("product_id") == 11).count() == hot.count()
