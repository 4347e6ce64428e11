"""The registered queries: each operator run over the fixture binding of one
scale-factor directory.  Every query reads whole tables; nothing is capped,
sampled or filtered to a subset of keys.  The parameters are the acceptance
parameters of the build plan (fixture as-of date, 'NATION_1%' country
pattern, default thresholds unless the name says otherwise).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retail_insights import operators as op
from retail_insights.plans.presentation import positioned
from retail_insights.sources.fixture import AS_OF, Fixture

# Fixed values of the acceptance queries.
COUNTRY_LIKE = "NATION_1%"


def _fx(spark: SparkSession, sf_dir: str) -> Fixture:
    # A skewed order join is split even where a per-order aggregate follows it.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return Fixture(spark, sf_dir)


def all_sales(f: Fixture) -> DataFrame:
    """The fact the trend queries read.  The fixture's archive holds the lines
    of its older orders, so one join of all orders gives current lines and
    archive alike; :func:`sales_fact` appends the two as a deployment does."""
    return op.conform(op.sales_fact(f.orders(), f.order_items(), f.products()))


def all_sales_by_order(f: Fixture) -> DataFrame:
    """The same fact, left on the order join's partitioning."""
    return op.conform(op.sales_fact(f.orders(), op.known_lines(f.order_items(), f.products())))


def unchecked_sales(f: Fixture, ids: list | None = None) -> DataFrame:
    """The fact for operators that join the product names themselves: that inner
    join drops unknown products, so the check need not run twice.  Named
    customers are a predicate on the scan of the orders; only their lines are
    joined."""
    orders = f.orders() if ids is None else op.of_customers(f.orders(), ids)
    return op.conform(op.sales_fact(orders, f.order_items()))


def top_customers(spark, sf_dir):
    f = _fx(spark, sf_dir)
    return op.top_customers(f.orders(), f.customers(), AS_OF, days=365, k=10,
                            country_like=COUNTRY_LIKE)


def churn_risk(spark, sf_dir):
    return op.churn_risk(_fx(spark, sf_dir).orders(), AS_OF, factor=2.0)


def high_risk_default(spark, sf_dir):
    f = _fx(spark, sf_dir)
    return op.high_risk_customers(f.logins(days=30), f.orders(), AS_OF)


def high_risk_recent(spark, sf_dir):
    f = _fx(spark, sf_dir)
    return op.high_risk_customers(f.logins(days=7), f.orders(), AS_OF, login_days=7, order_days=30)


def high_risk_strict(spark, sf_dir):
    f = _fx(spark, sf_dir)
    return op.high_risk_customers(f.logins(days=30), f.orders(), AS_OF, max_ips=12, max_attempts=16,
                                  max_spent=200000, max_orders=2)


def suspicious_logins(spark, sf_dir):
    return op.suspicious_logins(_fx(spark, sf_dir).logins(days=7), AS_OF, days=7)


def high_risk_orders(spark, sf_dir):
    return op.high_risk_orders(_fx(spark, sf_dir).orders(), AS_OF, days=30)


def interactions(spark, sf_dir):
    return op.flatten_interactions(_fx(spark, sf_dir).campaigns())


def tickets(spark, sf_dir):
    # The nested Issue struct is left out so that the comparison is on flat
    # columns; Status is the field lifted out of it.
    return op.flatten_tickets(_fx(spark, sf_dir).support()).drop("Issue")


def omni_channel(spark, sf_dir):
    f = _fx(spark, sf_dir)
    return op.omni_channel(op.flatten_interactions(f.campaigns(days=90)), f.orders(),
                           op.flatten_tickets(f.support(days=90)), AS_OF, days=90)


def sales_fact(spark, sf_dir):
    """Current lines, and the archive appended to them."""
    f = _fx(spark, sf_dir)
    current = op.sales_fact(f.current_orders(), f.order_items(), f.products())
    return op.with_history(current, f.history())


def peak_sales_months(spark, sf_dir):
    return op.peak_sales_months(all_sales(_fx(spark, sf_dir)))


def best_customers(spark, sf_dir):
    return op.best_customers(all_sales(_fx(spark, sf_dir)), n=5)


def best_customer_products(spark, sf_dir):
    f = _fx(spark, sf_dir)
    ids = op.top_customer_ids(all_sales(f), n=5)
    return op.best_customer_products(unchecked_sales(f, ids), f.products(), top=ids)


def purchase_trend(spark, sf_dir):
    return op.purchase_trend(all_sales_by_order(_fx(spark, sf_dir)))


def retention(spark, sf_dir):
    return op.yearly_retention(all_sales(_fx(spark, sf_dir)))


def product_mom_growth(spark, sf_dir):
    f = _fx(spark, sf_dir)
    return op.product_growth(unchecked_sales(f), f.products())


def _yoy(spark, sf_dir, n, grain):
    f = _fx(spark, sf_dir)
    ids = op.top_customer_ids(all_sales(f), n=n)
    return op.yoy_comparison(unchecked_sales(f, ids), f.products(), grain=grain, top=ids)


def yoy_by_product(spark, sf_dir):
    return _yoy(spark, sf_dir, 5, "product")


def yoy_by_product_wide(spark, sf_dir):
    """Enough customers for products that were bought in two years."""
    return _yoy(spark, sf_dir, 1000, "product")


def yoy_by_category(spark, sf_dir):
    return _yoy(spark, sf_dir, 5, "category")


def segments(spark, sf_dir):
    f = _fx(spark, sf_dir)
    return op.customer_segments(op.sales_fact(f.current_orders(), op.known_lines(f.order_items(), f.products())))


def monthly_rollup(spark, sf_dir):
    return op.monthly_rollup(all_sales(_fx(spark, sf_dir)))


def product_growth_positions(spark, sf_dir):
    """Month-over-month growth with each row's place in the source's order."""
    return positioned(product_mom_growth(spark, sf_dir), "month_over_month_growth_pct")


def purchase_trend_positions(spark, sf_dir):
    """The purchase trend with each row's place by customer and growth."""
    return positioned(purchase_trend(spark, sf_dir), "customer_purchase_trend")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_customers": top_customers,
    "churn_risk": churn_risk,
    "high_risk_default": high_risk_default,
    "high_risk_recent": high_risk_recent,
    "high_risk_strict": high_risk_strict,
    "suspicious_logins": suspicious_logins,
    "high_risk_orders": high_risk_orders,
    "interactions": interactions,
    "tickets": tickets,
    "omni_channel": omni_channel,
    "sales_fact": sales_fact,
    "peak_sales_months": peak_sales_months,
    "best_customers": best_customers,
    "best_customer_products": best_customer_products,
    "purchase_trend": purchase_trend,
    "retention": retention,
    "product_mom_growth": product_mom_growth,
    "yoy_by_product": yoy_by_product,
    "yoy_by_product_wide": yoy_by_product_wide,
    "yoy_by_category": yoy_by_category,
    "segments": segments,
    "monthly_rollup": monthly_rollup,
    "product_growth_positions": product_growth_positions,
    "purchase_trend_positions": purchase_trend_positions,
}
