"""High-risk customers (B3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.functions import on_or_after


def suspicious_logins(
    logins: DataFrame, as_of=None, days: int = 30, max_ips: int = 3, max_attempts: int = 10,
) -> DataFrame:
    """Customers with more than ``max_ips`` distinct IPs or more than
    ``max_attempts`` logins in the last ``days`` days."""
    return (
        logins.filter(on_or_after("login_date", as_of, days))
        .groupBy("customer_id")
        .agg(
            F.count_distinct("ip_address").alias("unique_ips"),
            F.count(F.lit(1)).alias("total_attempts"),
        )
        .filter((F.col("unique_ips") > max_ips) | (F.col("total_attempts") > max_attempts))
    )


def high_risk_orders(
    orders: DataFrame, as_of=None, days: int = 30, max_spent=5000, max_orders: int = 5,
) -> DataFrame:
    """Customers who spent more than ``max_spent`` or placed more than
    ``max_orders`` orders in the last ``days`` days."""
    return (
        orders.filter(on_or_after("order_date", as_of, days))
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("total_amount").alias("total_spent"),
        )
        .filter((F.col("total_spent") > max_spent) | (F.col("order_count") > max_orders))
    )


def high_risk_customers(
    logins: DataFrame,
    orders: DataFrame,
    as_of=None,
    login_days: int = 30,
    order_days: int = 30,
    max_ips: int = 3,
    max_attempts: int = 10,
    max_spent=5000,
    max_orders: int = 5,
) -> DataFrame:
    """Customers flagged by both their logins and their orders.

    Output: customer_id.  Both sides hold one row per customer, so the
    intersection is a semi-join and needs no DISTINCT afterwards.  The distinct
    IP count is planned as a two-level aggregate keyed first by
    (customer, ip), so a customer with most of the logins is still spread.
    """
    logins_flagged = suspicious_logins(logins, as_of, login_days, max_ips, max_attempts)
    orders_flagged = high_risk_orders(orders, as_of, order_days, max_spent, max_orders)
    return logins_flagged.select("customer_id").join(
        orders_flagged.select("customer_id"), "customer_id", "left_semi")
