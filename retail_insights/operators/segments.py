"""Customer segments (B14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Segment labels.
HIGH_VALUE = "High-Value Customer"
REGULAR = "Regular Customer"
OCCASIONAL = "Occasional Buyer"


def customer_segments(
    sales: DataFrame,
    high: tuple[int, float] = (10, 1000),
    regular: tuple[int, float] = (5, 500),
) -> DataFrame:
    """Segment customers by purchase count and spend.

    Output: customer_id, purchase_count, total_spent, last_order_date,
    customer_segment, order_count.  ``purchase_count`` counts sales lines,
    ``order_count`` orders.  A customer
    with at least ``high`` = (lines, spend) is high-value, else with at least
    ``regular`` a regular customer, else an occasional buyer.  Orders are
    counted exactly by summing each order's lines first, on the partitioning of
    the order join where the fact still has it.
    """
    by_order = sales.groupBy("order_id", "customer_id").agg(
        F.count("order_id").alias("_lines"),
        F.sum("sales_amount").alias("_amount"),
        F.max("order_date").alias("_last"),
    )
    per_customer = by_order.groupBy("customer_id").agg(
        F.sum("_lines").alias("purchase_count"),
        F.sum("_amount").cast(by_order.schema["_amount"].dataType).alias("total_spent"),
        F.max("_last").alias("last_order_date"),
        F.count("order_id").alias("order_count"),
    )
    count, spent = F.col("purchase_count"), F.col("total_spent")
    segment = (
        F.when((count >= high[0]) & (spent >= high[1]), HIGH_VALUE)
        .when((count >= regular[0]) & (spent >= regular[1]), REGULAR)
        .otherwise(OCCASIONAL)
    )
    return per_customer.withColumn("customer_segment", segment)
