"""The monthly rollup: one row per customer, product and month.

Sums and counts of disjoint line sets add up, so the rollup of a month can be
replaced alone when lines of that month come late, and the operators on whole
months (B8, B9, B12, B13) read it in place of the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_rollup(sales: DataFrame) -> DataFrame:
    """Sales lines summed by customer, product and month.

    Output: customer_id, product_id, order_year, order_month, line_count,
    quantity, sales_amount and order_date (the month's first day, so that the
    operators that derive months from a date take the rollup as it is).  Lines
    without a date are the month NULL.
    """
    return (
        sales.groupBy("customer_id", "product_id", "order_year", "order_month")
        .agg(
            F.count("product_id").alias("line_count"),
            F.sum("quantity").alias("quantity"),
            F.sum("sales_amount").alias("sales_amount"),
        )
        .withColumn("order_date", F.make_date("order_year", "order_month", F.lit(1)))
    )
