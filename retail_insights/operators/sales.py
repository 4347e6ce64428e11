"""The sales fact (B7): current order lines plus the historical archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.schemas import SALES


def known_lines(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """The order lines whose product exists.  Products are unique by
    ``product_id`` (bronze ingestion checks it); only their key is read."""
    lines = order_items.select("order_id", "product_id", "quantity", "unit_price")
    return lines.join(products.select("product_id"), "product_id", "left_semi")


def sales_fact(orders: DataFrame, order_items: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """One row per order line whose order and product exist.

    Output (in order): order_id, customer_id, order_date, product_id,
    quantity, unit_price, sales_amount = quantity * unit_price, order_year,
    order_month.

    Lines meet their orders first, so a filter on the orders reduces the lines
    before anything else is shuffled, and tables bucketed by ``order_id`` join
    without an exchange.  The product check comes after it, as an inner join on
    the unique product key (a semi-join would be pushed below the order join,
    and all lines shuffled by product first).  It leaves the fact partitioned by
    product when products are too many to broadcast.

    Without ``products`` the lines are taken as known (:func:`known_lines`).
    The fact then keeps the join's partitioning by order, on which a per-order
    aggregate needs no further shuffle.
    """
    joined = orders.select("order_id", "customer_id", "order_date").join(
        order_items.select("order_id", "product_id", "quantity", "unit_price"), "order_id")
    if products is not None:
        joined = joined.join(products.select("product_id"), "product_id")
    return joined.select(
        "order_id", "customer_id", "order_date", "product_id", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("sales_amount"),
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
    )


def conform(sales: DataFrame) -> DataFrame:
    """``sales`` with the names, order and types of :data:`schemas.SALES`."""
    return sales.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES.fields])


def with_history(sales: DataFrame, history: DataFrame) -> DataFrame:
    """Current sales plus the historical archive, duplicates kept.

    Both sides are cast to the declared sales schema by name, so neither a
    column order nor a type of the archive files can shift or widen values.
    """
    return conform(sales).unionByName(conform(history))
