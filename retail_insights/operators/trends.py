"""Sales trends over the sales fact: peak months (B8), purchase trend (B10),
yearly retention (B11), product month-over-month growth (B12) and
year-over-year comparison (B13).

"Previous month/year" is the previous *present* row of the same series, as
the source defines it.  ``calendar=True`` instead requires the previous row
to be the adjacent calendar period and leaves the value NULL across a gap.

Every LAG runs after an aggregation, so a window partition holds one row per
period of one series (months or years), never raw lines: a customer or
product with a third of all sales still has one row per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_insights.functions import (
    pct_change,
    pct_of,
    ratio,
    relative_change_pct,
    year_month_label,
)
from retail_insights.operators.spending import best_customers, of_customers, summed


def _previous(value: str, partition: list[str], year: str, month: str | None,
              calendar: bool):
    """LAG of ``value`` over ``partition`` ordered by period."""
    order = [year] if month is None else [year, month]
    w = Window.partitionBy(*partition).orderBy(*order)
    prev = F.lag(value).over(w)
    if not calendar:
        return prev
    index = F.col(year) if month is None else F.col(year) * 12 + F.col(month)
    prev_index = F.lag(index).over(w)
    return F.when(prev_index == index - 1, prev)


def peak_sales_months(sales: DataFrame) -> DataFrame:
    """Sales per calendar month, over lines or their monthly rollup.  Output:
    year_month ('yyyy-MM'), monthly_product_sales."""
    return (
        sales.groupBy(F.year("order_date").alias("_y"), F.month("order_date").alias("_m"))
        .agg(summed(sales, "sales_amount").alias("monthly_product_sales"))
        .select(year_month_label("_y", "_m").alias("year_month"), "monthly_product_sales")
    )


def purchase_trend(sales: DataFrame, calendar: bool = False) -> DataFrame:
    """Monthly spend per customer and its growth against the previous month.

    Output: customer_id, order_year, order_month, orders_per_month (distinct
    orders), monthly_spent, previous_month_spent, spending_growth_pct,
    avg_order_value, avg_spend_per_order.  ``avg_order_value`` is the mean
    sales *line* amount of the month, as in the source.

    Orders are counted exactly without a distinct aggregate: each order's lines
    are summed first, on the partitioning of the order join where the fact still
    has it, and what follows are plain sums over one row per order.
    """
    month = ["customer_id", "order_year", "order_month"]
    by_order = sales.groupBy("order_id", *month).agg(
        F.sum("sales_amount").alias("_amount"), F.count("sales_amount").alias("_lines"))
    monthly = by_order.groupBy(*month).agg(
        F.count("order_id").alias("orders_per_month"),
        F.sum("_amount").cast(by_order.schema["_amount"].dataType).alias("monthly_spent"),
        ratio(F.sum("_amount"), F.sum("_lines")).alias("avg_order_value"),
    )
    prev = _previous("monthly_spent", ["customer_id"], "order_year", "order_month", calendar)
    return monthly.withColumn("previous_month_spent", prev).select(
        "customer_id", "order_year", "order_month", "orders_per_month", "monthly_spent",
        "previous_month_spent",
        pct_change("monthly_spent", "previous_month_spent").alias("spending_growth_pct"),
        "avg_order_value",
        ratio("monthly_spent", "orders_per_month").alias("avg_spend_per_order"),
    )


def yearly_retention(sales: DataFrame) -> DataFrame:
    """Share of each year's customers who also bought in the year before.

    Output: current_year, total_customers_current_year, retained_customers,
    retention_rate_pct.

    Over distinct (customer, year) pairs a customer is retained in year y
    exactly when the previous present year of that customer is y - 1, so a
    LAG over at most one row per year and customer replaces the self-join and
    both distinct counts.
    """
    years = sales.select("customer_id", "order_year").distinct()
    w = Window.partitionBy("customer_id").orderBy("order_year")
    retained = (F.lag("order_year").over(w) == F.col("order_year") - 1) & \
        F.col("customer_id").isNotNull()
    return (
        years.withColumn("retained", retained)
        .groupBy(F.col("order_year").alias("current_year"))
        .agg(
            F.count("customer_id").alias("total_customers_current_year"),
            F.count_if("retained").alias("retained_customers"),
        )
        .withColumn("retention_rate_pct",
                    pct_of("retained_customers", "total_customers_current_year"))
    )


def product_growth(sales: DataFrame, products: DataFrame, calendar: bool = False) -> DataFrame:
    """Monthly quantity and sales per product and month-over-month growth.

    Output: order_year, order_month, product_id, product_name, category,
    total_quantity_sold, total_sales_amount, previous_month_sales,
    month_over_month_growth_pct.  Products without a catalogue row drop out
    (inner join), after aggregation, so the join sees one row per product
    and month.  ``sales`` may be the monthly rollup.
    """
    monthly = sales.groupBy("order_year", "order_month", "product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        summed(sales, "sales_amount").alias("total_sales_amount"),
    )
    prev = _previous("total_sales_amount", ["product_id"], "order_year", "order_month", calendar)
    growth = monthly.withColumn("previous_month_sales", prev)
    names = products.select("product_id", F.col("name").alias("product_name"), "category")
    return growth.join(names, "product_id").select(
        "order_year", "order_month", "product_id", "product_name", "category",
        "total_quantity_sold", "total_sales_amount", "previous_month_sales",
        pct_change("total_sales_amount", "previous_month_sales").alias("month_over_month_growth_pct"),
    )


def yoy_comparison(
    sales: DataFrame,
    products: DataFrame,
    n: int = 5,
    grain: str = "product",
    calendar: bool = False,
    top: DataFrame | list | None = None,
) -> DataFrame:
    """Year-over-year monthly sales of the ``n`` best customers.

    ``grain="product"`` output: customer_id, product_id, product_name,
    category, sales_year, sales_month, monthly_sales, prev_year_sales,
    yoy_growth_percent.  ``grain="category"`` groups by category instead and
    drops product_id and product_name.  The previous year is the previous
    present year of the same (customer, item, calendar month).  ``top`` is a
    ready set of customers; ``sales`` may then hold their lines alone.  ``sales``
    may be the monthly rollup.
    """
    if grain not in ("product", "category"):
        raise ValueError(f"grain must be 'product' or 'category', not {grain!r}")
    if top is None:
        top = best_customers(sales, n)
    lines = of_customers(sales, top).select(
        "customer_id", "product_id", "sales_amount",
        F.year("order_date").alias("sales_year"),
        F.month("order_date").alias("sales_month"),
    )
    total = summed(sales, "sales_amount").alias("monthly_sales")
    names = products.select("product_id", F.col("name").alias("product_name"), "category")
    if grain == "product":
        item = ["product_id"]
        monthly = lines.groupBy("customer_id", "product_id", "sales_year", "sales_month") \
            .agg(total) \
            .join(names, "product_id")
        lead = ["customer_id", "product_id", "product_name", "category"]
    else:
        item = ["category"]
        monthly = lines.join(names, "product_id") \
            .groupBy("customer_id", "category", "sales_year", "sales_month") \
            .agg(total)
        lead = ["customer_id", "category"]
    prev = _previous("monthly_sales", ["customer_id", *item, "sales_month"], "sales_year", None,
                     calendar)
    return monthly.withColumn("prev_year_sales", prev).select(
        *lead, "sales_year", "sales_month", "monthly_sales", "prev_year_sales",
        relative_change_pct("monthly_sales", "prev_year_sales").alias("yoy_growth_percent"),
    )
