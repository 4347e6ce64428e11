"""Display order of the gold outputs.

Operators return unsorted DataFrames: a global sort is a range shuffle of
the whole result, and row order in files is not a table property.  A
consumer that shows or exports a result in the source's order sorts at the
end with :func:`presented`.  Ascending keys put NULLs first and descending
keys put them last, as Spark SQL's defaults do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_insights.session import scratch_path

# The order of each output, as the source's ORDER BY clauses
# give it, as (column, ascending) pairs.
ORDERINGS: dict[str, list[tuple[str, bool]]] = {
    "churn_risk": [("days_since_last_purchase", False)],
    "omni_channel_engagement": [("total_spent", False)],
    "peak_sales_months": [("monthly_product_sales", False)],
    "top_customers": [("customer_id", True), ("monthly_sales", False)],
    "customer_purchase_trend": [("customer_id", True), ("spending_growth_pct", True)],
    "retention_rate_pct": [("current_year", True)],
    "month_over_month_growth_pct": [("product_id", True), ("order_year", True),
                                    ("order_month", True)],
    "yoy_comparison": [("customer_id", True), ("yoy_growth_percent", False)],
}


def presented(df: DataFrame, output: str) -> DataFrame:
    """``df`` sorted the way the source presents ``output``."""
    keys = ORDERINGS.get(output)
    if not keys:
        return df
    return df.orderBy(*[F.asc(c) if up else F.desc(c) for c, up in keys])


def total_order(df: DataFrame, output: str) -> list[Column]:
    """The order of ``output``, made total by all other columns that sort."""
    keys = ORDERINGS.get(output, [])
    named = {c for c, _ in keys}
    rest = [c for c, kind in df.dtypes if c not in named and not kind.startswith(("map", "array", "struct"))]
    return [F.asc(c) if up else F.desc(c) for c, up in keys] + [F.asc(c) for c in rest]


def positioned(df: DataFrame, output: str, name: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in the order of ``output``.

    No window over the whole result, which would be one task: the rows are
    range-partitioned and sorted, each task numbers its own, and the number of
    rows in the partitions before is added.  Only those counts, one per
    partition, meet in one task.  The numbered rows are written to the shared
    folder once, since a second run of the sort could cut the ranges elsewhere.
    Rows that are equal in all columns take any of their places.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    mask = (1 << 33) - 1  # the lower bits of the id that Spark gives count rows within a partition
    df.orderBy(*total_order(df, output)).withColumns({
        "_part": F.spark_partition_id(),
        "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(mask)),
    }).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(name))
