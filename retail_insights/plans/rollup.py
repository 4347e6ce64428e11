"""Loading sales lines in batches, with the monthly rollup kept up to date.

The fact is partitioned by year, month and batch; a load replaces the
partitions of its own batch (dynamic partition overwrite), so repeating it,
after a crash or with corrected rows, leaves every line once.  The rollup is
partitioned by year and month; only the months that a load touches, late ones
included, are summed again from the fact and replaced.  All other months keep
their files.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retail_insights.operators import conform, monthly_rollup
from retail_insights.schemas import SALES
from retail_insights.session import delete_folder, path_exists

MONTH = ["order_year", "order_month"]
#: What Spark names the folder of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
FACT = StructType([*SALES.fields]).add("batch", "string")


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT).parquet(path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The maintained rollup, with the columns of :func:`monthly_rollup`."""
    empty = spark.createDataFrame([], SALES)
    return spark.read.schema(monthly_rollup(empty).schema).parquet(path)


def _months(df: DataFrame) -> set[tuple[int | None, int | None]]:
    """The months of ``df``: as many rows as the calendar has, whatever the lines."""
    return {(r[0], r[1]) for r in df.select(*MONTH).distinct().collect()}


def _in_months(months) -> Column:
    """A predicate on the partition columns, which prunes all other folders."""
    tests = [F.col("order_year").eqNullSafe(F.lit(y)) & F.col("order_month").eqNullSafe(F.lit(m)) for y, m in sorted(
        months, key=lambda x: (x[0] is not None, x))]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _folder(path: str, month: tuple, *more: str) -> str:
    return os.path.join(path, *[f"{c}={NULL_FOLDER if v is None else v}" for c, v in zip(MONTH, month)], *more)


def _replace(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite the partitions that ``df`` has rows for, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def load_sales(spark: SparkSession, lines: DataFrame, batch: str, fact: str, rollup: str) -> set:
    """Make ``lines`` the content of ``batch`` in the fact and bring the rollup
    up to date; returns the months that were summed again.

    A batch that is loaded again replaces its earlier rows, also in months that
    it no longer has.  A load that was lost half-way is repeated: the months
    that it had reached are found in the fact and summed again.
    """
    if not batch or any(c in batch for c in "/=%"):
        raise ValueError(f"batch name {batch!r}")
    rows = conform(lines)
    own = F.col("batch") == batch
    before = _months(read_fact(spark, fact).where(own)) if path_exists(spark, fact) else set()
    now = _months(rows)
    _replace(rows.withColumn("batch", F.lit(batch)), fact, [*MONTH, "batch"])
    for month in before - now:
        delete_folder(spark, _folder(fact, month, f"batch={batch}"))
    refresh_rollup(spark, fact, rollup, before | now)
    return before | now


def refresh_rollup(spark: SparkSession, fact: str, rollup: str, months: set | None = None) -> None:
    """Sum ``months`` (all months of the fact by default) again and replace them."""
    lines = read_fact(spark, fact)
    if months is None:
        months = _months(lines)
    held = _months(lines.where(_in_months(months)))
    if held:
        # A month's rows meet in as few files as their size asks for.
        _replace(monthly_rollup(lines.where(_in_months(held))).hint("rebalance", *MONTH), rollup, MONTH)
    for month in months - held:
        delete_folder(spark, _folder(rollup, month))
