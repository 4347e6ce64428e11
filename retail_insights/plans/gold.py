"""Gold jobs: read bronze tables, run the operators, write each result once.

Each job takes its bronze inputs as DataFrames (``bronze[name]``), so the
caller chooses catalog tables, paths or test frames.  The pricing job
materialises the sales fact once, as Parquet under the cluster's shared
checkpoint folder, and runs its seven outputs from that copy plus the
archive: the joins run once, the lineage is cut (a lost executor re-reads
files instead of recomputing the joins), and AQE plans the consumers from
the real size.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from retail_insights import operators as op
from retail_insights.plans.presentation import presented
from retail_insights.session import delete_folder, scratch_path
from retail_insights.sinks import publish_checked, write_checked


@contextmanager
def materialized(spark: SparkSession, df: DataFrame, name: str):
    """``df`` written below ``spark.checkpoint.dir`` and read back; the copy
    is deleted at the end."""
    path = scratch_path(spark, name)
    try:
        df.write.mode("overwrite").parquet(path)
        yield spark.read.parquet(path)
    finally:
        delete_folder(spark, path)


def _write_all(spark: SparkSession, outputs: dict[str, DataFrame], target: str,
               database: str | None, ordered: bool = False) -> dict[str, int]:
    """Publish each output as a table of ``database`` if given, else as
    ``<target>/<name>``.  ``ordered`` sorts it as the source presents it."""
    counts = {}
    for name, df in outputs.items():
        if ordered:
            df = presented(df, name)
        if database:
            counts[name] = publish_checked(spark, df, f"{database}.{name}", target)
        else:
            counts[name] = write_checked(spark, df, os.path.join(target, name))
    return counts


def purchase_behavior(spark, bronze: Mapping[str, DataFrame], target: str, as_of=None,
                      database: str | None = None, ordered: bool = False,
                      **params) -> dict[str, int]:
    out = op.top_customers(bronze["orders_raw"], bronze["customers_raw"], as_of, **params)
    return _write_all(spark, {"top_customers_by_country": out}, target, database, ordered)


def churn_prediction(spark, bronze: Mapping[str, DataFrame], target: str, as_of=None,
                     database: str | None = None, ordered: bool = False,
                      **params) -> dict[str, int]:
    out = op.churn_risk(bronze["orders_raw"], as_of, **params)
    return _write_all(spark, {"churn_risk": out}, target, database, ordered)


def fraud_detection(spark, bronze: Mapping[str, DataFrame], target: str, as_of=None,
                    database: str | None = None, ordered: bool = False,
                      **params) -> dict[str, int]:
    out = op.high_risk_customers(bronze["login_history_raw"], bronze["orders_raw"], as_of, **params)
    return _write_all(spark, {"high_risk_customers": out}, target, database, ordered)


def omni_channel_engagement(spark, bronze: Mapping[str, DataFrame], target: str, as_of=None,
                            database: str | None = None, ordered: bool = False,
                            days: int = 90) -> dict[str, int]:
    out = op.omni_channel(
        op.flatten_interactions(bronze["enterprise_campaign_raw"]),
        bronze["orders_raw"],
        op.flatten_tickets(bronze["customer_support_raw"]),
        as_of, days)
    return _write_all(spark, {"omni_channel_engagement": out}, target, database, ordered)


def pricing_trends(spark, bronze: Mapping[str, DataFrame], history: DataFrame, target: str,
                   database: str | None = None, ordered: bool = False, top_n: int = 5,
                   rollup: DataFrame | None = None) -> dict[str, int]:
    """Sales fact (current + archive) and the seven pricing outputs.

    ``rollup`` is the maintained monthly rollup of current and archived lines
    (``plans.rollup``); the four outputs on whole months then read it, and of
    the archive only the purchase trend and retention read lines.
    """
    products = bronze["products_raw"]
    current = op.sales_fact(bronze["orders_raw"], bronze["order_items_raw"], products)
    # The archive is already a file dataset; only the joined current lines
    # are written once, and the union of the two is two plain scans.
    with materialized(spark, op.conform(current), "sales_current") as current:
        sales = op.with_history(current, history)
        months = sales if rollup is None else rollup
        # The best customers, which two outputs share, are found once; their
        # ids are predicates on the scans of both.
        top = op.top_customer_ids(months, top_n)
        return _write_all(spark, {
            "peak_sales_months": op.peak_sales_months(months),
            "top_customers": op.best_customer_products(months, products, top=top),
            "customer_purchase_trend": op.purchase_trend(sales),
            "retention_rate_pct": op.yearly_retention(sales),
            "month_over_month_growth_pct": op.product_growth(months, products),
            "yoy_comparison": op.yoy_comparison(months, products, top=top),
            "customer_segments": op.customer_segments(current),
        }, target, database, ordered)
