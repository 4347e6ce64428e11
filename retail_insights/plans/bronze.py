"""Bronze ingestion (B15-B17): copy source tables unchanged into Parquet.

Each table is one read and one write; the row count is observed during the
write.  Relational reads can be split into parallel range queries.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retail_insights import schemas
from retail_insights.sinks import publish_checked, unique_key, write_checked
from retail_insights.sources import read_balanced, read_documents, read_files, read_jdbc, read_typed_documents

# Source tables and the bronze datasets they land in.
RELATIONAL_TABLES = {
    "Customers": "customers_raw",
    "Products": "products_raw",
    "Orders": "orders_raw",
    "Order_Items": "order_items_raw",
    "LoginHistory": "login_history_raw",
}
DOCUMENT_TABLES = {
    "CustomerSupport": "customer_support_raw",
    "EnterpriseCampaigns": "enterprise_campaign_raw",
}


#: Tables that must be unique by a column: later joins count on it.
UNIQUE = {"products_raw": "product_id"}
#: Tables that meet by a key can share buckets of it, so that joining them
#: needs no shuffle.
BUCKETED = {"orders_raw": ["order_id"], "order_items_raw": ["order_id"]}
#: Declared schemas of the bronze datasets.
SCHEMAS = {
    "customers_raw": schemas.CUSTOMERS,
    "products_raw": schemas.PRODUCTS,
    "orders_raw": schemas.ORDERS,
    "order_items_raw": schemas.ORDER_ITEMS,
    "login_history_raw": schemas.LOGIN_HISTORY,
    "customer_support_raw": schemas.CUSTOMER_SUPPORT,
    "enterprise_campaign_raw": schemas.ENTERPRISE_CAMPAIGN,
}


@dataclass(frozen=True)
class JdbcTable:
    """One relational source table and how to split its read."""

    url: str
    table: str
    name: str
    partition_column: str | None = None
    lower_bound: int | str | None = None
    upper_bound: int | str | None = None
    num_partitions: int | None = None
    fetch_size: int | None = None
    #: Columns whose quantiles in the source make ``num_partitions`` balanced parts.
    split_by: tuple[str, ...] | None = None


def declared(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the declared types of dataset ``name``.  Column names match
    in any case; columns that are not declared stay as they are; a declared
    column that is missing raises."""
    if name not in SCHEMAS:
        return df
    have = {c.lower(): c for c in df.columns}
    want = {f.name.lower(): f for f in SCHEMAS[name].fields}
    missing = sorted(set(want) - set(have))
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df.select([
        F.col(f"`{c}`").cast(want[k].dataType).alias(want[k].name) if k in want else F.col(f"`{c}`")
        for k, c in have.items()])


def _land(spark: SparkSession, df: DataFrame, name: str, target: str, database: str | None,
          buckets: int | None = None) -> int:
    """Stage one bronze dataset, check its unique key, and only then publish it
    (as a catalog table if ``database`` is given): a failed check leaves what
    was there before."""
    key = UNIQUE.get(name)
    checks = [unique_key(key)] if key in df.columns else []
    if database:
        by = (buckets, BUCKETED[name]) if buckets and name in BUCKETED else None
        return publish_checked(spark, df, f"{database}.{name}", target, checks, bucket_by=by)
    return write_checked(spark, df, os.path.join(target, name), checks)


def ingest_jdbc(
    spark: SparkSession,
    tables: list[JdbcTable],
    target: str,
    properties: dict[str, str] | None = None,
    database: str | None = None,
    buckets: int | None = None,
) -> dict[str, int]:
    """Copy each table in its declared types to ``<target>/<name>``, or to a
    table of ``database`` if given, there with orders and their lines in
    ``buckets`` of one order key; returns rows written per name."""
    counts = {}
    for t in tables:
        if t.split_by:
            df = read_balanced(spark, t.url, t.table, list(t.split_by), t.num_partitions, properties, t.fetch_size)
        else:
            df = read_jdbc(spark, t.url, t.table, properties, t.partition_column, t.lower_bound,
                           t.upper_bound, t.num_partitions, t.fetch_size)
        counts[t.name] = _land(spark, declared(df, t.name), t.name, target, database, buckets)
    return counts


def ingest_documents(
    spark: SparkSession,
    exports: dict[str, tuple[str, StructType | None]],
    target: str,
    format: str = "json",
    database: str | None = None,
    typed: bool = False,
) -> dict[str, int]:
    """Copy document-store exports ``{name: (path, schema)}``, nested fields
    kept, to ``<target>/<name>`` or to tables of ``database`` if given.
    ``typed`` reads exports whose values carry their type."""
    counts = {}
    for name, (path, schema) in exports.items():
        if typed:
            if schema is None:
                raise ValueError(f"{name}: a typed export needs a schema")
            df = read_typed_documents(spark, path, schema)
        else:
            df = read_documents(spark, path, schema, format)
        counts[name] = _land(spark, df, name, target, database)
    return counts


def convert_files(
    spark: SparkSession,
    source: str,
    target: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    schema: StructType | None = None,
    format: str = "csv",
    options: dict[str, str] | None = None,
) -> int:
    """Read files (CSV with header by default), apply ``transform`` and
    overwrite ``target`` with Parquet.  Returns rows written."""
    df = read_files(spark, source, format, options, schema)
    if transform is not None:
        df = df.transform(transform)
    return write_checked(spark, df, target)
