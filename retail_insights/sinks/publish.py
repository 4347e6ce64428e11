"""Publishing a table in one step: stage, check, then switch.

A version of the table is written to a folder of its own and checked there.
Only then is the catalog entry pointed at it, so readers see the old version or
the new one, and a failed check or a lost job leaves the old one as it was.

The switch of an unpartitioned table whose columns and buckets stay the same is
one change of its location in the catalog.  A table with other columns, or with
partitions (whose places the catalog holds one by one), is replaced by renaming
the staged one, two changes between which the name is briefly missing.

One job at a time publishes a table.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retail_insights.session import delete_folder, list_folder, path_exists, rename_folder

Check = Callable[[DataFrame], None]


class CheckFailed(ValueError):
    """A staged table breaks a rule; nothing was published."""


def unique_key(*columns: str) -> Check:
    """No two rows share a key."""

    def check(df: DataFrame) -> None:
        twice = df.groupBy(*columns).count().where("count > 1").select(*columns).take(3)
        if twice:
            raise CheckFailed(f"{', '.join(columns)} is not unique, e.g. {[tuple(r) for r in twice]}")

    return check


def not_null(*columns: str) -> Check:
    def check(df: DataFrame) -> None:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
        bad = {c: counts[c] for c in columns if counts[c]}
        if bad:
            raise CheckFailed(f"rows without a value: {bad}")

    return check


def at_least(rows: int) -> Check:
    def check(df: DataFrame) -> None:
        n = df.count()
        if n < rows:
            raise CheckFailed(f"{n} rows, at least {rows} expected")

    return check


def _checked(df: DataFrame, written: int, checks: Iterable[Check]) -> None:
    held = df.count()  # from the files' footers
    if held != written:
        raise CheckFailed(f"{written} rows were written, {held} are there")
    for check in checks:
        check(df)


def _layout(spark: SparkSession, table: str) -> tuple:
    columns = [(c.name, c.dataType, c.isPartition, c.isBucket) for c in spark.catalog.listColumns(table)]
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return columns, detail.get("Num Buckets"), detail.get("Bucket Columns"), detail.get("Sort Columns")


def location(spark: SparkSession, table: str) -> str:
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return detail["Location"]


def publish_checked(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    root: str,
    checks: Iterable[Check] = (),
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, list[str]] | None = None,
    keep: int = 2,
) -> int:
    """Publish ``df`` as catalog table ``name`` (``db.table``) and return its
    row count.  Versions lie below ``<root>/_versions/<table>``; the newest
    ``keep`` stay, for readers that began on an older one.  ``bucket_by``
    (number, columns) writes sorted buckets, on which joins and aggregates by
    these columns need no shuffle."""
    db, table = name.split(".")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    versions = os.path.join(root, "_versions", table)
    path = os.path.join(versions, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    staged = f"{db}.{table}__staged"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")  # of a job that was lost; its files go below
    obs = Observation("publish_checked")
    if bucket_by:
        # One file a bucket: rows are dealt as the buckets are.
        df = df.repartition(bucket_by[0], *bucket_by[1])
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    try:
        writer.saveAsTable(staged)
        rows = int(obs.get["rows"])
        _checked(spark.table(staged), rows, checks)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        delete_folder(spark, path)
        raise
    if not partition_by and spark.catalog.tableExists(name) and _layout(spark, name) == _layout(spark, staged):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location(spark, staged)}'")
        spark.sql(f"DROP TABLE {staged}")  # external: the files stay
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    for old in sorted(list_folder(spark, versions))[:-keep]:
        delete_folder(spark, os.path.join(versions, old))
    return rows


def write_checked(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    checks: Iterable[Check] = (),
    partition_by: list[str] | None = None,
) -> int:
    """Write ``df`` beside ``path``, check it there, and put it in the place of
    what ``path`` held; returns the row count.  The swap is two renames of
    folders, atomic one by one on a file system that renames folders at once."""
    parent, leaf = os.path.split(path.rstrip("/"))
    beside = lambda kind: os.path.join(parent, f"_{kind}-{leaf}")
    staged, old = beside("staged"), beside("replaced")
    if not path_exists(spark, path) and path_exists(spark, old):
        rename_folder(spark, old, path)  # a job was lost between the two renames
    obs = Observation("write_checked")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(staged)
        rows = int(obs.get["rows"])
        _checked(spark.read.schema(df.schema).parquet(staged), rows, checks)
    except BaseException:
        delete_folder(spark, staged)
        raise
    delete_folder(spark, old)
    if path_exists(spark, path):
        rename_folder(spark, path, old)
    rename_folder(spark, staged, path)
    delete_folder(spark, old)
    return rows
