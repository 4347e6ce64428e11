"""Sinks: one action per output.

The row count is observed during the write itself (``DataFrame.observe``),
so the plan runs once instead of once for ``count`` and once for the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_files(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Write ``df`` to ``path`` and return the number of rows written."""
    obs = Observation("write_files")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(format).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def publish_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    path: str | None = None,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> int:
    """Write ``df`` and register it in the catalog as ``name`` (``db.table``).

    With ``path`` the table is external (files stay at ``path``), which is
    how a crawler-published folder behaves.  The database is created when
    missing.  Returns the row count.
    """
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.', 1)[0]}")
    obs = Observation("publish_table")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(format)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return int(obs.get["rows"])
