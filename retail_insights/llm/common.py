"""Helpers shared by the operators: table reading, the shared scratch folder
and materialised intermediate tables."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern ``[^\x20\x09-\x0D]+``: space and U+0009-U+000D.
WS_CLASS = "[\\x20\\x09-\\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    In local mode, where one machine is the whole cluster, an unset folder is
    replaced by a temporary one; anywhere else an unset folder is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
        root = context.getCheckpointDir()
    # One spelling of local URIs, which all file libraries take.
    return re.sub("^file:/(?!/)", "file:///", root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, grouped by application id."""
    app = spark.sparkContext.applicationId
    return os.path.join(shared_folder(spark), f"llm-{app}", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    with files that outlive any executor.  Columns are written by position where
    their names clash (``Text`` beside ``text``)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    plain = positional(df) if clashing(df) else df
    plain.write.parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)


def clashing(df: DataFrame) -> bool:
    return len({c.lower() for c in df.columns}) < len(df.columns)


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: no name can clash with another
    or with one that an operator adds."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def place(df: DataFrame, name: str) -> str:
    """The positional name of the column that is called exactly ``name``."""
    return f"c{df.columns.index(name)}"


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, found by exact name among possibly clashing extras
    (``Text`` beside ``text``)."""
    by_name = {}
    for i, n in enumerate(df.columns):
        by_name.setdefault(n, i)
    missing = [n for n in names if n not in by_name]
    if missing:
        raise ValueError(f"missing columns {missing}")
    if clashing(df):
        return positional(df).select([F.col(f"c{by_name[n]}").alias(n) for n in names])
    return df.select(*names)


def text_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Rows of texts are large: smaller Arrow batches keep a task's memory small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def release(spark: SparkSession) -> None:
    """Let Spark's context cleaner delete the shuffle files of finished steps;
    it acts when the JVM collects the plans that owned them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
