"""Session construction and session-derived settings."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where an aggregate uses its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "retail_insights",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    On a cluster ``master`` stays ``None`` so the launcher's choice wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  A
    job never invents a machine-local folder here: if the cluster names none,
    this raises and the caller must configure one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for it")
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    store, folder = _file_system(spark, path)
    return store.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote; one that is not there is no error."""
    store, folder = _file_system(spark, path)
    store.delete(folder, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it is not there."""
    store, folder = _file_system(spark, path)
    return [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    store, folder = _file_system(spark, path)
    if not store.rename(folder, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    store, file = _file_system(spark, path)
    stream = store.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file, with its folder; a file that is there is an error."""
    store, file = _file_system(spark, path)
    stream = store.create(file, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
