"""Incremental ingestion of database tables with a high-water mark.

Every run reads the rows whose key lies above the mark of the last committed
run and at or below the greatest key at its start, writes them as one batch
folder, and commits by writing a small state file under the batch's number.

A run that is lost before its commit leaves a batch that no reader takes; the
next run writes the same number again.  A run that is lost after it has nothing
left to do.  So every row arrives exactly once, whatever is repeated.  Two runs
at once cannot both commit a number: the second rename fails.

The key must grow with every row that is added or changed (an identity column,
or a change time).  With a time, rows may still be committed at the source with
a slightly older value: ``settle`` keeps the mark that much below the greatest.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_insights.session import list_folder, read_text, rename_folder, write_text
from retail_insights.sinks import write_files
from retail_insights.sources import read_jdbc
from retail_insights.sources.splits import Source, literal


@dataclass(frozen=True)
class Mark:
    """What has been committed: ``batch`` runs, up to key ``high``."""

    batch: int = 0
    high: str | None = None
    rows: int = 0


def _state(target: str) -> str:
    return os.path.join(target, "_state")


def committed(spark: SparkSession, target: str) -> Mark:
    """The newest committed mark below ``target``."""
    names = sorted(n for n in list_folder(spark, _state(target)) if n.endswith(".json") and not n.startswith("_"))
    return Mark(**json.loads(read_text(spark, os.path.join(_state(target), names[-1])))) if names else Mark()


def _commit(spark: SparkSession, target: str, mark: Mark) -> None:
    """Commit by one rename, which fails if another run has taken the number."""
    place = os.path.join(_state(target), f"_{uuid.uuid4().hex}.json")
    write_text(spark, place, json.dumps(mark.__dict__))
    rename_folder(spark, place, os.path.join(_state(target), f"{mark.batch:010d}.json"))


def _batch(target: str, number: int) -> str:
    return os.path.join(target, "data", f"batch={number}")


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all committed batches, with the number of their batch."""
    mark = committed(spark, target)
    if not mark.batch:
        raise FileNotFoundError(f"nothing is committed below {target}")
    held = {n for n in list_folder(spark, os.path.join(target, "data"))}
    paths = [_batch(target, k) for k in range(1, mark.batch + 1) if f"batch={k}" in held]
    return spark.read.option("basePath", os.path.join(target, "data")).parquet(*paths)


def _earlier(value, settle: float | None):
    if settle is None or value is None:
        return value
    return value - (dt.timedelta(seconds=settle) if isinstance(value, (dt.datetime, dt.date)) else type(value)(settle))


def ingest_increment(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    target: str,
    properties: dict[str, str] | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    settle: float | None = None,
    parts: int = 1,
) -> Mark:
    """Ingest what is new in ``table`` since the last committed run and return
    the mark that then holds.  ``shape`` is applied to the batch (declared
    types, say).  Rows without a key cannot be placed: they stop the run.
    ``parts`` reads the batch in that many key ranges of equal row counts."""
    source = Source(spark, url, table, properties)
    key = source.column(key)
    if source.count(f"{key} IS NULL"):
        raise ValueError(f"{table}: rows without {key}")
    mark = committed(spark, target)
    top = _earlier(source.ask(f"SELECT MAX({key}) AS k FROM {table}")[0][0], settle)
    if top is None:
        return mark
    above = "1 = 1" if mark.high is None else f"{key} > {mark.high}"
    window = f"{above} AND {key} <= {literal(top)}"
    n = source.count(window)
    if not n:
        return mark
    if parts > 1:
        cuts = sorted({source.key_at(key, window, k * n // parts) for k in range(1, parts)})
        edges = [None, *map(literal, cuts), None]
        ranges = [" AND ".join([f"({window})", *([f"{key} >= {a}"] if a else []), *([f"{key} < {b}"] if b else [])])
                  for a, b in zip(edges, edges[1:])]
        new = spark.read.jdbc(url, table, predicates=ranges, properties=dict(properties or {}))
    else:
        new = read_jdbc(spark, url, f"(SELECT * FROM {table} WHERE {window}) increment", properties)
    number = mark.batch + 1
    # Overwriting is what makes a repeated run leave the batch once.
    rows = write_files(new if shape is None else shape(new), _batch(target, number))
    after = Mark(number, literal(top), mark.rows + rows)
    _commit(spark, target, after)
    return after


def latest(df: DataFrame, id_column: str, key: str) -> DataFrame:
    """One row per id, the one with the greatest key: the current state of a
    table whose changed rows arrive again.  Map-side combined, no window."""
    rest = [c for c in df.columns if c not in (id_column, "batch")]
    newest = df.groupBy(id_column).agg(F.max_by(F.struct(*rest), F.struct(key, "batch")).alias("_row"))
    return newest.select(id_column, "_row.*")
