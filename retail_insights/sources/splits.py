"""Balanced parallel reads of a database table.

Ranges of equal width are uneven where keys are, and a text key has no width.
The planner asks the source for its own quantiles, the keys at equal steps of
the sorted column, and makes the ranges between them: each holds about the same
number of rows, whatever the distribution and the type.  A key that fills
several steps by itself gets a range of its own, which a second column divides.

The ranges cover all values: rows without a key are in the first one, and rows
added while a read runs fall into one of them.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal(value) -> str:
    """``value`` in SQL; times in the escapes that every JDBC driver takes."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"{{ts '{value.isoformat(sep=' ')}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value.isoformat()}'}}"
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    raise TypeError(f"no ranges over values such as {value!r}")


class Source:
    """Small questions to one table of a database."""

    def __init__(self, spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None):
        self.spark, self.url, self.table, self.properties = spark, url, table, dict(properties or {})

    def column(self, name: str) -> str:
        """The table's column of that name, in any case, quoted as its database quotes."""
        reader = self.spark.read.format("jdbc").options(**self.properties).option("url", self.url)
        columns = reader.option("dbtable", self.table).load().columns  # asks for the schema alone
        found = [c for c in columns if c == name] or [c for c in columns if c.lower() == name.lower()]
        if len(found) != 1:
            raise ValueError(f"{self.table} has no column {name}; it has {columns}")
        return self.spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(found[0])

    def ask(self, query: str) -> list[tuple]:
        """Rows of a query that returns a few."""
        reader = self.spark.read.format("jdbc").options(**self.properties).option("url", self.url)
        return [tuple(r) for r in reader.option("dbtable", f"({query}) asked").load().collect()]

    def count(self, where: str) -> int:
        return self.ask(f"SELECT COUNT(*) AS n FROM {self.table} WHERE {where}")[0][0]

    def key_at(self, column: str, where: str, rank: int):
        """The key at ``rank`` of the sorted column."""
        rows = self.ask(f"SELECT {column} AS k FROM {self.table} WHERE {where} ORDER BY {column} "
                        f"OFFSET {rank} ROWS FETCH NEXT 1 ROWS ONLY")
        return rows[0][0] if rows else None


def _ranges(source: Source, columns: list[str], n: int, where: str) -> list[str]:
    """Predicates that divide the rows of ``where`` into about ``n`` equal parts."""
    if not columns or n < 2:
        return [where]
    column, known = columns[0], f"{where} AND {columns[0]} IS NOT NULL"
    total = source.count(known)
    if not total:
        return [where]
    keys = [source.key_at(column, known, k * total // n) for k in range(1, n)]
    out, low = [f"{where} AND {column} IS NULL"], known
    for key in sorted({k for k in keys if k is not None}):
        at, steps = literal(key), keys.count(key)
        out.append(f"{low} AND {column} < {at}")
        if steps > 1:  # the key alone fills a step at least
            out += _ranges(source, columns[1:], steps + 1, f"{where} AND {column} = {at}")
            low = f"{where} AND {column} > {at}"
        else:
            low = f"{where} AND {column} >= {at}"
    return [*out, low]


def _merged(source: Source, predicates: list[str], n: int) -> list[str]:
    """Neighbouring small parts together, so that about ``n`` parts remain."""
    counts = [source.count(p) for p in predicates]
    fill, out, held = sum(counts) / n, [], 0
    for p, c in zip(predicates, counts):
        if out and held + c <= 1.2 * fill:
            out[-1] = f"{out[-1]} OR {p}"
            held += c
        else:
            out.append(p)
            held = c
    return out


def plan_splits(spark: SparkSession, url: str, table: str, columns: list[str], n: int,
                properties: dict[str, str] | None = None) -> list[str]:
    """Predicates for about ``n`` balanced parallel reads.  ``columns[0]`` is
    cut at its quantiles; the others divide single keys that are too heavy.
    The driver receives one key per part, never rows."""
    source = Source(spark, url, table, properties)
    if n < 2:
        return ["1 = 1"]
    named = [source.column(c) for c in columns]
    return [f"({p})" for p in _merged(source, [f"({p})" for p in _ranges(source, named, n, "1 = 1")], n)]


def read_balanced(spark: SparkSession, url: str, table: str, columns: list[str], n: int,
                  properties: dict[str, str] | None = None, fetch_size: int | None = None) -> DataFrame:
    """Read a table in about ``n`` parallel parts of like size."""
    props = {k: str(v) for k, v in (properties or {}).items()}
    if fetch_size is not None:
        props["fetchsize"] = str(fetch_size)
    return spark.read.jdbc(url, table, predicates=plan_splits(spark, url, table, columns, n, properties),
                           properties=props)


def part_sizes(df: DataFrame) -> list[int]:
    """Rows of each part of a read, for reports and tests."""
    sizes = {r[0]: r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()}
    return [sizes.get(k, 0) for k in range(df.rdd.getNumPartitions())]
