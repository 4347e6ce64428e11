"""Command-line entry points for the bronze and gold jobs.

    spark-submit --py-files retail_insights.zip -m retail_insights.plans.jobs \\
        churn_prediction --bronze-db bronze --target s3://bucket/gold --as-of 2025-06-30

Gold jobs read their bronze inputs from catalog tables (``--bronze-db``) or
from Parquet folders below ``--bronze-path``.  ``--publish-db`` registers every
output as a catalog table.  Without ``--as-of`` the run uses the
session's current date, as a scheduled run does.  Database credentials come
from ``--jdbc-property`` or the ``RETAIL_JDBC_USER`` / ``RETAIL_JDBC_PASSWORD``
environment variables, never from code.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from retail_insights.plans import bronze, gold, increments, rollup
from retail_insights.schemas import declared_schema
from retail_insights.session import build_session
from retail_insights.sources import land, marked, marked_typed
from retail_insights.streaming import incremental_files

BRONZE_TABLES = list(bronze.RELATIONAL_TABLES.values()) + list(bronze.DOCUMENT_TABLES.values())
GOLD_JOBS = {
    "purchase_behavior": gold.purchase_behavior,
    "churn_prediction": gold.churn_prediction,
    "fraud_detection": gold.fraud_detection,
    "omni_channel_engagement": gold.omni_channel_engagement,
}


class _Bronze(dict):
    """Bronze tables resolved lazily, by catalog name or by folder."""

    def __init__(self, spark: SparkSession, db: str | None, path: str | None):
        super().__init__()
        self.spark, self.db, self.path = spark, db, path

    def __missing__(self, name):
        if self.db:
            df = self.spark.read.table(f"{self.db}.{name}")
        else:
            df = self.spark.read.parquet(os.path.join(self.path, name))
        self[name] = df
        return df


def _pairs(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items or []:
        key, _, value = item.partition("=")
        out[key] = value
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="retail_insights.plans.jobs")
    p.add_argument("job", choices=sorted([*GOLD_JOBS, "pricing_trends", "ingest_relational",
                                          "ingest_documents", "convert_files"]))
    p.add_argument("--target", required=True, help="output folder")
    p.add_argument("--as-of", help="as-of date (YYYY-MM-DD); default: current date")
    p.add_argument("--bronze-db", help="catalog database holding the bronze tables")
    p.add_argument("--bronze-path", help="folder holding one Parquet folder per bronze table")
    p.add_argument("--publish-db", help="also register outputs in this catalog database")
    p.add_argument("--history-path", help="sales archive (Parquet), pricing_trends only")
    p.add_argument("--rollup-path", help="maintained monthly rollup, pricing_trends only")
    p.add_argument("--params", default="{}", help="JSON of operator parameters")
    p.add_argument("--jdbc-url", action="append", default=[],
                   help="SourceTable=jdbc:url, one per relational table")
    p.add_argument("--jdbc-property", action="append", default=[], help="key=value")
    p.add_argument("--jdbc-partition", action="append", default=[],
                   help="SourceTable=column,lower,upper,partitions")
    p.add_argument("--fetch-size", type=int, help="rows per JDBC round trip")
    p.add_argument("--only", action="store_true", help="ingest the named tables alone")
    p.add_argument("--typed", action="store_true", help="document exports whose values carry their type")
    p.add_argument("--ordered", action="store_true", help="sort each output as the source presents it")
    p.add_argument("--export", action="append", default=[],
                   help="bronze dataset=path of a document export (JSON lines)")
    p.add_argument("--buckets", type=int, help="buckets of the order key, with --publish-db")
    p.add_argument("--jdbc-split", action="append", default=[],
                   help="SourceTable=column[+column...],parts: balanced parts by the source's own quantiles")
    p.add_argument("--incremental", action="append", default=[],
                   help="SourceTable=key: ingest only rows above the last committed key (ingest_relational)")
    p.add_argument("--settle", type=float, help="seconds (or key units) that new rows wait, with --incremental")
    p.add_argument("--checkpoint", help="shared folder: process only files not seen before "
                                        "(convert_files, ingest_documents)")
    p.add_argument("--quarantine", help="folder for rows that do not fit, instead of stopping "
                                        "(convert_files with --schema, ingest_documents)")
    p.add_argument("--source", help="input folder, convert_files only")
    p.add_argument("--format", default="csv", help="input format, convert_files only")
    p.add_argument("--schema", help="dataset name or DDL, convert_files only")
    p.add_argument("--option", action="append", default=[], help="key=value of the reader, convert_files only")
    p.add_argument("--select", help="SQL expressions, separated by ';', that make the output (convert_files)")
    p.add_argument("--where", help="SQL condition on the input rows (convert_files)")
    return p


def _transform(select: str | None, where: str | None):
    """The transform that ``--select`` and ``--where`` write down."""
    if not (select or where):
        return None

    def transform(df):
        df = df.where(where) if where else df
        return df.selectExpr(*[e.strip() for e in select.split(";") if e.strip()]) if select else df

    return transform


def _convert(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    schema = declared_schema(a.schema) if a.schema else None
    options, transform = _pairs(a.option) or None, _transform(a.select, a.where)
    if options and a.format == "csv":
        options.setdefault("header", "true")
    if a.checkpoint or a.quarantine:
        if schema is None:
            raise SystemExit("--checkpoint and --quarantine need --schema")
        if a.checkpoint and a.quarantine:
            raise SystemExit("--checkpoint and --quarantine do not go together")
    if a.checkpoint:
        incremental_files(spark, a.source, a.target, a.checkpoint, schema, transform, a.format, options)
        return {}
    if a.quarantine:
        rows = marked(spark, a.source, schema, a.format, options)
        return land(rows, a.target, a.quarantine, transform).__dict__
    return {"rows": bronze.convert_files(spark, a.source, a.target, transform, schema, a.format, options)}


def _documents(spark: SparkSession, a: argparse.Namespace) -> dict:
    paths = _pairs(a.export)
    _check_names("--export", paths, dict.fromkeys(bronze.DOCUMENT_TABLES.values()), a.only)
    exports = {name: (path, bronze.SCHEMAS[name]) for name, path in paths.items()}
    if a.checkpoint:
        if a.typed or a.quarantine:
            raise SystemExit("--checkpoint reads plain exports and stops at rows that do not fit")
        for name, (path, schema) in exports.items():
            incremental_files(spark, path, os.path.join(a.target, name), os.path.join(a.checkpoint, name), schema,
                              format="json", options={"mode": "FAILFAST"})
        return {}
    if a.quarantine:
        read = marked_typed if a.typed else lambda s, path, schema: marked(s, path, schema, "json")
        return {name: land(read(spark, path, schema), os.path.join(a.target, name),
                           os.path.join(a.quarantine, name)).__dict__ for name, (path, schema) in exports.items()}
    return bronze.ingest_documents(spark, exports, a.target, database=a.publish_db, typed=a.typed)


def _increments(spark: SparkSession, a: argparse.Namespace, urls: dict[str, str], keys: dict[str, str],
                props: dict[str, str]) -> dict[str, int]:
    counts = {}
    for source, key in keys.items():
        name = bronze.RELATIONAL_TABLES[source]
        target = os.path.join(a.target, name)
        before = increments.committed(spark, target).rows
        mark = increments.ingest_increment(spark, urls[source], source, key, target, props,
                                           lambda df, name=name: bronze.declared(df, name), a.settle)
        counts[name] = mark.rows - before
    return counts


def _check_names(option: str, given: dict, known: dict, only: bool) -> None:
    """Every given name is known and, unless ``only``, every known one given."""
    unknown, missing = sorted(set(given) - set(known)), sorted(set(known) - set(given))
    if unknown:
        raise SystemExit(f"{option}: unknown {unknown}; known are {sorted(known)}")
    if missing and not only:
        raise SystemExit(f"{option}: missing {missing}; --only ingests the given ones alone")


def run(spark: SparkSession, argv: list[str]) -> dict[str, int]:
    a = parser().parse_args(argv)
    params = json.loads(a.params)
    if a.job in GOLD_JOBS or a.job == "pricing_trends":
        if not (a.bronze_db or a.bronze_path):
            raise SystemExit("a gold job needs --bronze-db or --bronze-path")
        tables = _Bronze(spark, a.bronze_db, a.bronze_path)
        if a.job == "pricing_trends":
            if not a.history_path:
                raise SystemExit("pricing_trends needs --history-path")
            history = spark.read.parquet(a.history_path)
            months = rollup.read_rollup(spark, a.rollup_path) if a.rollup_path else None
            return gold.pricing_trends(spark, tables, history, a.target, a.publish_db, a.ordered, rollup=months, **params)
        return GOLD_JOBS[a.job](spark, tables, a.target, a.as_of, a.publish_db, a.ordered, **params)
    if a.job == "ingest_relational":
        urls, parts = _pairs(a.jdbc_url), _pairs(a.jdbc_partition)
        _check_names("--jdbc-url", urls, bronze.RELATIONAL_TABLES, a.only)
        _check_names("--jdbc-partition", parts, urls, True)
        splits, keys = _pairs(a.jdbc_split), _pairs(a.incremental)
        _check_names("--jdbc-split", splits, urls, True)
        _check_names("--incremental", keys, urls, True)
        props = _pairs(a.jdbc_property)
        for key, env in (("user", "RETAIL_JDBC_USER"), ("password", "RETAIL_JDBC_PASSWORD")):
            if key not in props and os.environ.get(env):
                props[key] = os.environ[env]
        counts = _increments(spark, a, urls, keys, props)
        tables = []
        for source, url in urls.items():
            if source in keys:
                continue
            col = lo = hi = n = by = None
            if source in splits:
                by, _, n = splits[source].rpartition(",")
                by, n = tuple(by.split("+")), int(n)
            if source in parts:
                col, lo, hi, n = parts[source].split(",")
                n = int(n)
            tables.append(bronze.JdbcTable(url, source, bronze.RELATIONAL_TABLES[source], col, lo, hi, n,
                                           a.fetch_size, by))
        return counts | bronze.ingest_jdbc(spark, tables, a.target, props, a.publish_db, a.buckets)
    if a.job == "ingest_documents":
        return _documents(spark, a)
    if not a.source:
        raise SystemExit("convert_files needs --source")
    return _convert(spark, a)


def main(argv: list[str] | None = None) -> None:
    spark = build_session(app_name="retail_insights_job")
    counts = run(spark, sys.argv[1:] if argv is None else argv)
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
