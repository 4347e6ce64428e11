"""Bad rows to a side table instead of a stopped read.

Rows that do not fit their schema are marked in the same pass that parses the
good ones: the writing of the good rows counts both kinds, and only if there
are bad ones does a second pass write them, with the reason, the source file
and the row as it stood.  The reads that stop (FAILFAST) remain beside it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from retail_insights.sources.readers import typed_fields, typed_tag, untyped

RAW, REASON, FILE, PARSED = "_raw", "_reason", "_file", "_parsed"
SIDE = [REASON, FILE, RAW]


@dataclass(frozen=True)
class Landed:
    """Rows read, and how many of them are good and bad."""

    rows: int
    good: int
    bad: int


def marked(spark: SparkSession, path: str, schema: StructType, format: str = "csv",
           options: dict[str, str] | None = None) -> DataFrame:
    """The rows of CSV or JSON files in ``schema``, and ``_reason`` (NULL for a
    good row), ``_file`` and ``_raw``."""
    opts = dict({"header": "true"} if format == "csv" and options is None else options or {})
    opts |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    wanted = StructType([*schema.fields, StructField(RAW, StringType())])
    df = spark.read.format(format).options(**opts).schema(wanted).load(path)
    reason = F.when(F.col(RAW).isNotNull(), F.lit("the row does not fit the declared columns"))
    return df.select(*[F.col(f.name) for f in schema.fields], reason.alias(REASON),
                     F.col("_metadata.file_path").alias(FILE), RAW)


def _mismatch(value: Column, kind: DataType, path: str) -> Column:
    """What is wrong with a typed value (NULL: nothing)."""
    tag = typed_tag(kind)
    null = value.isNull() | F.coalesce(value["NULL"], F.lit(False))
    wrong = F.when(value[tag].isNull(), F.lit(f"{path}: no value of type {tag}"))
    if isinstance(kind, StructType):
        inner = F.coalesce(*[_mismatch(value["M"][f.name], f.dataType, f"{path}.{f.name}") for f in kind.fields], F.lit(None))
    elif isinstance(kind, ArrayType):
        found = F.filter(F.transform(value["L"], lambda x: _mismatch(x, kind.elementType, f"{path}[]")), lambda x: x.isNotNull())
        inner = F.get(found, F.lit(0))
    elif tag == "N":
        inner = F.when(value["N"].isNotNull() & value["N"].try_cast(kind).isNull(), F.concat(
            F.lit(f"{path}: no {kind.simpleString()}: "), value["N"]))
    elif tag == "S" and not isinstance(kind, StringType):
        inner = F.when(value["S"].isNotNull() & value["S"].try_cast(kind).isNull(), F.concat(
            F.lit(f"{path}: no {kind.simpleString()}: "), value["S"]))
    else:
        inner = F.lit(None).cast("string")
    return F.when(~null, F.coalesce(wrong, inner))


def marked_typed(spark: SparkSession, path: str, schema: StructType, item: str | None = "Item") -> DataFrame:
    """Like :func:`marked` for exports whose values carry their type."""
    typed = typed_fields(schema)
    if item is not None:
        typed = StructType([StructField(item, typed)])
    parsed = spark.read.text(path).select(
        F.col("value").alias(RAW), F.col("_metadata.file_path").alias(FILE)).where(F.trim(RAW) != "").withColumn(
        "_d", F.from_json(RAW, StructType([*typed.fields, StructField("_corrupt", StringType())]),
                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    doc = F.col("_d")[item] if item is not None else F.col("_d")
    reason = F.when(F.col("_d._corrupt").isNotNull(), F.lit("the line is no such document"))
    if item is not None:
        reason = F.coalesce(reason, F.when(doc.isNull(), F.lit(f"a document has no field {item}")))
    reason = F.coalesce(reason, *[_mismatch(doc[f.name], f.dataType, f.name) for f in schema.fields])
    judged = parsed.select("_d", FILE, RAW, reason.alias(REASON))
    values = [F.when(F.col(REASON).isNull(), untyped(doc[f.name], f.dataType)).alias(f.name) for f in schema.fields]
    return judged.select(*values, REASON, FILE, RAW)


def land(df: DataFrame, target: str, side: str,
         transform: Callable[[DataFrame], DataFrame] | None = None) -> Landed:
    """Write the good rows of a marked table, after ``transform``, to ``target``
    and the bad ones, with what could be parsed of them, to ``side``; the counts
    of both add up to the rows read."""
    # The parsers judge rows by the columns that a query reads: both passes read all.
    told = df.withColumn(PARSED, F.to_json(F.struct(*[c for c in df.columns if c not in SIDE])))
    bad_rows = told.where(F.col(REASON).isNotNull()).select(*SIDE, PARSED)
    obs = Observation("land")
    bad = F.col(REASON).isNotNull()
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"))
    good = seen.where(~bad).drop(*SIDE)
    (good if transform is None else transform(good)).write.mode("overwrite").parquet(target)
    rows, n_bad = int(obs.get["rows"]), int(obs.get["bad"])
    if n_bad:
        again = Observation("quarantine")
        bad_rows.observe(again, F.count(F.lit(1)).alias("bad")).write.mode("overwrite").parquet(side)
        if int(again.get["bad"]) != n_bad:
            raise RuntimeError(f"{n_bad} bad rows were seen, {again.get['bad']} written: the files changed meanwhile")
    else:
        df.sparkSession.createDataFrame([], bad_rows.schema).write.mode("overwrite").parquet(side)
    return Landed(rows, rows - n_bad, n_bad)
