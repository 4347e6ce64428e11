"""Sources: relational tables over JDBC, document exports, files and
catalog tables.  Each returns a lazy DataFrame; none runs an action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    NumericType,
    StringType,
    StructField,
    StructType,
)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    """Read a database table.

    Without a partition column the read is one query in one task.  With
    ``partition_column``/bounds/``num_partitions`` Spark issues that many range
    queries in parallel (the bounds only shape the ranges; rows outside them
    are still read by the first and last range); a date or timestamp column
    takes its bounds as ISO text.  Filters and projections on
    the result are pushed into the SQL sent to the database.
    Credentials come in ``properties`` from the caller, never from code.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    if fetch_size is not None:
        reader = reader.option("fetchsize", str(fetch_size))
    return reader.load()


def read_documents(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    format: str = "json",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read a document-store export (JSON lines or Parquet) with nested
    fields.  Pass ``schema`` to skip inference and keep types stable; a row
    that does not fit a declared schema then stops the read (``FAILFAST``),
    unless ``options`` name another mode."""
    return _reader(spark, format, options, schema).load(path)


def read_typed_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    item: str | None = "Item",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read a JSON-lines export whose values carry their type, such as
    ``{"Item": {"CustomerID": {"N": "7"}, "Issue": {"M": {"Status": {"S": "Open"}}}}}``,
    as plain documents of ``schema``.  ``item`` names the field around each
    document (None: no such field).  A document in which a field's value has
    another type than the schema's stops the read."""
    typed = typed_fields(schema)
    if item is not None:
        typed = StructType([StructField(item, typed)])
    df = _reader(spark, "json", options, typed).load(path)
    if item is not None:
        # A line without the item field is no document of such an export.
        df = df.select(F.when(F.col(item).isNotNull(), F.col(item)).otherwise(
            F.raise_error(F.lit(f"a document has no field {item}"))).alias("_d"))
        root = lambda name: F.col("_d")[name]
    else:
        root = F.col
    return df.select([untyped(root(f.name), f.dataType, _stop, f.name).alias(f.name) for f in schema.fields])


def typed_tag(kind: DataType) -> str:
    """The tag under which an export holds values of ``kind``."""
    if isinstance(kind, StructType):
        return "M"
    if isinstance(kind, ArrayType):
        return "L"
    return "BOOL" if isinstance(kind, BooleanType) else "N" if isinstance(kind, NumericType) else "S"


def typed_fields(schema: StructType) -> StructType:
    """The fields of documents of ``schema`` in their typed form."""
    return StructType([StructField(f.name, _typed(f.dataType)) for f in schema.fields])


def _typed(kind: DataType) -> StructType:
    """The typed form of a value: one field per tag that can hold it."""
    if isinstance(kind, StructType):
        inner = typed_fields(kind)
    elif isinstance(kind, ArrayType):
        inner = ArrayType(_typed(kind.elementType))
    else:
        inner = BooleanType() if isinstance(kind, BooleanType) else StringType()
    return StructType([StructField(typed_tag(kind), inner), StructField("NULL", BooleanType())])


def untyped(value: Column, kind: DataType, otherwise=None, path: str = "") -> Column:
    """The plain value of a typed one.  ``otherwise(path, tag)`` is what stands
    for a value under none of the expected tags (default: NULL)."""
    tag = typed_tag(kind)
    if isinstance(kind, StructType):
        inner = F.struct(*[untyped(value["M"][f.name], f.dataType, otherwise, f"{path}.{f.name}").alias(f.name)
                           for f in kind.fields])
    elif isinstance(kind, ArrayType):
        inner = F.transform(value["L"], lambda x: untyped(x, kind.elementType, otherwise, f"{path}[]"))
    else:
        inner = value[tag].try_cast(kind) if otherwise is None else value[tag].cast(kind)
    wrong = F.lit(None) if otherwise is None else otherwise(path, tag)
    return F.when(value.isNull() | F.coalesce(value["NULL"], F.lit(False)), F.lit(None)).when(
        value[tag].isNotNull(), inner).otherwise(wrong).cast(kind)


def _stop(path: str, tag: str) -> Column:
    return F.raise_error(F.lit(f"{path}: no value of type {tag}"))


def _reader(spark, format, options, schema):
    opts = dict(options or {})
    if schema is not None and format in ("csv", "json"):
        opts.setdefault("mode", "FAILFAST")
    reader = spark.read.format(format).options(**opts)
    return reader.schema(schema) if schema is not None else reader


def read_files(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    options: dict[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Generic file read; CSV defaults to a header row.  With a ``schema`` a
    row that does not fit it stops the read, as in ``read_documents``."""
    opts = {"header": "true"} if format == "csv" and options is None else options
    return _reader(spark, format, opts, schema).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header row.  Without ``schema`` every column is a string."""
    return read_files(spark, path, "csv", {"header": "true"}, schema)
