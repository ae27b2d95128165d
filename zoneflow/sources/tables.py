"""Declared-schema table scans, typed from text, and plain sinks."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.session import nan_to_null

# Declared column types that are cast; every other type stays text.
DECLARED_TYPES = {"number": T.DoubleType(), "calendar_date": T.TimestampType()}


def declared_schema(metadata: dict[str, str], cast_dates: bool = True) -> T.StructType:
    """Schema in metadata order from ``{field: declared type}``."""
    def kind(name: str) -> T.DataType:
        if name == "calendar_date" and not cast_dates:
            return T.StringType()
        return DECLARED_TYPES.get(name, T.StringType())

    return T.StructType([T.StructField(c, kind(t)) for c, t in metadata.items()])


def cast_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to their declared types and order. Columns the data lacks come back as
    nulls; text that does not parse becomes null."""
    def column(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        source = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.try_to_timestamp(source.cast("string")).alias(f.name)
        if isinstance(f.dataType, T.StringType):
            return source.cast("string").alias(f.name)
        return source.try_cast(f.dataType).alias(f.name)

    return nan_to_null(df.select(*[column(f) for f in schema.fields]))


def scan(
    df: DataFrame,
    select: list[str] | None = None,
    where: Column | str | None = None,
    order: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Query arguments of a table scan; filter and columns reach the file scan. No match is
    an empty typed table."""
    if where is not None:
        df = df.where(where)
    if order:
        df = df.orderBy(*order)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*select) if select else df


def row_count(df: DataFrame, where: Column | str | None = None) -> int:
    return (df.where(where) if where is not None else df).count()


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", **options) -> DataFrame:
    """parquet, orc, json or csv; text formats need a schema so that no pass infers one."""
    if schema is None and fmt in ("csv", "json"):
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, saved_index: bool = False) -> DataFrame:
    """CSV with free text: quoted commas, doubled quotes and line feeds inside a field.
    ``saved_index`` drops the unnamed row-number column in front."""
    if saved_index:
        schema = T.StructType([T.StructField("_row", T.StringType()), *schema.fields])
    df = read_table(spark, path, schema, "csv", header=True, multiLine=True, quote='"', escape='"')
    return df.drop("_row") if saved_index else df


def read_json_batch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Entries posted as one JSON array per file, or one object per line."""
    return read_table(spark, path, schema, "json", multiLine=True)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
              rows_per_read: int = 1_000_000, **properties: str) -> DataFrame:
    """Range-partitioned read of a warehouse table by an integer key, about ``rows_per_read`` keys
    a task. Ranges of a key are disjoint, which offset paging without an order is not."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high,
                           numPartitions=max(1, ceil((high - low) / rows_per_read)), properties=properties)


def columns_of(df: DataFrame) -> DataFrame:
    """(position, column, type, nullable) of a table, from its metadata."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Warehouse-style query over catalog tables and the given frames."""
    return spark.sql(sql, **tables)


def write_csv(df: DataFrame, path: str) -> None:
    """Texts as they are, with the spaces at their ends."""
    plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**plain).csv(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
