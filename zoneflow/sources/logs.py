"""Update and warning logs: their stored text form, dated files, tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions import text as tx

STAMP = "yyyy-MM-dd_HH-mm"
#: Times in stored rows keep their microseconds; rows stored without are read too.
ROW_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
READ_STAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]"

# Columns of the stored logs.
UPDATE_LOG = (
    "recid string, city_name string, cols_updated string, updated_from_nan int, "
    "updated_to_nan int, changed_vals int, out_of_range int, warnings string, editor string, "
    "edit_timestamp string, edit_type__c_u_d__ string, main_version string, "
    "old_vals string, new_vals string"
)
WARNING_LOG = (
    "city string, editor string, edit_timestamp string, recid string, warning string"
)


def stored_updates(log: DataFrame, pk: str = "recid") -> DataFrame:
    """The in-memory update log as stored: lists and rows as JSON, missing counts as -1."""
    edits = (
        F.when(F.col("edit_type") == "C", "row created")
        .when(F.col("edit_type") == "D", "row deleted")
        .otherwise(F.to_json("cols_updated"))
    )
    counts = [F.coalesce(F.col(c), F.lit(-1)).alias(c)
              for c in ("updated_from_nan", "updated_to_nan", "changed_vals", "out_of_range")]
    return log.select(
        F.col(pk).cast("string").alias("recid"), "city_name", edits.alias("cols_updated"), *counts,
        F.to_json("warnings").alias("warnings"), "editor",
        F.col("edit_timestamp").cast("string").alias("edit_timestamp"),
        F.col("edit_type").alias("edit_type__c_u_d__"),
        F.col("main_version").cast("string").alias("main_version"),
        *[F.to_json(f"{side}_row", {"timestampFormat": ROW_STAMP}).alias(f"{side}_vals") for side in ("old", "new")],
    )


def stored_warnings(log: DataFrame, pk: str = "recid") -> DataFrame:
    return log.select("city", "editor", F.col("edit_timestamp").cast("string").alias("edit_timestamp"),
                      F.col(pk).cast("string").alias("recid"), "warning")


def typed_updates(stored: DataFrame, row_schema: T.StructType, pk: str = "recid") -> DataFrame:
    """What ``table_as_of`` needs back from a stored log."""
    return stored.select(
        F.col("recid").cast(row_schema[pk].dataType).alias(pk),
        F.col("edit_type__c_u_d__").alias("edit_type"),
        F.try_to_timestamp("edit_timestamp").alias("edit_timestamp"),
        "main_version",
        F.from_json("new_vals", row_schema, {"timestampFormat": READ_STAMP}).alias("new_row"),
    )


def create_log_table(spark: SparkSession, name: str, schema: str, path: str | None = None) -> None:
    """An empty log table in the place of any of that name; its files lie in ``path``, if given."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    empty = spark.createDataFrame([], schema).write.format("parquet")
    (empty.option("path", path) if path else empty).saveAsTable(name)


def append_log(stored: DataFrame, name: str) -> None:
    stored.write.format("parquet").mode("append").saveAsTable(name)


def sorted_log(log: DataFrame, by: list[str]) -> DataFrame:
    """The log in order: dealt by range, so that its parts follow each other, and sorted within them."""
    return log.repartitionByRange(*by).sortWithinPartitions(*by)


def file_stamp(name: Column) -> Column:
    """Timestamp in ``kind_yy-mm-dd_hh-mm.csv``; years 69-99 belong to the 1900s."""
    text = F.regexp_extract(name, r"^[^_]*_(?:log_)?([0-9][^.]*)\.csv$", 1)
    return F.try_to_timestamp(F.concat(tx.full_year(F.substring_index(text, "-", 1)), F.substring(text, 3, 20)), F.lit(STAMP))


def before(named: DataFrame, cutoff: datetime, name: str = "file_name") -> DataFrame:
    """Rows of log files dated strictly before the cut-off; undated names are left out."""
    return named.where(file_stamp(F.col(name)) < F.lit(cutoff))


def logs_before(spark: SparkSession, root: str, cutoff: datetime) -> tuple[DataFrame, DataFrame]:
    """(update log, warning log) from the CSV files below ``root`` dated before ``cutoff``."""
    def read(glob: str, schema: str) -> DataFrame:
        files = (
            spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("pathGlobFilter", glob).csv(root)
        )
        return before(files.select("*", F.col("_metadata.file_name").alias("file_name")), cutoff)

    return (read("*update*.csv", UPDATE_LOG).orderBy("city_name"),
            read("*warning*.csv", WARNING_LOG).orderBy("editor"))


def log_name(kind: str, when: datetime) -> str:
    return f"{kind}_{when:%y-%m-%d_%H-%M}.csv"


def write_frequencies(counts: DataFrame, path: str) -> None:
    """City counts kept beside a model, for encoding rows it sees later."""
    counts.write.mode("overwrite").parquet(path)


def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
