"""Labelled image inventory: files are listed, never read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inventory(spark: SparkSession, root: str, pattern: str = "*.jpg") -> DataFrame:
    """(image_file, label, image_path) of root/label/*.jpg; the label is the folder name."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        .load(root).select("path")
    )
    return from_paths(listed)


def from_paths(listed: DataFrame, path: str = "path") -> DataFrame:
    parts = F.split(F.regexp_replace(F.col(path), "(?<!:)//+", "/"), "/")
    return listed.select(
        F.element_at(parts, -1).alias("image_file"),
        F.try_element_at(parts, F.lit(-2)).alias("label"),
        F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("image_path"),
    )
