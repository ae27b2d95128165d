"""Land-use labels, building types and parcel geometry."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words of a plan description that name each land use.
LAND_USES = {
    "residential": ["Residential"],
    "commercial": ["Commercial", "Business"],
    "industrial": ["Industrial", "Production"],
    "downtown": ["Downtown"],
}
GEOMETRY = "type string, coordinates array<array<array<array<double>>>>"


def any_word(column: str, words: list[str]) -> Column:
    """Description contains one of the words, by case-sensitive substring."""
    return reduce(or_, [F.col(column).contains(w) for w in words])


def described(df: DataFrame, column: str = "plu_description",
              uses: dict[str, list[str]] = LAND_USES) -> DataFrame:
    return df.where(any_word(column, [w for words in uses.values() for w in words]))


def labels(df: DataFrame, column: str = "plu_description",
           uses: dict[str, list[str]] = LAND_USES) -> DataFrame:
    """Rows whose description names exactly one land use, with that ``label``."""
    named = F.array_compact(F.array(*[
        F.when(any_word(column, words), F.lit(use)) for use, words in uses.items()
    ]))
    return df.select("*", named.alias("_named")).where(F.size("_named") == 1).select(
        *df.columns, F.col("_named")[0].alias("label")
    )


def parse_geometry(c: Column | str) -> Column:
    return F.from_json(c, GEOMETRY)


def with_centroid(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Add lon and lat: means over the vertices of the first ring of the first polygon, the
    repeated closing vertex included. ``geometry`` is GeoJSON text or already parsed."""
    shape = F.col(geometry)
    if isinstance(df.schema[geometry].dataType, T.StringType):
        shape = parse_geometry(geometry)
    zero = F.struct(F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"))
    total = F.aggregate("_ring", zero, lambda acc, v: F.struct(
        (acc["lon"] + F.get(v, F.lit(0))).alias("lon"), (acc["lat"] + F.get(v, F.lit(1))).alias("lat")))
    # One step per projection: the text is parsed once and the ring walked once per row.
    return (
        df.select("*", shape.alias("_shape"))
        .select(*df.columns, F.get(F.get("_shape.coordinates", F.lit(0)), F.lit(0)).alias("_ring"))
        .select(*df.columns, "_ring", total.alias("_total"))
        .select(*df.columns, *[
            F.try_divide(F.col("_total")[axis], F.size("_ring")).alias(axis) for axis in ("lon", "lat")
        ])
    )


def join_types(buildings: DataFrame, types: DataFrame, key: str = "building_type") -> DataFrame:
    """Buildings with their type description. The type table is broadcast when Spark finds
    it under the size threshold; otherwise AQE splits types that dominate."""
    return buildings.join(types, key)
