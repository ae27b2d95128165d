"""Session settings and small plan helpers shared by all operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import add

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every operator relies on; cluster sizing is left to the submitter.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "65535",  # Spark's own; see compile_in_parts
}


def build_session(app: str = "zoneflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def compile_in_parts(spark: SparkSession) -> None:
    """For wide projections, until the next ``configure``: the virtual machine interprets methods beyond 8,000
    bytes for good, so stages that long are left to Spark's generator of single projections, which cuts them up."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count rows and bytes of the values; both are plain map-side sums."""
    def width(f: T.StructField):
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(f.name), F.lit(0))
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(f.name)))
        return F.lit(8)

    total = reduce(add, [width(f) for f in df.schema.fields])
    found = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(total), F.lit(0)).alias("bytes")).first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes


#: Frames kept until ``release``: small ones for broadcasts, and those a caller holds.
_HELD: list[DataFrame] = []


def release() -> None:
    """Drop the frames kept so far, once the results that use them are written."""
    while _HELD:
        _HELD.pop().unpersist()


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """The frame persisted while several passes, such as model fits, run over it."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def sized(df: DataFrame, held: list[DataFrame] | None = None) -> tuple[DataFrame, bool]:
    """The frame, kept and with a broadcast hint if it measured small, and whether it did.

    Persisting first means measuring is not a second evaluation. A small frame stays persisted
    and is added to ``held``, or to those that ``release`` drops. A larger one is not kept and
    carries no hint: Spark shuffles its joins as usual.
    """
    stored = df.persist(StorageLevel.MEMORY_AND_DISK)
    if not is_small(stored):
        stored.unpersist()
        return df, False
    (_HELD if held is None else held).append(stored)
    return F.broadcast(stored), True


def checked_broadcast(df: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    return sized(df, held)[0]


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the folder named by ``spark.checkpoint.dir``, or in the warehouse where that
    is unset; both are seen by all machines of a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, codec: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: read by several steps, made once, never cached. ``codec``: how its
    files are compressed, if not as the session's."""
    path = shared_path(df.sparkSession, what)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job deleted when it ends, not when the driver collects garbage."""
    conf, clean = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(clean, "false")
    conf.set(clean, "true")
    try:
        yield
    finally:
        conf.set(clean, before)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over as many tasks as a shuffle has: for rows that several passes read, out of files
    that cannot be split."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hold(df: DataFrame) -> DataFrame:
    """The frame persisted until ``release``, for callers whose result is evaluated later."""
    _HELD.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark orders NaN above every number, so range checks need NULL instead."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )
