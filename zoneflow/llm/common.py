"""What the operators share: the shared folder, written tables, Arrow batch mapping, word splitting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A table of at most so many narrow rows (counted, not guessed) may carry a broadcast hint.
BROADCAST_ROWS = 200_000

#: Rows of an Arrow batch; with whole documents in them, the default of 10,000 takes too much memory.
ARROW_ROWS = 1024

#: Bytes of text in a slice of a batch, unless one row has more.
SLICE_BYTES = 4_000_000

#: ASCII white space, as a regular expression class and as the characters themselves.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def begin(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and bound their batches."""
    home, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if home not in known.split(":"):
        env["PYTHONPATH"] = f"{home}:{known}".rstrip(":")
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, ARROW_ROWS)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset a local session gets a temporary folder; elsewhere there is no folder that
    all machines see, so it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_dir(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def settle(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, row: str):
    """What orders the rows that lie in struct column ``row`` as ``df`` has them; maps, which have no order,
    count by their JSON."""
    def cell(f: T.StructField):
        c = F.col(row).getField(f.name)
        return F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c

    return F.struct(*[cell(f) for f in df.schema.fields])


def slices(batch: pa.RecordBatch, rows: int, limit: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of at most ``rows`` rows and ``limit`` bytes of text; a longer text is one alone."""
    size = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type):
            size += pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    upto, at = np.concatenate([[0], np.cumsum(size)]), 0
    while at < batch.num_rows:
        n = min(rows, batch.num_rows - at, max(1, int(np.searchsorted(upto, upto[at] + limit, "right")) - 1 - at))
        yield at, n
        at += n


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | T.StructType,
              rows: int = ARROW_ROWS) -> DataFrame:
    """mapInArrow in slices of at most ``rows`` rows and ``SLICE_BYTES``, so that what a task holds stays bounded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch, rows, SLICE_BYTES):
                yield from fn(batch.slice(at, n))

    return df.mapInArrow(run, schema)


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def lower_ascii(c):
    """Lower-case A-Z and nothing else; ``lower`` does just that where all characters are ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))
