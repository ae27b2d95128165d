"""Audit of entry batches as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zoneflow.operators import audit
from zoneflow.session import written
from zoneflow.sources import logs


def read_entries(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
                 multi_line: bool = True) -> DataFrame:
    """Entries as they arrive: a JSON array a file, or without ``multi_line`` an object a line."""
    reader = spark.readStream.schema(schema).option("multiLine", multi_line).option("timestampFormat", logs.READ_STAMP)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def audit_entries(
    entries: DataFrame,
    master: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    pk: str = "recid",
    **options,
) -> StreamingQuery:
    """Compare every arriving batch with the master and write both logs below ``out``.

    The master is read anew per batch through ``master()``. Logs are partitioned by
    ``batch_id`` and a batch replaces its own partition whole, also by an empty one, so a batch run
    again leaves one copy and no warning of an earlier run.
    """
    def write(df: DataFrame, batch_id: int, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        found = audit.updates(master(), written(batch, "batch"), pk=pk, **options)  # parsed once, read several times
        write(logs.stored_updates(found.update_log, pk), batch_id, "updates")
        write(logs.stored_warnings(found.warning_log, pk), batch_id, "warnings")

    return (
        entries.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
