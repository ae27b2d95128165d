"""Token ids as flat unsigned integer files with 64-bit document offsets, read by memory mapping.

Layout of a folder, for each part p (a range of doc_ids, in order):
  part-p.ids   ids of all its documents, one after the other, little-endian, uint16 if the
               vocabulary fits and uint32 otherwise
  part-p.docs  doc_ids (int64); the first ``n_null`` of them are null
  part-p.off   n_docs + 1 offsets (uint64): where each document starts, counted over all parts

Texts are range-partitioned by doc_id and encoded by the task that writes the part. Tasks report
their sizes, one row each; the prefix sums of these rows are the parts' bases, from which the
offsets are written. A file is written under a name of its own and then renamed, so a task that
runs twice leaves one good file.

Text None counts as empty: such a document holds the end id alone. Documents of equal id stand in
the order of their texts, null ids stand first. An empty table gives a folder without parts.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import begin
from .pieces import worker_encoder

MANIFEST = "part string, n_docs long, n_null long, n_ids long, first_id long, width int"


class _File:
    """A file that appears under its name once it is whole."""

    def __init__(self, folder: str, name: str):
        self.fs, path = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(path, recursive=True)
        self.to, self.own = f"{path}/{name}", f"{path}/.{name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.out = self.fs.open_output_stream(self.own)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.fs.move(self.own, self.to)


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """The file's numbers: memory-mapped on a mounted file system, else read."""
    system, path = fs.FileSystem.from_uri(folder)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", kind, "r") if system.get_file_info(f"{path}/{name}").size else np.empty(0, kind)
    with system.open_input_stream(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), kind)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int) -> list[dict]:
    """Encode and write every text of docs; returns the manifest, one row per part, in order."""
    spark = begin(docs.sparkSession)
    wide = max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id) > 65_535
    code, width = ("I", 4) if wide else ("H", 2)

    def encode(batches):
        name = f"part-{TaskContext.get().partitionId():06d}"
        encoder, out, lengths, ids, nulls = None, None, array("Q"), array("q"), 0
        for batch in batches:
            if encoder is None:
                encoder = worker_encoder(f"ids{width}", tokenizer, lambda x: array(code, x).tobytes(), b"".join)
                end = array(code, [end_id]).tobytes()
                file = _File(folder, f"{name}.ids")
                out = file.__enter__()
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    written = encoder.of(text or "")
                    out.write(written)
                    out.write(end)
                    lengths.append(len(written) // width + 1)
                    nulls += doc_id is None
                    ids.append(doc_id or 0)
        if out is None:
            return
        file.__exit__(None)
        with _File(folder, f"{name}.docs") as f:
            f.write(ids.tobytes())
        with _File(folder, f"{name}.len") as f:
            f.write(lengths.tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": [name], "n_docs": pa.array([len(ids)], pa.int64()), "n_null": pa.array([nulls], pa.int64()),
            "n_ids": pa.array([sum(lengths)], pa.int64()), "first_id": pa.array([ids[0] if not nulls else None], pa.int64()),
            "width": pa.array([width], pa.int32())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # unlike texts under one id, or without one, spread over parts
    by = [F.col("doc_id"), F.xxhash64("text")]
    parts = rows.repartitionByRange(*by).sortWithinPartitions(*by, "text").mapInArrow(encode, MANIFEST).collect()
    parts = sorted((r.asDict() for r in parts), key=lambda r: r["part"])
    bases = [0, *accumulate(r["n_ids"] for r in parts)]
    return [r | {"base": base} for r, base in zip(parts, bases, strict=False)]


def write_offsets(spark: SparkSession, parts: list[dict], folder: str) -> DataFrame:
    """Write each part's offsets from its base; returns the manifest as a table, a row per task."""
    manifest = f"{MANIFEST}, base long"
    table = spark.createDataFrame([tuple(r.values()) for r in parts], manifest).repartition(max(1, len(parts)), "part")

    def offsets(batches):
        for batch in batches:
            for r in batch.to_pylist():
                lengths = _mapped(folder, f"{r['part']}.len", "<u8")
                with _File(folder, f"{r['part']}.off") as f:
                    f.write((np.concatenate([[0], np.cumsum(lengths)]).astype("<u8") + np.uint64(r["base"])).tobytes())
            yield batch

    table.mapInArrow(offsets, manifest).write.parquet(f"{folder}/manifest")
    return spark.read.schema(table.schema).parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 for each document of the files, one part at a time."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = _mapped(folder, f"{r['part']}.ids", f"<u{r['width']}")
                off = _mapped(folder, f"{r['part']}.off", "<u8").astype(np.int64)
                doc_ids = _mapped(folder, f"{r['part']}.docs", "<i8")
                for at in range(0, r["n_docs"], 4096):
                    to = min(at + 4096, r["n_docs"])
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(off[at:to] - r["base"], off[at + 1:to + 1] - r["base"], strict=True)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc_ids[at:to], pa.int64(), mask=np.arange(at, to) < r["n_null"]),
                        "start": pa.array(off[at:to]), "n_tokens": pa.array(np.diff(off[at:to + 1])), "ids_crc32": pa.array(crc, pa.int64())})

    return manifest.repartition(max(1, manifest.count()), "part").mapInArrow(read, schema)


def token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> DataFrame:
    """Write docs as token files below ``folder`` and return what the files hold."""
    spark = docs.sparkSession
    manifest = write_offsets(spark, write_tokens(docs, tokenizer, folder, end_id), folder)
    return read_tokens(spark, manifest, folder)
