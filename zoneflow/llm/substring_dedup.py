"""Repeated substrings by content-defined chunking with a gear hash.

The gear hash of a position depends on the last ``WINDOW`` bytes alone: h = (h << 1) + gear[byte] in
16 bits. A chunk ends where h falls below a threshold (one position in ``one_in``), if it has at
least ``least`` bytes, or at ``most`` bytes. After an insertion the cuts fall on the same content
again. Chunks are compared by their 64-bit digest.

A chunk is repeated if its digest occurs elsewhere, in the same document or another. The first one
stays (smallest doc_id, ids before none, then the text's hash, then the place in it), all others are marked. Repeated chunks that touch make a
span; spans under ``min_bytes`` are left alone, so that short common phrases stay, and with them
chance matches of single digests. A span drops the bytes of its marked chunks.

Counting is one aggregation with partial sums, and marking one join; a chunk that a third of all
documents hold combines per task in the first and is split by AQE in the second. Spans are formed
per document.

Null and empty texts have no chunk. Rows equal in doc_id and text are one document, so that a repeat of a
row drops nothing; unlike texts under one id, or without one, are documents of their own, and of what they
share one copy stays. Texts of any length are cut whole; an empty table gives an empty result; columns not
named are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import begin, map_arrow, settle

WINDOW = 16
#: One random 16-bit number per byte value, derived from a hash of the value.
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:2], "little") for b in range(256)], np.uint16)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, for all bytes at once: sums of 1, 2, 4, ... bytes are doubled."""
    h, width = GEAR[data], 1
    while width < WINDOW:
        step = h.copy()
        step[width:] += h[:-width] << np.uint16(width)
        h, width = step, 2 * width
    return h


def chunks(data: bytes, one_in: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of data."""
    marks = np.flatnonzero(gear_hash(np.frombuffer(data, np.uint8)) < 65_536 // one_in) + 1
    ends, at = [], 0
    for m in [*marks.tolist(), len(data)]:
        while m - at > most:
            at += most
            ends.append(at)
        if m - at >= least or m == len(data) and m > at:
            at = m
            ends.append(at)
    return ends


def chunk_table(docs: DataFrame, one_in: int, least: int, most: int) -> DataFrame:
    """doc_id, tag (of the text), seq, start, stop, digest."""
    begin(docs.sparkSession)

    def run(batch: pa.RecordBatch):
        row, seq, start, stop, digest, tag = [], [], [], [], [], []
        for k, text in enumerate(batch.column(1).to_pylist()):
            data = (text or "").encode()
            ends = chunks(data, one_in, least, most) if data else []
            begins = [0, *ends[:-1]]
            own = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(begins, ends, strict=False)]
            row += [k] * len(own)
            tag += [xxhash.xxh3_64_intdigest(data)] * len(own)
            seq += range(len(own))
            start += begins[:len(own)]
            stop += ends
            digest += own
        whole = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0).take(pa.array(row, pa.int64())), "tag": whole(tag), "seq": pa.array(seq, pa.int32()),
            "start": pa.array(start, pa.int32()), "stop": pa.array(stop, pa.int32()), "digest": whole(digest)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run,
                     f"doc_id {id_type}, tag long, seq int, start int, stop int, digest long", 512)


def repeated_spans(docs: DataFrame, one_in: int = 20, least: int = 16, most: int = 1024, min_bytes: int = 120) -> DataFrame:
    """doc_id, tag, start, stop, n_chunks, n_bytes_dropped, drops (byte ranges) of each repeated span."""
    rows = settle(chunk_table(docs, one_in, least, most), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag", "seq")
    twice = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    marked = rows.join(twice.drop("n"), "digest").select(
        "doc_id", "tag", "seq", "start", "stop", (~place.eqNullSafe(F.col("first"))).alias("drop"))
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "tag").orderBy("seq"))
    own = marked.repartition("doc_id", "tag").dropDuplicates(["doc_id", "tag", "seq"])  # one shuffle for all that follows
    spans = own.withColumn("island", F.col("seq") - rank).groupBy("doc_id", "tag", "island").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_chunks"),
        F.sum(F.when(F.col("drop"), F.col("stop") - F.col("start")).otherwise(0)).alias("n_bytes_dropped"),
        F.array_sort(F.collect_list(F.when(F.col("drop"), F.struct("start", "stop")))).alias("drops"))
    return spans.where(F.col("stop") - F.col("start") >= min_bytes).drop("island")


def substring_dedup(docs: DataFrame, **params) -> DataFrame:
    """doc_id, text for each row of docs, without the bytes its spans drop.

    A cut inside a character of several bytes loses that character.
    """
    spans = repeated_spans(docs, **params).groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("drops")).alias("drops"))
    begin(docs.sparkSession)

    @F.pandas_udf("long")
    def tag_of(text):
        return text.map(lambda t: np.uint64(xxhash.xxh3_64_intdigest((t or "").encode())).view(np.int64))

    @F.pandas_udf("string")
    def without(text, drops):
        def cut(t, ranges):
            data, at, out = (t or "").encode(), 0, []
            for r in sorted(ranges, key=lambda r: r["start"]) if ranges is not None else []:
                out.append(data[at:r["start"]])
                at = r["stop"]
            return b"".join([*out, data[at:]]).decode("utf-8", "ignore")
        return text.combine(drops, cut)

    t = docs.select("doc_id", "text").withColumn("tag", tag_of("text")).alias("t")
    s = spans.alias("s")
    kept = t.join(s, F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("t.tag") == F.col("s.tag")), "left")
    return kept.select("t.doc_id", without("text", "drops").alias("text"))
