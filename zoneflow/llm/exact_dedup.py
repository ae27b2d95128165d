"""Exact duplicates through an extendible-hash index in shared files; DataFrame functions only.

1. A scan writes doc_id, 64-bit key of the normalised text and its digest for each row.
2. The directory is grown by doubling: a bucket is a prefix of the key; while it holds more than
   ``capacity`` different (key, digest) it is split by one more bit, up to ``MAX_DEPTH``. It is computed
   from the histogram of the first ``MAX_DEPTH`` bits, so it has at most 65,536 rows whatever the input.
   A bucket that is overfull at that depth keeps all its records.
3. Texts go through the directory, from the key's slot to the bucket, to the task that owns the bucket.
   Copies are added up before, per ``SALTS`` parts of the input: of a text that a third of all rows
   hold, an owner gets ``SALTS`` records at most. The owner compares the texts of a key byte by byte, numbers
   the different ones along the key's chain (0, 1, ...) and writes its key range as files.
4. Every document row is looked up by slot, bucket, key and, along the chain, digest; a hot key's rows are
   split by AQE.

Text None counts as empty. Rows with the same doc_id are one document: they share ``kept``. A null
doc_id is never the smallest unless the group has no other. Other columns are ignored, whatever their
names; an empty table gives an empty result; texts of any length are compared whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, new_dir, settle

MAX_DEPTH = 16

#: Parts of the input in which equal texts are added up before they go to their owner.
SALTS = 8


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{SPACE_CLASS}+", " ")


def _key(c, key_bits: int):
    return F.shiftleft(F.xxhash64(c), 64 - key_bits)


def keyed(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """doc_id, key and digest of each row's normalised text."""
    t = docs.select("doc_id", normalised().alias("t"))
    return t.select("doc_id", _key(F.col("t"), key_bits).alias("key"), F.unhex(F.sha2("t", 256)).alias("digest"))


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """slot (first MAX_DEPTH bits) -> depth and bucket. A prefix is split while it is overfull, so a
    slot's depth is one more than its deepest overfull prefix."""
    recs = keys.select("key", "digest").distinct()
    slots = recs.groupBy(_slot().alias("slot")).agg(F.count("*").alias("n"))
    at = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH - 1))).alias("d"))
    at = at.withColumn("prefix", F.expr(f"shiftright(slot, {MAX_DEPTH} - d)"))
    at = at.withColumn("held", F.sum("n").over(Window.partitionBy("d", "prefix")))
    depth = F.coalesce(F.max(F.when(F.col("held") > capacity, F.col("d") + 1)), F.lit(0))
    return (at.groupBy("slot").agg(depth.alias("depth"))
            .withColumn("bucket", F.expr(f"shiftleft(1L, depth) + shiftright(slot, {MAX_DEPTH} - depth)")))


def _slot():
    return F.shiftrightunsigned("key", 64 - MAX_DEPTH)


def through(df: DataFrame, slots: DataFrame) -> DataFrame:
    """Rows with the bucket and depth that the directory has for their key; at most 65,536 rows are broadcast."""
    return df.withColumn("slot", _slot()).join(F.broadcast(slots), "slot").drop("slot")


def owned_records(docs: DataFrame, slots: DataFrame, key_bits: int = 64) -> DataFrame:
    """bucket, depth, key, chain, digest, keep_id, group_size of each different text, made where its bucket lies."""
    rows = docs.select("doc_id", normalised().alias("t"), (F.spark_partition_id() % SALTS).alias("salt"))
    rows = rows.withColumn("key", _key(F.col("t"), key_bits))
    some = rows.groupBy("salt", "key", "t").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    # partitioned by bucket, neither the grouping nor the window moves rows again
    here = through(some.drop("salt"), slots).repartition("bucket")
    texts = here.groupBy("bucket", "depth", "key", "t").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    recs = texts.select("bucket", "depth", "key", F.unhex(F.sha2("t", 256)).alias("digest"), "keep_id", "group_size")
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("keep_id", "digest"))
    return recs.withColumn("chain", chain - 1)


class Index(NamedTuple):
    records: DataFrame
    directory: DataFrame


def build_index(docs: DataFrame, capacity: int = 16_384, key_bits: int = 64, keys: DataFrame | None = None) -> Index:
    """The index, read from its files. ``keys`` are the rows of ``keyed`` if they are at hand."""
    spark = docs.sparkSession
    slots = settle(directory(keyed(docs, key_bits) if keys is None else keys, capacity), "index-directory")
    owned = owned_records(docs, slots, key_bits)
    path = new_dir(spark, "index")
    owned.write.partitionBy("bucket").parquet(path)
    return Index(spark.read.schema(owned.schema).parquet(path), slots)


def lookup(keys: DataFrame, index: Index) -> DataFrame:
    """Each row of keys with the record its text has in the index: slot, bucket, key, place in the chain."""
    found = index.records.select("bucket", "key", "digest", "keep_id", "group_size")
    return through(keys, index.directory).join(found, ["bucket", "key", "digest"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, capacity: int = 16_384, key_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of docs."""
    keys = settle(keyed(docs, key_bits), "index-keys")
    return lookup(keys, build_index(docs, capacity, key_bits, keys))
