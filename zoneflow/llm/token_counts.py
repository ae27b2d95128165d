"""Tokens per document by a map-side two-tier lookup; no pre-token of the corpus is shuffled.

Tier 1 is a broadcast table of frequent pre-tokens and their lengths: at most ``table_size``
entries, from a sample of about ``sample_docs`` documents spread over the whole table by a hash of
text and id. It only saves work; counts do not depend on it. Tier 2 are the workers' caches, which
hold what tier 1 misses and are bounded too. See ``pieces`` for why the counts are the library's.

Text None counts as empty. Rows are independent: repeated rows get the same counts, an empty table
gives an empty result, columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, map_arrow
from .pieces import PLAIN, PRE_TOKEN, worker_encoder


def sample_of(docs: DataFrame, sample_docs: int) -> DataFrame:
    """About ``sample_docs`` documents of all parts of the table: those with the smallest hashes."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    return docs.where(F.xxhash64("doc_id", "text") <= min(2**63 - 1, int(-(2**63) + share * 2**64)))


def frequent_lengths(docs: DataFrame, path: str, sample_docs: int, table_size: int) -> dict[str, int]:
    """pre-token -> tokens, for the most frequent pre-tokens of the sample."""
    def count(batch: pa.RecordBatch):
        found = Counter()
        for text in batch.column(0).to_pylist():
            found.update(PRE_TOKEN.findall(text or ""))
        yield pa.RecordBatch.from_pydict({"t": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    def lengths(batch: pa.RecordBatch):
        known = worker_encoder("count", path, len, sum)
        tokens = batch.column(0).to_pylist()
        # other characters may be classed differently by the library, which then sees whole pieces
        held = [t for t in tokens if PLAIN.fullmatch(t)]
        yield pa.RecordBatch.from_pydict({"t": pa.array(held, pa.string()), "n": pa.array([known.pre_token(t) for t in held], pa.int64())})

    top = (map_arrow(sample_of(docs, sample_docs).select("text"), count, "t string, n long")
           .groupBy("t").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "t").limit(table_size))
    return {r["t"]: r["n"] for r in map_arrow(top.select("t"), lengths, "t string, n long").collect()}


def token_counts(docs: DataFrame, tokenizer: str, max_tokens: int = 1024, sample_docs: int = 4000,
                 table_size: int = 65_536) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs. ``tokenizer``: a byte-level .json file."""
    spark = begin(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    known = spark.sparkContext.broadcast(frequent_lengths(docs, tokenizer, sample_docs, table_size))

    def count(batch: pa.RecordBatch):
        encoder = worker_encoder("count", tokenizer, len, sum, known.value)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        n = [encoder.of(t) for t in texts]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
            "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array([x > max_tokens for x in n], pa.bool_())})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
