"""Lines that many documents share are dropped everywhere; DataFrame functions only.

1. Lines are exploded, normalised and hashed (128 bits). A document's distinct hashes are taken
   inside its row, so counting documents per hash is one aggregation that combines before its
   shuffle, however common a line is. Ids that several rows share are found first, by id alone; the
   hashes of such rows are made distinct per id, so that these rows count as one document.
2. The hashes over the threshold are written once. If they count at most ``BROADCAST_ROWS`` the
   lines are matched by broadcast, otherwise by a shuffled join; the rows are the same.
3. Only the positions of dropped lines are gathered per document and joined to the texts, which
   are put together again from the positions that stay.

Text None counts as one empty line. Empty keys are never dropped. Rows of one id are one document for
the count and keep their own rows in the result; each row without an id is a document. Texts of any
length are split in place. An empty table gives an empty result. Columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, SPACE_CHARS, lower_ascii, settle


def _lines():
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _hash(line):
    """128-bit hash of the key; null where the key is empty."""
    key = lower_ascii(F.btrim(line, F.lit(SPACE_CHARS)))
    return F.when(F.length(key) >= 1, F.md5(key))


def frequent_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    own = F.explode(F.array_compact(F.array_distinct(F.transform(_lines(), _hash)))).alias("h")
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    shared = settle(ids, "shared-ids")
    if shared.isEmpty():
        hashes = docs.select(own)
    else:
        once = docs.join(shared, "doc_id", "left_anti").select(own)
        hashes = once.unionByName(docs.join(shared, "doc_id", "left_semi").select("doc_id", own).distinct().select("h"))
    return (hashes.groupBy(F.unhex("h").alias("h"))
            .agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs))


def line_dedup(docs: DataFrame, min_docs: int = 10, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text (what stays), n_lines, n_dropped for each row of docs."""
    docs = docs.select("doc_id", "text")
    hot = settle(frequent_lines(docs, min_docs).select("h"), "frequent-lines")
    hot = F.broadcast(hot) if hot.count() <= broadcast_rows else hot
    tag = F.xxhash64("text").alias("tag")
    drops = (docs.select("doc_id", tag, F.posexplode(F.transform(_lines(), _hash)).alias("pos", "h"))
             .where("h is not null").withColumn("h", F.unhex("h")).join(hot, "h", "left_semi")
             .groupBy("doc_id", "tag").agg(F.collect_set("pos").alias("gone")).alias("d"))
    rows = docs.withColumn("tag", F.xxhash64("text")).alias("t").join(
        drops, F.col("t.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("t.tag") == F.col("d.tag")), "left")
    # inline() hands the lines on as a column: inside the lambda the text is not split again
    rows = rows.select("t.doc_id", F.coalesce("gone", F.expr("array()").cast("array<int>")).alias("gone"),
                       F.inline(F.array(F.struct(_lines().alias("lines")))))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return rows.select("doc_id", F.array_join(F.transform(stay, lambda p: F.col("lines")[p]), "\n").alias("text"),
                       F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"))
