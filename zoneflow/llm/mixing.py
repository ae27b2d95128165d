"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Targets. A source's weight gives its share of ``share`` times all tokens. No source is taken more
than ``passes`` times; what exceeds that is shared again among the others by weight.

Schedule. The golden-ratio points frac((i + 1) / phi) are mapped through the cumulative targets: point
i gives slot i to the source whose interval it falls in, so every stretch of the mix is close to
the targets. Slots are ranked within their source from counts per stretch of slots and their
prefix sums; slot r of a source takes its block r, starting over after the last.

Blocks. A source's documents are shuffled by a hash of their id and text and laid end to end; token
positions come from sums per bucket of the hash and their prefix sums, so a source that holds a
third of all rows is dealt over many tasks. The stream is cut into blocks of ``block`` tokens; a
document lies in each block it overlaps. Joining slots and blocks gives the tokens taken, and how often
a document is begun: in how many slots, over all passes, its first token lies.

The schedule is as long as the targets need and a source stops at its target, so what is taken
falls short of it by less than one token. Blocks shrink for small inputs to a thousandth of the
smallest target, 16 tokens at least; their number does not grow with the table then.

Text None has size 0, as has an empty one; such documents and sources take nothing. The null source
is a source of its own, last in order. Rows with equal id and text are laid one after the other.
Sources are taken to be few (their sums are collected): up to about 100,000.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import in_order, settle

PHI = (math.sqrt(5) - 1) / 2
STRETCH = 4096


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (runs without ASCII white space), and the place in the shuffled source."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.cast("long").alias("size"),
                       F.xxhash64("doc_id", "text").alias("place"))


def targets(held: Sequence[tuple[str | None, int]], weights: Sequence[float], share: float, passes: int) -> list[float]:
    """The target of each (source, size), in their order; weights repeat along it."""
    weight = [weights[i % len(weights)] for i in range(len(held))]
    out, rest, open_ = [0.0] * len(held), share * sum(n for _, n in held), set(range(len(held)))
    while open_:
        total = sum(weight[i] for i in open_)
        full = {i for i in open_ if rest * weight[i] / total >= passes * held[i][1]}
        if not full:
            for i in open_:
                out[i] = rest * weight[i] / total
            break
        for i in sorted(full):
            out[i] = float(passes * held[i][1])
        rest -= sum(out[i] for i in sorted(full))
        open_ -= full
    return out


def by_source(rows: DataFrame) -> list[tuple[str | None, int]]:
    """(source, tokens) by code point, null last."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("n")).collect()
    return sorted(((r["source"], r["n"]) for r in sums), key=lambda x: (x[0] is None, x[0] or ""))


def streamed(rows: DataFrame, buckets: int) -> DataFrame:
    """rows with ``start``: the tokens of their source before them in the shuffled order."""
    rows = rows.withColumn("bucket", F.expr(f"shiftrightunsigned(place, 33) * {buckets} div 2147483648"))
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source_no", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(bases, ["source_no", "bucket"]).withColumn("start", F.col("base") + F.col("inside"))
            .drop("bucket", "base", "inside"))


def schedule(spark, wanted: Sequence[float], block: int) -> DataFrame:
    """slot, source_no, rank (of the slot in its source) of as many slots as fill all targets."""
    blocks = [math.ceil(w / block) for w in wanted]  # whole ones: the smallest source has a slot too
    need = sum(blocks)
    if not need:
        return spark.range(0).select(F.col("id").alias("slot"), F.lit(0).alias("source_no"), F.col("id").alias("rank"))
    edges = [at / need for at in accumulate(blocks)]
    # the slots of a source of share p stay within a few of n * p; so many more leave none short
    n = need + math.ceil(4 * need / min(b for b in blocks if b))
    point = (F.col("slot") + 1) * F.lit(PHI)
    source = F.size(F.filter(F.lit(edges), lambda e: e <= F.col("u")))
    slots = (spark.range(n).withColumnRenamed("id", "slot").withColumn("u", point - F.floor(point))
             .select("slot", source.cast("int").alias("source_no"), F.expr(f"slot div {STRETCH}").alias("stretch")))
    sums = slots.groupBy("source_no", "stretch").count()
    before = Window.partitionBy("source_no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source_no", "stretch", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "stretch").orderBy("slot")
    return (slots.withColumn("inside", F.row_number().over(inside) - 1).join(bases, ["source_no", "stretch"])
            .select("slot", "source_no", (F.col("base") + F.col("inside")).alias("rank")))


def block_size(wanted: Sequence[float], block: int) -> int:
    least = min((w for w in wanted if w > 0), default=0)
    return max(1, min(block, max(16, int(least / 1000))))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, passes: int = 2,
        block: int = 4096, bucket_rows: int = 50_000) -> DataFrame:
    """doc_id, source, size, source_size, target, start, taken, begun, place for each row of docs."""
    spark = docs.sparkSession
    rows = settle(sizes(docs), "sizes")
    held = by_source(rows)
    wanted = targets(held, weights, share, passes)
    block = block_size(wanted, block)
    known = spark.createDataFrame(
        [(i, s, n, t) for i, ((s, n), t) in enumerate(zip(held, wanted, strict=True))],
        "source_no int, name string, source_size long, target double")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    placed = settle(streamed(rows, max(1, math.ceil(rows.count() / bucket_rows))), "placed")

    # slot r covers tokens [r * block, (r + 1) * block) of its source laid out again and again, up to the target
    limit = F.least(F.floor("target").cast("long"), passes * F.col("source_size"))
    slots = (schedule(spark, wanted, block).join(known.select("source_no", "source_size", limit.alias("limit")), "source_no")
             .withColumn("from", F.col("rank") * block).where("from < limit")
             .withColumn("to", F.least(F.col("from") + block, "limit")))
    # in passes over the source; a slot across the end of one belongs to two
    slots = (slots.withColumn("pass", F.explode(F.expr("sequence(from div source_size, (to - 1) div source_size)")))
             .select("source_no", F.greatest(F.col("from") - F.col("pass") * F.col("source_size"), F.lit(0)).alias("from"),
                     F.least(F.col("to") - F.col("pass") * F.col("source_size"), "source_size").alias("to")))
    # cut at block borders, so that slots and documents meet on equal block numbers
    pieces = (slots.withColumn("block", F.explode(F.expr(f"sequence(from div {block}, (to - 1) div {block})")))
              .select("source_no", "block", F.greatest("from", F.col("block") * block).alias("from"),
                      F.least("to", (F.col("block") + 1) * block).alias("to")))
    parts = (placed.where("size > 0").select("doc_id", "place", "source_no", "start", "size", F.explode(
        F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block")))
    begins = (F.col("from") <= F.col("start")) & (F.col("start") < F.col("to"))
    overlap = F.least("to", F.col("start") + F.col("size")) - F.greatest("from", F.col("start"))
    taken = (parts.join(pieces, ["source_no", "block"]).where(overlap > 0)
             .groupBy("source_no", "start").agg(F.sum(overlap).alias("taken"), F.sum(begins.cast("int")).alias("begun")))
    # documents of size 0 share their start with the next one
    out = placed.withColumn("at", F.when(F.col("size") > 0, F.col("start"))).join(
        taken.withColumnRenamed("start", "at"), ["source_no", "at"], "left")
    return out.select("doc_id", "source", "size", "source_size", "target", "start",
                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("taken", "begun")], "place")


def copies(docs: DataFrame, **params) -> DataFrame:
    """The rows of docs, each as often as the schedule begins it; equal rows are told apart by number."""
    times = (mix(docs, **params).groupBy(F.struct("doc_id", "source", "place").alias("key"))
             .agg(F.sort_array(F.collect_list("begun"), False).alias("times")).where("times[0] > 0"))
    row_key = F.struct("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("doc_id", "text").alias("place"))
    rows = docs.select(row_key.alias("key"), F.struct(*docs.columns).alias("row"))
    # nulls within equal structs are equal; merged at every size, so that disk use grows in proportion
    rows = rows.join(times.hint("merge"), "key").withColumn("number", F.row_number().over(Window.partitionBy("key").orderBy(in_order(docs, "row"))))
    rows = rows.withColumn("n", F.get("times", F.col("number") - 1)).where("n > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")
