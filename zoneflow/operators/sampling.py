"""Exact-size seeded sampling, splitting and resampling per class.

A row's place is the md5 of ``seed|key``, so results do not depend on partitioning and any
engine can reproduce them. ``key`` must identify rows: where a repeated key lies across a cut, so
that the sample could not have its exact size, the job fails. Rows with a null class are a class
of their own. No class is ever gathered: places are counted in buckets of the hash, and only the
one bucket a cut falls into is ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.session import checked_broadcast

HEX_DIGITS = 4  # 65,536 hash buckets per class


def place(seed: int, key: list[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def _bucket() -> Column:
    return F.conv(F.substring("_place", 1, HEX_DIGITS), 16, 10).cast("int")


def _placed(df: DataFrame, group: list[str], seed: int, key: list[str]) -> DataFrame:
    return df.select("*", place(seed, key).alias("_place"), _class(group)).withColumn("_bucket", _bucket())


def _class(group: list[str]) -> Column:
    """The group columns as one text, which unlike them joins where some are null."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in group]
    return F.concat_ws("\x1f", *parts).alias("_class")


def _bucket_counts(placed: DataFrame, group: list[str]) -> DataFrame:
    """Rows per (class, bucket), rows in lower buckets (``_below``) and in the class."""
    upto = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.groupBy("_class", *group, "_bucket").agg(F.count("*").alias("_cnt"))
        .withColumn("_below", F.sum("_cnt").over(upto) - F.col("_cnt"))
        .withColumn("_total", F.sum("_cnt").over(Window.partitionBy("_class")))
    )


def flag_sample(
    df: DataFrame,
    group: list[str],
    size: Column,
    seed: int,
    key: list[str],
    sizes: DataFrame | None = None,
    flag: str = "in_sample",
    within: Column | None = None,
) -> DataFrame:
    """Mark exactly ``size`` rows of each class, of those for which ``within`` holds (default: all);
    the others stay unmarked.

    ``size`` is computed per class from ``_total`` (rows in the class) and any columns of
    ``sizes``, a per-class table joined on ``group``; classes missing there get none. The
    input is scanned to count buckets, to find each class's cut and to set the flag; it is
    never shuffled.
    """
    keys = ["_class"]
    placed = _placed(df, group, seed, key)
    inside = placed if within is None else placed.where(within)
    counts = _bucket_counts(inside, group)
    if sizes is not None:
        counts = counts.join(sizes, group)
    cuts = (
        counts.withColumn("_size", size.cast("bigint"))
        .where(
            ((F.col("_below") < F.col("_size")) & (F.col("_size") <= F.col("_below") + F.col("_cnt")))
            | ((F.col("_below") == 0) & (F.col("_size") >= F.col("_total")))
        )
        .select(
            *keys,
            F.when(F.col("_size") < F.col("_total"), F.col("_bucket")).alias("_bucket"),
            (F.col("_size") - F.col("_below")).alias("_rank"),
        )
        .groupBy(*keys).agg(F.max("_bucket").alias("_bucket"), F.max("_rank").alias("_rank"),
                            F.max(F.col("_bucket").isNull()).alias("_whole"))
    )
    cuts = checked_broadcast(cuts)
    in_bucket = Window.partitionBy(*keys).orderBy("_place")
    repeated = F.raise_error(F.lit("a repeated key lies across the cut of a sample")).cast("string")
    edge = (
        inside.select(*keys, "_bucket", "_place").join(cuts, [*keys, "_bucket"])
        .where(~F.col("_whole"))
        .withColumn("_rn", F.row_number().over(in_bucket))
        .withColumn("_next", F.lead("_place").over(in_bucket))
        .where(F.col("_rn") == F.col("_rank"))
        .select(*keys, F.when(F.col("_next") == F.col("_place"), repeated).otherwise(F.col("_place")).alias("_last"))
    )
    # "g" sorts after every hex digest: the whole class is in.
    whole = cuts.where("_whole").select(*keys, F.lit("g").alias("_last"))
    last = checked_broadcast(edge.unionByName(whole))
    marked = F.col("_place") <= F.col("_last")
    out = placed.join(last, keys, "left").withColumn(
        flag, F.coalesce(marked if within is None else marked & within, F.lit(False))
    )
    return out.select(*df.columns, flag)


def take(df: DataFrame, group: list[str], size: Column, seed: int, key: list[str],
         sizes: DataFrame | None = None) -> DataFrame:
    return flag_sample(df, group, size, seed, key, sizes, "_in").where("_in").drop("_in")


def sample_n(df: DataFrame, n: int, seed: int, key: list[str]) -> DataFrame:
    return take(df, [], F.lit(n), seed, key)


def split(df: DataFrame, group: list[str], share: float, seed: int, key: list[str],
          flag: str = "in_train") -> DataFrame:
    """Per-class split: ``round(share * n)`` rows of each class, half to even, are flagged."""
    return flag_sample(df, group, F.bround(F.col("_total") * share), seed, key, flag=flag)


def three_way(df: DataFrame, group: list[str], seed: int, key: list[str],
              test_share: float = 0.25) -> DataFrame:
    """train/valid/test column ``part``: a test share is split off twice. One scan reads the result;
    each of the two cuts is found by two more."""
    rest = split(df, group, 1 - test_share, seed, key, "_rest")
    size = F.bround(F.col("_total") * (1 - test_share))
    again = flag_sample(rest, group, size, seed + 1, key, flag="_train", within=F.col("_rest"))
    part = F.when(~F.col("_rest"), "test").when(F.col("_train"), "train").otherwise("valid")
    return again.select(*df.columns, part.alias("part"))


def ranked(df: DataFrame, group: list[str], seed: int, key: list[str]) -> DataFrame:
    """Column ``rank``: the row's place in its class, from 0. Ranks add up bucket offsets, so no
    class is ordered in one task."""
    placed = _placed(df, group, seed, key)
    counts = _bucket_counts(placed, group).select("_class", "_bucket", "_below")
    in_bucket = Window.partitionBy("_class", "_bucket").orderBy("_place")
    return (placed.withColumn("_rn", F.row_number().over(in_bucket)).join(counts, ["_class", "_bucket"])
            .select(*df.columns, (F.col("_below") + F.col("_rn") - 1).alias("rank")))


def draw(df: DataFrame, group: list[str], size: Column, seed: int, key: list[str],
         sizes: DataFrame | None = None) -> DataFrame:
    """Exactly ``size`` rows per class with replacement, numbered by ``draw_no`` from 0.

    Draw j of a class takes the row whose rank by hash equals md5(seed|draw|class|j) modulo
    the class size. Ranks come from bucket offsets; row i issues draws i, i+n, i+2n, ..., so
    both steps spread over all tasks and the final join is on a unique (class, rank).
    """
    keys = ["_class"]
    placed = _placed(df, group, seed, key)
    counts = _bucket_counts(placed, group)
    if sizes is not None:
        counts = counts.join(sizes, group)
    counts = counts.withColumn("_size", size.cast("bigint"))
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_place")
    ranked = (
        placed.withColumn("_rn", F.row_number().over(in_bucket))
        .join(counts.drop(*group), [*keys, "_bucket"])
        .withColumn("_rank", F.col("_below") + F.col("_rn") - 1)
    )
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("draw"),
                               *[F.col(k).cast("string") for k in group], F.col("draw_no").cast("string")))
    draws = (
        ranked.where(F.col("_rank") < F.col("_size"))
        .select(*keys, *group, "_total", F.explode(F.sequence("_rank", F.col("_size") - 1, "_total")).alias("draw_no"))
        .select(
            *keys, "draw_no",
            (F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % F.col("_total")).alias("_rank"),
        )
    )
    return (
        ranked.select(*df.columns, *keys, "_rank")
        .join(draws, [*keys, "_rank"]).select(*df.columns, "draw_no")
    )


def _per_class(name: str, values: dict, default: Column) -> Column:
    return reduce(lambda acc, kv: acc.when(F.col(name) == kv[0], F.lit(kv[1])), values.items(), F.when(F.lit(False), F.lit(None))).otherwise(default)


def upsample(df: DataFrame, label: str, factors: dict[str, int], seed: int, key: list[str]) -> DataFrame:
    """Replace each listed class by ``factor * n`` draws from it; other classes stay.
    Untouched rows have a null ``draw_no``."""
    listed = F.coalesce(F.col(label).isin(list(factors)), F.lit(False))
    drawn = draw(df.where(listed), [label], F.col("_total") * _per_class(label, factors, F.lit(1)), seed, key)
    return df.where(~listed).withColumn("draw_no", F.lit(None).cast("bigint")).unionByName(drawn)


def resample(df: DataFrame, label: str, targets: DataFrame, seed: int, key: list[str]) -> DataFrame:
    """Bring each class to its ``target`` count (table of ``label``, ``target``).

    Smaller classes keep every row and gain draws with replacement; larger ones are sampled
    down. A class without a target stays as it is.
    """
    cap = F.least("_total", "target")
    more = F.greatest(F.col("target") - F.col("_total"), F.lit(0))
    targets = checked_broadcast(targets.select(label, "target"))
    unlisted = df.join(targets, label, "left_anti")
    listed = df.join(targets, label, "left_semi")
    none = F.lit(None).cast("bigint")
    kept = take(listed, [label], cap, seed, key, targets).withColumn("draw_no", none)
    extra = draw(listed, [label], more, seed, key, targets)
    return kept.unionByName(extra).unionByName(unlisted.select(*df.columns, none.alias("draw_no")))
