"""Training rows for the line classifier: attribute lines and a balanced ``none`` class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.operators import extract, sampling
from zoneflow.plans.rules import RuleSet
from zoneflow.session import checked_broadcast


def none_lines(lines: DataFrame, hits: DataFrame, min_words: int = 5) -> DataFrame:
    """Lines of documents with at least one hit that are no hit themselves and have at least
    ``min_words`` words."""
    docs, spots = hits.select("doc_id").distinct(), hits.select("doc_id", "line_no").distinct()
    return (
        lines.where(tx.word_count("line") >= min_words)
        .join(checked_broadcast(docs), "doc_id", "left_semi")
        .join(checked_broadcast(spots), ["doc_id", "line_no"], "left_anti")
    )


def none_lines_of(docs: DataFrame, rules: RuleSet, min_words: int = 5, text: str = "text") -> DataFrame:
    """The same rows straight from document rows, where nothing has to be joined or shuffled:
    every line is judged inside its document."""
    keep = [c for c in docs.columns if c != text]
    judged = F.transform(
        F.split(tx.plain_spaces(text), "\n"),
        lambda line, i: F.struct(
            (i + 1).alias("line_no"), line.alias("line"), extract.is_hit(line, rules).alias("hit")
        ),
    )
    wanted = F.filter("_judged", lambda x: ~x["hit"] & (tx.word_count(x["line"]) >= min_words))
    # The outer explode keeps Spark from judging the lines again in an inferred filter.
    return (
        docs.select(*keep, judged.alias("_judged"))
        .select(*keep, F.inline_outer(F.when(F.exists("_judged", lambda x: x["hit"]), wanted)))
        .where(F.col("line_no").isNotNull())
        .drop("hit")
    )


def median_class_counts(hits: DataFrame) -> DataFrame:
    """Per city, the median of its class counts. The inner count combines before the
    shuffle; the outer group holds one row per class."""
    return (
        hits.groupBy("city", "attribute").agg(F.count("*").alias("n"))
        .groupBy("city").agg(F.percentile("n", 0.5).alias("median_count"))
    )


def balanced(none: DataFrame, hits: DataFrame, seed: int) -> DataFrame:
    """(city, attribute, context): every hit row, and per city as many ``none`` lines as its
    median class count, or all of them where there are fewer."""
    medians = median_class_counts(hits)
    size = F.least(F.bround("median_count"), F.col("_total"))
    drawn = sampling.take(none, ["city"], size, seed, ["doc_id", "line_no"], medians)
    return hits.select("city", "attribute", "context").unionByName(
        drawn.select("city", F.lit("none").alias("attribute"), F.col("line").alias("context"))
    )


def hold_out(rows: DataFrame, city: str) -> tuple[DataFrame, DataFrame]:
    """Rows of other cities and rows of ``city``; a row without a city is among the others."""
    held = F.col("city").eqNullSafe(city)
    return rows.where(~held), rows.where(held)


def check_split(whole: DataFrame, *parts: DataFrame) -> DataFrame:
    """Row counts of a table and its parts, and whether they agree."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("rows")).withColumn("part", F.lit(name))

    out = counted(whole, "whole")
    for n, part in enumerate(parts):
        out = out.unionByName(counted(part, f"part_{n}"))
    total = F.sum(F.when(F.col("part") == "whole", F.col("rows")).otherwise(-F.col("rows")))
    return out.agg(
        F.max(F.when(F.col("part") == "whole", F.col("rows"))).alias("rows"),
        (total == 0).alias("preserved"),
    )
