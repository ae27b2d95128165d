"""Attribute extraction from line tables, with context windows and zone candidates."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.plans.rules import Rule, RuleSet
from zoneflow.session import checked_broadcast

HIT_COLUMNS = [
    "doc_id", "city", "attribute", "pattern_id", "values", "value_list",
    "context", "section", "line_no", "fraction",
]


def _integers(line: Column | str) -> Column:
    return tx.integers(tx.without_commas(tx.digits_for_words(line)))


def _speaks_of(line: Column, low: Column, rule: Rule) -> Column:
    """Whether the line matches the rule. The pattern is tried only where its letters are all there; ``low`` is the
    line in lower case, or null where other letters fold to ASCII ones."""
    found = line.rlike(tx.line_pattern(rule.pattern))
    letters = tx.required_letters(rule.pattern)
    return found if not letters else reduce(and_, [F.coalesce(low.contains(x), F.lit(True)) for x in letters]) & found


def _per_rule(line: Column, low: Column, rules: RuleSet) -> Column:
    """Array of (attribute, pattern_id, lo, hi) of the rules the line matches."""
    return F.array_compact(F.array(*[
        F.when(
            _speaks_of(line, low, r),
            F.struct(
                F.lit(r.attribute).alias("attribute"),
                F.lit(r.pattern_id).alias("pattern_id"),
                F.lit(r.lo).alias("lo"),
                F.lit(r.hi).alias("hi"),
            ),
        )
        for r in rules.rules
    ]))


def _hits_of(per_rule: Column, ints: Column) -> Column:
    """(attribute, pattern_id, value_list) of the matching rules with a value in range."""
    valued = F.transform(per_rule, lambda r: F.struct(
        r["attribute"].alias("attribute"), r["pattern_id"].alias("pattern_id"),
        tx.between_open(ints, r["lo"], r["hi"]).alias("value_list")))
    return F.filter(valued, lambda h: F.size(h["value_list"]) > 0)


def _hit_columns(extra: list[str]) -> list[Column | str]:
    return [
        "doc_id", "city", "attribute", "pattern_id",
        tx.float_list_text("value_list").alias("values"),
        "value_list",
        F.col("line").alias("context"),
        "section", "line_no",
        ((F.col("line_no") - 1) / F.col("n_lines") * 100).alias("fraction"),
        *extra,
    ]


def attributes(lines: DataFrame, rules: RuleSet) -> DataFrame:
    """Hits: one row per line and matching pattern with at least one value in range.

    Narrow work only, so documents of any size split freely over tasks. ``fraction`` is how
    far into the document the line lies, in percent. Each pattern is tried once a line, and integers
    are read from matching lines only.
    """
    line, columns = F.col("line"), lines.columns
    # One step per projection, and an outer explode, keep Spark from judging lines again in a filter.
    return (
        lines.select("*", tx.plain_lower(line).alias("_low"))
        .select(*columns, _per_rule(line, F.col("_low"), rules).alias("_rules"))
        .select("*", F.when((F.size("_rules") > 0) & tx.has_number(line), _integers(line)).alias("_ints"))
        .select(*columns, F.when(F.size("_ints") > 0, _hits_of(F.col("_rules"), F.col("_ints"))).alias("_hits"))
        .select(*columns, F.inline_outer("_hits"))
        .where(F.col("attribute").isNotNull())
        .select(*_hit_columns([]))
    )


def document_hits(docs: DataFrame, rules: RuleSet, pattern: str = tx.ZONE_CODE, window: int = 20,
                  text: str = "text") -> DataFrame:
    """Hits with zone candidates straight from document rows: one scan, no shuffle.

    Lines are judged inside their document, and each candidate line takes the codes of its
    own slice of lines, so a document's cost grows with its length only. Where hits or lines
    are already stored, ``attributes`` and ``zone_candidates`` do the same from tables.
    """
    keep = [c for c in docs.columns if c != text]
    # The outer explode and the test after it keep Spark from judging lines again in a
    # pushed-down filter.
    lowered = F.transform("_lines", lambda line: F.struct(line.alias("line"), tx.plain_lower(line).alias("low")))
    judged = F.transform(lowered, lambda x, i: F.struct(
        (i + 1).alias("line_no"), x["line"].alias("line"), _per_rule(x["line"], x["low"], rules).alias("rules")))
    matching = F.transform(F.filter(judged, lambda s: (F.size(s["rules"]) > 0) & tx.has_number(s["line"])), lambda s: F.struct(
        s["line_no"].alias("line_no"), s["line"].alias("line"), s["rules"].alias("rules"), _integers(s["line"]).alias("ints")))
    hits = F.transform(F.filter(matching, lambda s: F.size(s["ints"]) > 0), lambda s: F.struct(
        s["line_no"].alias("line_no"), s["line"].alias("line"), _hits_of(s["rules"], s["ints"]).alias("hits")))
    spots = F.filter(hits, lambda s: F.size(s["hits"]) > 0)
    line_codes = F.transform("_lines", lambda line: F.when(
        line.rlike(tx.line_pattern(pattern)), tx.codes(line, pattern)))

    def near(spot: Column) -> Column:
        first = F.greatest(spot["line_no"] - (window - 1), F.lit(1))
        around = F.slice("_codes", first, spot["line_no"] + window - first)
        return F.array_sort(F.array_distinct(F.flatten(F.array_compact(around))))

    candidates = (
        docs.where(F.col(text).isNotNull())
        .select(*keep, F.split(tx.plain_spaces(text), "\n").alias("_lines"))
        .select(*keep, "_lines", spots.alias("_spots"))
        .select(*keep, F.size("_lines").alias("n_lines"), "_spots",
                F.when(F.size("_spots") > 0, line_codes).alias("_codes"))
        .select(*keep, "n_lines", F.inline_outer(F.transform("_spots", lambda s: F.struct(
            s["line_no"].alias("line_no"), s["line"].alias("line"), s["hits"].alias("_hits"), near(s).alias("zone_list")))))
        .where(F.col("line_no").isNotNull())
        .withColumn("zone_list", F.when(F.size("zone_list") > 0, F.col("zone_list")))
        .select(*keep, "n_lines", "line_no", "line", "zone_list", F.inline("_hits"))
    )
    return candidates.select(*_hit_columns(["zone_list"])).withColumn(
        "zone_candidates", F.array_join("zone_list", ", "))


def locate(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Stored hits (city, section, line_no, ...) with the ``doc_id`` of their document.

    ``docs`` has doc_id, city and section, one document per pair once the latest version is
    chosen; where two still share it, the hit gets a row for each. Hits without a document keep
    a null ``doc_id``. Only ids travel to the hits, no text.
    """
    return hits.drop("doc_id").join(docs.select("doc_id", "city", "section"), ["city", "section"], "left")


def is_hit(line: Column, rules: RuleSet) -> Column:
    """Whether a line would give a hit, as an expression for use inside a document row."""
    ints = _integers(line)

    def in_range(r: Rule) -> Column:
        return F.exists(ints, lambda v: (v > r.lo) & (v < r.hi))

    found = [line.rlike(tx.line_pattern(r.pattern)) & in_range(r) for r in rules.rules]
    return tx.has_number(line) & reduce(or_, found)


def _block(line_no: str, window: int):
    return F.floor(F.col(line_no) / window)


def zone_candidates(
    lines: DataFrame, hits: DataFrame, pattern: str = tx.ZONE_CODE, window: int = 20
) -> DataFrame:
    """Hits with the codes found less than ``window`` lines away.

    Only lines holding a code take part. They are gathered by (document, block of
    ``window`` lines) and offered to the neighbouring blocks, so a group never holds more
    than three blocks however long the document, and hits keep one row each.
    """
    coded = (
        lines.where(F.col("line").rlike(tx.line_pattern(pattern)))
        .select("doc_id", "line_no", F.array_distinct(tx.codes("line", pattern)).alias("codes"))
        .select(
            "doc_id",
            F.explode(F.sequence(_block("line_no", window) - 1, _block("line_no", window) + 1)).alias("block"),
            F.struct("line_no", "codes").alias("coded"),
        )
        .groupBy("doc_id", "block").agg(F.collect_list("coded").alias("near"))
    )
    close = F.filter("near", lambda x: F.abs(x["line_no"] - F.col("line_no")) < window)
    found = F.array_sort(F.array_distinct(F.flatten(F.transform(close, lambda x: x["codes"]))))
    return (
        hits.withColumn("block", _block("line_no", window))
        .join(coded, ["doc_id", "block"], "left")
        .withColumn("zone_list", F.when(F.size(found) > 0, found))
        .withColumn("zone_candidates", F.array_join("zone_list", ", "))
        .drop("block", "near")
    )


def context(lines: DataFrame, hits: DataFrame, window: int = 20) -> DataFrame:
    """Lines less than ``window`` away from each hit line: doc_id, hit_line, line_no, line,
    is_hit. An equi-join on (document, block) with a residual distance test; the text stays
    in place while the hit positions measure small."""
    spots = (
        hits.select("doc_id", F.col("line_no").alias("hit_line")).distinct()
        .select(
            "doc_id", "hit_line",
            F.explode(F.sequence(_block("hit_line", window) - 1, _block("hit_line", window) + 1)).alias("block"),
        )
    )
    return (
        lines.select("doc_id", _block("line_no", window).alias("block"), "line_no", "line")
        .join(checked_broadcast(spots), ["doc_id", "block"])
        .where(F.abs(F.col("line_no") - F.col("hit_line")) < window)
        .select(
            "doc_id", "hit_line", "line_no", "line",
            (F.col("line_no") == F.col("hit_line")).alias("is_hit"),
        )
    )


def districts(lines: DataFrame, pattern: str = tx.DISTRICT_CODE) -> tuple[DataFrame, DataFrame]:
    """Distinct district codes per city, and the lines they were found in."""
    found = lines.where(F.col("line").rlike(tx.line_pattern(pattern)))
    tokens = found.select("city", F.explode(tx.codes("line", pattern)).alias("district")).distinct()
    return tokens, found


def coverage(hits: DataFrame, cities: DataFrame) -> DataFrame:
    """Per attribute: cities with a hit, all cities, and the percentage."""
    total = cities.agg(F.count_distinct("city")).scalar()
    return (
        hits.groupBy("attribute").agg(F.count_distinct("city").alias("found_cities"))
        .withColumn("all_cities", total)
        .withColumn("pct_found", F.col("found_cities") / F.col("all_cities") * 100)
    )


def find_information(hits: DataFrame, city: str, attribute: str) -> DataFrame:
    return hits.where((F.col("city") == city) & (F.col("attribute") == attribute))


def with_zones_only(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("zone_candidates").isNotNull())


def split_by_zone(hits: DataFrame, zones: list[str]) -> DataFrame:
    """One row per (hit, known zone named in its line); ``no_zone`` where none is."""
    named = F.filter(
        F.array(*[F.lit(z) for z in sorted(set(zones))]), lambda z: F.contains(F.col("context"), z)
    )
    zone = F.when(F.size(named) > 0, named).otherwise(F.array(F.lit("no_zone")))
    return hits.select("*", F.explode(zone).alias("zone"))


def apply_values(table: DataFrame, zoned_hits: DataFrame, attributes: list[str],
                 zone: str = "zn_code") -> tuple[DataFrame, DataFrame]:
    """Write the smallest value of the first hit per (zone, attribute) into the code table.

    Returns the table (unknown zones add rows, missing attribute columns start out null) and
    the applied updates.
    """
    for a in attributes:
        if a not in table.columns:
            table = table.withColumn(a, F.lit(None).cast("double"))
    updates = (
        zoned_hits.where(F.col("zone") != "no_zone")
        .groupBy("zone", "attribute")
        .agg(F.min_by(F.col("value_list")[0], F.struct("doc_id", "line_no", "pattern_id")).alias("value"))
    )
    wide = updates.groupBy(F.col("zone").alias(zone)).pivot("attribute", attributes).agg(F.first("value"))
    wide = wide.select(zone, *[F.col(a).alias(f"_{a}") for a in attributes])
    joined = table.join(wide, zone, "full_outer")
    return (
        joined.select(*[
            F.coalesce(f"_{c}", c).alias(c) if c in attributes else F.col(c) for c in table.columns
        ]),
        updates,
    )
