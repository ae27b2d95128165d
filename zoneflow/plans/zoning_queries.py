"""Registered queries of the real zoning rules over ordinance-like documents.

A supplier's line items, in order, become the lines of one document: areas and heights from
quantities and prices, with thousands separators, number words, brackets, non-breaking spaces, zone and
district codes and blank lines. The SQL side builds the same lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.operators import extract
from zoneflow.plans.queries import HIT_SELECT, LINES_SQL, dealt, hits_sql, zone_sql
from zoneflow.plans.registry import register, table
from zoneflow.plans.rules import ZONING
from zoneflow.sources import corpus

HEIGHTS = ["twenty-five", "thirty", "forty five", "ninety", "six"]
#: {q} quantity, {b} a price in thousands notation, {w} a number word, {m} 0 to 8, {c} a capital letter, {n} line number.
LINE_KINDS = [
    ["The minimum lot area shall be ", "{b}", " square feet (", "{q}", ") per unit"],
    ["Maximum building height is ", "{w}", " feet or ", "{q}", " feet in R", "{m}", " zone"],
    ["floor area ratio of 2.5 or ", "{m}", " max"],
    ["no more than ", "{q}", " dwelling units per acre"],
    ["allowed are ", "{m}", " units per each lot (", "{n}", ")"],
    ["RM", "{m}", "-", "{n}", "A and ", "{c}", "-", "{m}", " districts"],
    ["height of structures:\u00a0", "{q}", "\u00a0feet"],
    [""],
    ["General purpose and intent of this chapter for all cities"],
    ["gross lot area (", "{b}", ") in ", "{c}", "-", "{m}", "B"],
    ["The  lots on two acres or ", "{w}", " acres\tof land"],
]
SPARK_PARTS = {
    "{q}": "CAST(CAST(l_quantity AS BIGINT) AS STRING)", "{b}": "format_number(CAST(l_extendedprice AS BIGINT), 0)",
    "{w}": "element_at(array(" + ", ".join(f"'{w}'" for w in HEIGHTS) + "), CAST(l_orderkey % 5 + 1 AS INT))",
    "{m}": "CAST(l_partkey % 9 AS STRING)", "{c}": "substring('ABCR', CAST(l_partkey % 4 + 1 AS INT), 1)",
    "{n}": "CAST(l_linenumber AS STRING)",
}
SQL_PARTS = {
    "{q}": "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)", "{b}": "format('{:,}', CAST(trunc(l_extendedprice) AS BIGINT))",
    "{w}": "[" + ", ".join(f"'{w}'" for w in HEIGHTS) + "][CAST(l_orderkey % 5 + 1 AS INT)]",
    "{m}": "CAST(l_partkey % 9 AS VARCHAR)", "{c}": "substr('ABCR', CAST(l_partkey % 4 + 1 AS INT), 1)",
    "{n}": "CAST(l_linenumber AS VARCHAR)",
}


def _line(parts: dict[str, str]) -> str:
    def text(kind: list[str]) -> str:
        return " || ".join(parts.get(p) or f"'{p}'" for p in kind)

    kind = f"(l_partkey + l_orderkey) % {len(LINE_KINDS)}"
    return f"CASE {kind} " + " ".join(f"WHEN {i} THEN {text(k)}" for i, k in enumerate(LINE_KINDS)) + " END"


def ordinances(spark, sf_dir) -> DataFrame:
    """doc_id, city, section, text: one document per supplier."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.struct("l_orderkey", "l_linenumber", F.expr(_line(SPARK_PARTS)).alias("line")).alias("at"))
    texts = items.groupBy(F.col("l_suppkey").alias("doc_id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("at")), lambda x: x["line"]), "\n").alias("text"))
    return texts.select("doc_id", F.concat(F.lit("city "), F.col("doc_id") % 13).alias("city"),
                        F.concat(F.lit("chapter "), F.col("doc_id")).alias("section"), "text")


ORDINANCE_SQL = f"""raw AS (SELECT l_suppkey, l_orderkey, l_linenumber, {_line(SQL_PARTS)} AS line FROM lineitem),
numbered AS (SELECT l_suppkey AS doc_id, 'city ' || l_suppkey % 13 AS city, 'chapter ' || l_suppkey AS section, replace(line, chr(160), ' ') AS line,
  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, line) AS INTEGER) AS line_no,
  count(*) OVER (PARTITION BY l_suppkey) AS n_lines FROM raw),
lines AS (SELECT * FROM numbered)"""


def over_ordinances(sql: str) -> str:
    return sql.replace(LINES_SQL, ORDINANCE_SQL)


def ordinance_lines(spark, sf_dir) -> DataFrame:
    return corpus.lines(dealt(ordinances(spark, sf_dir)))


@register("ordinance_lines", f"WITH {ORDINANCE_SQL} SELECT doc_id, line_no, line, n_lines FROM lines")
def spaced_lines(spark, sf_dir):
    """Lines with their non-breaking spaces made plain."""
    return ordinance_lines(spark, sf_dir).select("doc_id", "line_no", "line", F.col("n_lines").cast("long").alias("n_lines"))


@register("attribute_hits_zoning", over_ordinances(f"WITH {hits_sql(ZONING)} {HIT_SELECT}"))
def attribute_hits_zoning(spark, sf_dir):
    return extract.attributes(ordinance_lines(spark, sf_dir), ZONING).drop("value_list")


@register("zone_candidates_zoning", over_ordinances(zone_sql(ZONING, tx.ZONE_CODE)))
def zone_candidates_zoning(spark, sf_dir):
    lines = ordinance_lines(spark, sf_dir)
    found = extract.zone_candidates(lines, extract.attributes(lines, ZONING))
    return found.select("doc_id", "attribute", "pattern_id", "line_no", "zone_candidates")


@register("document_hits_zoning", over_ordinances(zone_sql(ZONING, tx.ZONE_CODE)))
def document_hits_zoning(spark, sf_dir):
    found = extract.document_hits(dealt(ordinances(spark, sf_dir)), ZONING)
    return found.select("doc_id", "attribute", "pattern_id", "line_no", "zone_candidates")


@register("district_tokens_zoning", f"WITH {ORDINANCE_SQL} SELECT DISTINCT city, unnest(regexp_extract_all(line, '{tx.DISTRICT_CODE}')) AS district FROM lines")
def district_tokens_zoning(spark, sf_dir):
    return extract.districts(ordinance_lines(spark, sf_dir))[0]


@register("district_contexts_zoning", f"WITH {ORDINANCE_SQL} SELECT doc_id, line_no, line FROM lines WHERE regexp_matches(line, '{tx.DISTRICT_CODE}')")
def district_contexts_zoning(spark, sf_dir):
    return extract.districts(ordinance_lines(spark, sf_dir))[1].select("doc_id", "line_no", "line")


@register("stored_hits_located", over_ordinances(f"""WITH {hits_sql(ZONING)}
SELECT CASE WHEN doc_id % 10 <> 0 THEN doc_id END AS doc_id, city, section, line_no, attribute, pattern_id FROM hits"""))
def stored_hits_located(spark, sf_dir):
    """Hits stored by city and section, with the documents they lie in; some documents are gone."""
    docs = ordinances(spark, sf_dir)
    hits = extract.attributes(corpus.lines(docs), ZONING).select("city", "section", "line_no", "attribute", "pattern_id")
    return extract.locate(hits, docs.where("doc_id % 10 <> 0")).select("doc_id", "city", "section", "line_no", "attribute", "pattern_id")
