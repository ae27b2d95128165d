"""Registered queries over the given tables, each beside the SQL that must agree with it.

The corpus table plays the policy documents (source as city, language as section), orders
and lineitem play the zoning master and its edits, part plays the land-use table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.operators import (
    audit, evaluate, extract, features, landuse, profile, sampling, training,
)
from zoneflow.plans.registry import ORACLES, QUERIES, register, table  # noqa: F401
from zoneflow.plans.rules import RuleSet
from zoneflow.session import hold
from zoneflow.sources import corpus, images, logs, tables

def dealt(df: DataFrame) -> DataFrame:
    """Dealt over ``zoneflow.input.partitions`` tasks where the session sets that: for tables in
    one file that cannot be split. Unset, a table keeps its splits."""
    parts = df.sparkSession.conf.get("zoneflow.input.partitions", None)
    return df.repartition(int(parts)) if parts else df


# --- documents and extraction -----------------------------------------------------------

CORPUS = RuleSet.from_dicts(
    {
        "account": [r"(?i)the.+and", r"(?i)(la|de).+(el|le)", r"(?i)tion"],
        "extension": [r"\([0-9]{3}\)", r"(?i)in.+the"],
    },
    {"account": (1e6, 1e16), "extension": (100, 999)},
)
CORPUS_CODE = r"[A-Z][a-z]+ing"
CORPUS_WORDS = ["the", "ing", "tion", "elle"]


def documents(spark, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("city"), F.col("lang").alias("section"), "text"
    ))


def doc_lines(spark, sf_dir: str) -> DataFrame:
    return corpus.lines(documents(spark, sf_dir))


def values_list(rules: RuleSet) -> str:
    return ",".join(
        f"('{r.attribute}',{r.pattern_id},'{r.pattern}',{r.lo!r}::DOUBLE,{r.hi!r}::DOUBLE)"
        for r in rules.rules
    )


LINES_SQL = """lines AS (
  SELECT doc_id, city, section, len(l) AS n_lines, unnest(l) AS line,
         CAST(generate_subscripts(l, 1) AS INTEGER) AS line_no
  FROM (SELECT doc_id, source AS city, lang AS section,
               string_split(replace(text, chr(160), ' '), chr(10)) AS l FROM documents))"""

_NUMBER_MAP = "MAP {" + ",".join(f"'{w}':{n}::BIGINT" for w, n in tx.NUMBER_WORDS.items()) + "}"
_FLAT = f"trim(regexp_replace(line, '[{tx.SPACE_CLASS}]+', ' ', 'g'))"
# A token's value: one word, or tens and units (larger compounds do not occur in the tables).
DIGITS_SQL = f"""array_to_string(list_transform(string_split({_FLAT}, ' '), lambda t: COALESCE(CAST(
  list_sum(list_filter(list_transform(string_split(lower(t), '-'), lambda p: {_NUMBER_MAP}[p]), lambda v: v IS NOT NULL))
  AS BIGINT)::VARCHAR, t)), ' ')"""


def hits_sql(rules: RuleSet) -> str:
    """CTEs ``lines`` and ``hits`` (list-valued ``vals``)."""
    return f"""{LINES_SQL},
rules(attribute, pattern_id, pattern, lo, hi) AS (VALUES {values_list(rules)}),
matched AS (SELECT lines.*, attribute, pattern_id, lo, hi FROM lines JOIN rules ON regexp_matches(line, pattern)),
cleaned AS (SELECT *, replace({DIGITS_SQL}, ',', '') AS c FROM matched),
ints AS (SELECT *, list_transform(list_concat(regexp_extract_all(c, '\\s[0-9]+\\s'), regexp_extract_all(c, '\\([0-9]+\\)')),
                   lambda x: CAST(regexp_replace(x, '[() ]', '', 'g') AS DOUBLE)) AS n FROM cleaned),
hits AS (SELECT *, list_sort(list_distinct(list_filter(n, lambda v: v > lo AND v < hi))) AS vals
         FROM ints WHERE len(list_filter(n, lambda v: v > lo AND v < hi)) > 0)"""


HIT_SELECT = """SELECT doc_id, city, attribute, pattern_id,
  array_to_string(list_transform(vals, lambda v: CAST(v AS VARCHAR)), ', ') AS "values",
  line AS context, section, line_no, (line_no - 1) / n_lines * 100 AS fraction FROM hits"""


def hits_of(spark, sf_dir, rules=CORPUS):
    return extract.attributes(doc_lines(spark, sf_dir), rules)


@register("attribute_hits", f"WITH {hits_sql(CORPUS)} {HIT_SELECT}")
def attribute_hits(spark, sf_dir):
    return hits_of(spark, sf_dir).drop("value_list")


@register("attribute_hit_multiplicity", f"""WITH {hits_sql(CORPUS)},
per AS (SELECT doc_id, line_no, attribute, count(*) AS patterns FROM hits GROUP BY ALL)
SELECT attribute, patterns, count(*) AS lines FROM per GROUP BY ALL""")
def attribute_hit_multiplicity(spark, sf_dir):
    per_line = hits_of(spark, sf_dir).groupBy("doc_id", "line_no", "attribute").agg(F.count("*").alias("patterns"))
    return per_line.groupBy("attribute", "patterns").agg(F.count("*").alias("lines"))


@register("rule_lines", f"""WITH {LINES_SQL},
rules(attribute, pattern_id, pattern, lo, hi) AS (VALUES {values_list(CORPUS)})
SELECT attribute, pattern_id, city, count(*) AS n FROM lines JOIN rules ON regexp_matches(line, pattern)
GROUP BY ALL""")
def rule_lines(spark, sf_dir):
    """Lines per rule, numbers or not."""
    marks = [F.when(F.col("line").rlike(tx.line_pattern(r.pattern)), F.struct(
        F.lit(r.attribute).alias("attribute"), F.lit(r.pattern_id).alias("pattern_id"))) for r in CORPUS.rules]
    found = doc_lines(spark, sf_dir).select("city", F.inline(F.array_compact(F.array(*marks))))
    return found.groupBy("attribute", "pattern_id", "city").agg(F.count("*").alias("n"))


def zone_sql(rules: RuleSet, pattern: str) -> str:
    return f"""WITH {hits_sql(rules)},
coded AS (SELECT doc_id, line_no AS at, regexp_extract_all(line, '{pattern}') AS codes FROM lines
          WHERE regexp_matches(line, '{pattern}')),
near AS (SELECT h.doc_id, h.line_no, list_sort(list_distinct(flatten(list(codes)))) AS zones
         FROM (SELECT DISTINCT doc_id, line_no FROM hits) h JOIN coded c
           ON h.doc_id = c.doc_id AND c.at BETWEEN h.line_no - 19 AND h.line_no + 19 GROUP BY ALL)
SELECT h.doc_id, h.attribute, h.pattern_id, h.line_no, array_to_string(zones, ', ') AS zone_candidates
FROM hits h LEFT JOIN near USING (doc_id, line_no)"""


@register("zone_candidates_window", zone_sql(CORPUS, CORPUS_CODE))
def zone_candidates_window(spark, sf_dir):
    lines = doc_lines(spark, sf_dir)
    found = extract.zone_candidates(lines, extract.attributes(lines, CORPUS), CORPUS_CODE)
    return found.select("doc_id", "attribute", "pattern_id", "line_no", "zone_candidates")


@register("document_hits", zone_sql(CORPUS, CORPUS_CODE))
def document_hits(spark, sf_dir):
    found = extract.document_hits(documents(spark, sf_dir), CORPUS, CORPUS_CODE)
    return found.select("doc_id", "attribute", "pattern_id", "line_no", "zone_candidates")


@register("hits_with_zones", f"SELECT * FROM ({zone_sql(CORPUS, CORPUS_CODE)}) WHERE zone_candidates IS NOT NULL")
def hits_with_zones(spark, sf_dir):
    return extract.with_zones_only(zone_candidates_window(spark, sf_dir))


@register("hit_context_lines", f"""WITH {hits_sql(CORPUS)}
SELECT l.doc_id, h.line_no AS hit_line, l.line_no, l.line, l.line_no = h.line_no AS is_hit
FROM (SELECT DISTINCT doc_id, line_no FROM hits) h JOIN lines l
  ON l.doc_id = h.doc_id AND l.line_no BETWEEN h.line_no - 19 AND h.line_no + 19""")
def hit_context_lines(spark, sf_dir):
    lines = doc_lines(spark, sf_dir)
    return extract.context(lines, extract.attributes(lines, CORPUS))


@register("find_information", f"""WITH {hits_sql(CORPUS)} SELECT doc_id, line_no, pattern_id, line AS context
FROM hits WHERE city = 'src1' AND attribute = 'account'""")
def find_information(spark, sf_dir):
    found = extract.find_information(hits_of(spark, sf_dir), "src1", "account")
    return found.select("doc_id", "line_no", "pattern_id", "context")


@register("number_words", f"""WITH {LINES_SQL} SELECT doc_id, line_no, {DIGITS_SQL} AS text FROM lines""")
def number_words(spark, sf_dir):
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", tx.digits_for_words("line").alias("text"))


@register("line_fraction", f"""WITH {LINES_SQL} SELECT section, count(*) AS lines,
round(avg((line_no - 1) / n_lines * 100), 6) AS mean_fraction FROM lines GROUP BY section""")
def line_fraction(spark, sf_dir):
    part = (F.col("line_no") - 1) / F.col("n_lines") * 100
    return doc_lines(spark, sf_dir).groupBy("section").agg(
        F.count("*").alias("lines"), F.round(F.avg(part), 6).alias("mean_fraction"))


@register("district_tokens", f"""WITH {LINES_SQL}
SELECT DISTINCT city, unnest(regexp_extract_all(line, '{CORPUS_CODE}')) AS district FROM lines""")
def district_tokens(spark, sf_dir):
    return extract.districts(doc_lines(spark, sf_dir), CORPUS_CODE)[0]


@register("district_contexts", f"""WITH {LINES_SQL}
SELECT doc_id, line_no, line FROM lines WHERE regexp_matches(line, '{tx.DISTRICT_CODE}')
UNION ALL SELECT doc_id, line_no, line FROM lines WHERE regexp_matches(line, '{CORPUS_CODE}')""")
def district_contexts(spark, sf_dir):
    lines = doc_lines(spark, sf_dir)
    both = extract.districts(lines)[1].unionByName(extract.districts(lines, CORPUS_CODE)[1])
    return both.select("doc_id", "line_no", "line")


@register("coverage_by_attribute", f"""WITH {hits_sql(CORPUS)}
SELECT attribute, count(DISTINCT city) AS found_cities, (SELECT count(DISTINCT source) FROM documents) AS all_cities,
  count(DISTINCT city) / (SELECT count(DISTINCT source) FROM documents) * 100 AS pct_found
FROM hits GROUP BY attribute""")
def coverage_by_attribute(spark, sf_dir):
    cities = table(spark, sf_dir, "documents").select(F.col("source").alias("city"))
    return extract.coverage(hits_of(spark, sf_dir), cities)


@register("zone_split", f"""WITH {hits_sql(CORPUS)},
zones(zone) AS (VALUES {",".join(f"('{w}')" for w in CORPUS_WORDS)})
SELECT doc_id, line_no, attribute, pattern_id, zone FROM hits JOIN zones ON contains(line, zone)
UNION ALL
SELECT doc_id, line_no, attribute, pattern_id, 'no_zone' FROM hits
WHERE NOT EXISTS (SELECT 1 FROM zones WHERE contains(line, zone))""")
def zone_split(spark, sf_dir):
    found = extract.split_by_zone(hits_of(spark, sf_dir), CORPUS_WORDS)
    return found.select("doc_id", "line_no", "attribute", "pattern_id", "zone")


@register("apply_values", f"""WITH {hits_sql(CORPUS)},
zones(zone) AS (VALUES {",".join(f"('{w}')" for w in CORPUS_WORDS)}),
ranked AS (SELECT zone, attribute, vals[1] AS v, row_number() OVER (PARTITION BY zone, attribute ORDER BY doc_id, line_no, pattern_id) AS rn
           FROM hits JOIN zones ON contains(line, zone)),
wide AS (SELECT zone, max(CASE WHEN attribute = 'account' THEN v END) AS account,
                max(CASE WHEN attribute = 'extension' THEN v END) AS extension FROM ranked WHERE rn = 1 GROUP BY zone)
SELECT COALESCE(t.zn_code, w.zone) AS zn_code, COALESCE(w.account, t.account) AS account, w.extension
FROM (SELECT r_name AS zn_code, r_regionkey::DOUBLE AS account FROM region UNION ALL SELECT 'the', -1) t
FULL JOIN wide w ON t.zn_code = w.zone""")
def apply_values(spark, sf_dir):
    known = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("zn_code"), F.col("r_regionkey").cast("double").alias("account"))
    known = known.union(spark.createDataFrame([("the", -1.0)], known.schema))
    zoned = extract.split_by_zone(hits_of(spark, sf_dir), CORPUS_WORDS)
    return extract.apply_values(known, zoned, ["account", "extension"])[0]


# --- paths --------------------------------------------------------------------------------

def shipment_paths(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.concat_ws(
        "/", F.lit("supply"), F.concat(F.lit("supplier "), F.col("l_suppkey")),
        F.date_format("l_shipdate", "MM-dd-yy"), F.concat(F.lit("Part "), F.col("l_partkey"), F.lit(".txt")),
    ).alias("path"))


SHIPMENT_SQL = """paths AS (SELECT 'supply/supplier ' || l_suppkey || '/' || strftime(l_shipdate, '%m-%d-%y')
  || '/Part ' || l_partkey || '.txt' AS path FROM lineitem),
parts AS (SELECT path, split_part(path, '/', 1) AS root, split_part(path, '/', 2) AS city,
  CAST(strptime(split_part(path, '/', 3), '%m-%d-%y') AS DATE) AS scrape_date, split_part(path, '/', 4) AS title FROM paths)"""


@register("latest_version", f"""WITH {SHIPMENT_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY root, city, title ORDER BY scrape_date DESC, path DESC) AS rn FROM parts)
SELECT path, root, city, scrape_date, title, split_part(title, '.', 1) AS section FROM ranked WHERE rn = 1""")
def latest_version(spark, sf_dir):
    return corpus.select_documents(shipment_paths(spark, sf_dir), most_recent=True)


@register("latest_documents", """WITH d AS (SELECT doc_id, text, 'corpus/' || lang || '/' ||
    strftime(DATE '2020-01-01' + CAST(n_chars % 1000 AS INTEGER), '%m-%d-%y') || '/' || source || '-' || lpad(CAST(n_chars % 7 AS VARCHAR), 2, '0') || '-' || doc_id % 11 || '.txt' AS path,
    lang, DATE '2020-01-01' + CAST(n_chars % 1000 AS INTEGER) AS day, source || '-' || lpad(CAST(n_chars % 7 AS VARCHAR), 2, '0') || '-' || doc_id % 11 AS title FROM documents),
  best AS (SELECT lang, title, max(day) AS day FROM d GROUP BY ALL)
SELECT doc_id, path, md5(text) AS digest FROM d JOIN best USING (lang, title, day)""")
def latest_documents(spark, sf_dir):
    """Documents filed under made paths: date and title follow from length and id."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("n_chars") % 1000).cast("int"))
    title = F.concat_ws("-", "source", F.lpad((F.col("n_chars") % 7).cast("string"), 2, "0"), F.col("doc_id") % 11)
    docs = dealt(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.concat_ws("/", F.lit("corpus"), "lang", F.date_format(day, "MM-dd-yy"), F.concat(title, F.lit(".txt"))).alias("path"))
    return corpus.select_documents(docs, most_recent=True).select("doc_id", "path", F.md5("text").alias("digest"))


def product_paths(spark, sf_dir):
    joined = landuse.join_types(
        table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_shipdate"),
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size"), "p_partkey")
    return joined.select(F.concat_ws(
        "/", F.lit("parts"), "p_brand", F.date_format("l_shipdate", "MM-dd-yy"),
        F.concat("p_name", F.lit("; Title "), F.col("p_size"), F.lit(".02.txt")),
    ).alias("path"))


@register("document_selection", """WITH paths AS (
  SELECT 'parts/' || p_brand || '/' || strftime(l_shipdate, '%m-%d-%y') || '/' || p_name || '; Title ' || p_size || '.02.txt' AS path,
         p_brand, p_name, p_size, CAST(l_shipdate AS DATE) AS d
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT path, 'parts' AS root, p_brand AS city, d AS scrape_date, p_name || '; Title ' || p_size || '.02.txt' AS title,
  p_name || '; Title ' || p_size AS section
FROM paths WHERE (regexp_matches(p_name, '(^| )(ring|gear)( |$)') OR p_size = 17) AND p_brand = 'Brand#7'""")
def document_selection(spark, sf_dir):
    return corpus.select_documents(product_paths(spark, sf_dir), whitelist=["Ring", "gear", "title-17"], city="Brand#7")


@register("path_terms", """SELECT url, regexp_matches(lower(url), '(^|[/.,!?;: &])(en|fr|com)([/.,!?;: &]|$)') AS listed FROM pages""")
def path_terms(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("url", corpus.on_whitelist("url", ["EN", "fr", "com"]).alias("listed"))


@register("image_inventory", """SELECT regexp_extract(p, '([^/]*)$', 1) AS image_file,
  regexp_extract(p, '([^/]*)/[^/]*$', 1) AS label, regexp_extract(p, '^(.*)/[^/]*$', 1) AS image_path
FROM (SELECT 'images/' || p_type || '/' || p_partkey || '.jpg' AS p FROM part)""")
def image_inventory(spark, sf_dir):
    paths = table(spark, sf_dir, "part").select(
        F.concat(F.lit("images//"), "p_type", F.lit("/"), "p_partkey", F.lit(".jpg")).alias("path"))
    return images.from_paths(paths)


@register("cities_of_corpus", f"WITH {SHIPMENT_SQL} SELECT DISTINCT city FROM parts")
def cities_of_corpus(spark, sf_dir):
    return corpus.cities(shipment_paths(spark, sf_dir))


@register("city_documents", f"WITH {SHIPMENT_SQL} SELECT path FROM parts WHERE city = 'supplier 7'")
def city_documents(spark, sf_dir):
    return corpus.city_documents(shipment_paths(spark, sf_dir), "Supplier 7")


# --- edit audit ----------------------------------------------------------------------------

MASTER_COLUMNS = ["recid", "city_name", "zn_code", "max_dua", "units_per_lot", "minimum_lot_sqft", "editor", "edit_date"]
MASTER_SQL = """master AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS recid, o_orderpriority AS city_name, o_orderstatus AS zn_code,
    o_totalprice AS max_dua, units_per_lot, minimum_lot_sqft, 'clerk' AS editor, o_orderdate AS edit_date
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS units_per_lot, max(l_extendedprice) AS minimum_lot_sqft
                         FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""
ENTRIES_SQL = """entries AS (
  SELECT recid, city_name,
    CASE WHEN zn_code = 'F' AND city_name = '1-URGENT' THEN 'F-rush' ELSE zn_code END AS zn_code,
    CASE WHEN zn_code = 'P' THEN max_dua * 1.5 WHEN zn_code = 'O' AND city_name = '5-LOW' THEN NULL ELSE max_dua END AS max_dua,
    COALESCE(units_per_lot, 7.0) AS units_per_lot, minimum_lot_sqft,
    CASE WHEN zn_code = 'P' THEN 'auditor' ELSE editor END AS editor,
    CASE WHEN zn_code = 'P' THEN edit_date + INTERVAL 30 DAY WHEN zn_code = 'F' THEN edit_date - INTERVAL 1 DAY ELSE edit_date END AS edit_date
  FROM master
  UNION ALL
  SELECT 'c' || c_custkey, c_mktsegment, 'O', c_acctbal, NULL, NULL, 'clerk', TIMESTAMP '2001-01-01 00:00:00' FROM customer WHERE c_acctbal < 0)"""


def master_and_entries(spark, sf_dir):
    """Orders as master; entries change status, price, units and dates, leave some rows as
    they are and add one row per customer in debt."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("units_per_lot"), F.max("l_extendedprice").alias("minimum_lot_sqft"))
    orders = table(spark, sf_dir, "orders")
    master = orders.join(items, orders.o_orderkey == items.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("recid"), F.col("o_orderpriority").alias("city_name"),
        F.col("o_orderstatus").alias("zn_code"), F.col("o_totalprice").alias("max_dua"),
        "units_per_lot", "minimum_lot_sqft", F.lit("clerk").alias("editor"),
        F.col("o_orderdate").cast("timestamp").alias("edit_date"))
    master = hold(master)
    zn, city = F.col("zn_code"), F.col("city_name")
    day = F.expr("INTERVAL 1 DAY")
    edited = master.select(
        "recid", "city_name",
        F.when((zn == "F") & (city == "1-URGENT"), "F-rush").otherwise(zn).alias("zn_code"),
        F.when(zn == "P", F.col("max_dua") * 1.5).when((zn == "O") & (city == "5-LOW"), None).otherwise(F.col("max_dua")).alias("max_dua"),
        F.coalesce("units_per_lot", F.lit(7.0)).alias("units_per_lot"), "minimum_lot_sqft",
        F.when(zn == "P", "auditor").otherwise(F.col("editor")).alias("editor"),
        F.when(zn == "P", F.col("edit_date") + F.expr("INTERVAL 30 DAY")).when(zn == "F", F.col("edit_date") - day)
        .otherwise(F.col("edit_date")).alias("edit_date"))
    null = F.lit(None).cast("double")
    added = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.concat(F.lit("c"), "c_custkey").alias("recid"), F.col("c_mktsegment").alias("city_name"),
        F.lit("O").alias("zn_code"), F.col("c_acctbal").alias("max_dua"), null.alias("units_per_lot"),
        null.alias("minimum_lot_sqft"), F.lit("clerk").alias("editor"),
        F.lit("2001-01-01 00:00:00").cast("timestamp").alias("edit_date"))
    return master, edited.unionByName(added)


def _audit_sql(new_table: str, keep: str) -> str:
    """Shared comparison: pairs, change list, ranges and novel texts."""
    numeric = ["max_dua", "units_per_lot", "minimum_lot_sqft"]
    text = ["city_name", "zn_code", "editor"]
    changed = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in MASTER_COLUMNS)
    ranges = ", ".join(
        f"CASE WHEN val_{c} IS NOT NULL AND (edit_type <> 'U' OR old_{c} IS DISTINCT FROM new_{c}) "
        f"AND (val_{c} < lo_{c} OR val_{c} > hi_{c}) "
        f"THEN '{c} value is out of range (val = ' || CAST(val_{c} AS VARCHAR) || ')' END" for c in numeric)
    novel = ", ".join(
        f"CASE WHEN new_{c} IS NOT NULL AND (edit_type = 'C' OR (edit_type = 'U' AND old_{c} IS NOT NULL)) "
        f"AND new_{c} NOT IN (SELECT {c} FROM master) "
        f"THEN '\"' || new_{c} || '\" not in other row records for {c}' END" for c in text)

    def row_text(p: str) -> str:
        return "concat_ws('|', " + ", ".join(f"COALESCE(CAST({p}.{c} AS VARCHAR), '')" for c in MASTER_COLUMNS) + ")"

    nulls_old = " + ".join(f"CAST(o.{c} IS NULL AS INT)" for c in numeric)
    nulls_new = " + ".join(f"CAST(n.{c} IS NULL AS INT)" for c in numeric)
    to_null = " + ".join(f"CAST(o.{c} IS NOT NULL AND n.{c} IS NULL AS INT)" for c in numeric)
    bounds = ", ".join(f"quantile_cont({c}, 0.05) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in numeric)
    values = ", ".join([f"o.{c} AS old_{c}, n.{c} AS new_{c}" for c in numeric + text]
                       + [f"CASE WHEN n.recid IS NULL THEN o.{c} ELSE n.{c} END AS val_{c}" for c in numeric])
    return f"""{MASTER_SQL}, {ENTRIES_SQL}, {new_table}
bounds AS (SELECT {bounds} FROM master),
pairs AS (SELECT COALESCE(n.recid, o.recid) AS recid, COALESCE(n.city_name, o.city_name) AS city_name,
  CASE WHEN o.recid IS NULL THEN 'C' WHEN n.recid IS NULL THEN 'D' ELSE 'U' END AS edit_type,
  CASE WHEN o.recid IS NULL OR n.recid IS NULL THEN [] ELSE list_filter([{changed}], lambda x: x IS NOT NULL) END AS cols,
  ({nulls_old}) - ({nulls_new}) AS from_null, {to_null} AS to_null, {values},
  CASE WHEN n.recid IS NULL THEN o.editor ELSE n.editor END AS editor,
  CASE WHEN n.recid IS NULL THEN o.edit_date ELSE n.edit_date END AS edit_timestamp,
  n.edit_date < o.edit_date AS stale_edit,
  CASE WHEN o.recid IS NOT NULL THEN {row_text('o')} END AS old_vals, CASE WHEN n.recid IS NOT NULL THEN {row_text('n')} END AS new_vals
  FROM {keep}),
warned AS (SELECT *, list_filter([{ranges}], lambda x: x IS NOT NULL) AS range_w,
  list_filter([{novel}], lambda x: x IS NOT NULL) AS novel_w FROM pairs, bounds),
log AS (SELECT recid, city_name, edit_type, array_to_string(cols, ',') AS cols_updated,
  CASE WHEN edit_type = 'U' THEN from_null END AS updated_from_nan, CASE WHEN edit_type = 'U' THEN to_null END AS updated_to_nan,
  CASE WHEN edit_type = 'U' THEN len(cols) - from_null END AS changed_vals, len(range_w) AS out_of_range,
  array_to_string(list_concat(range_w, novel_w), '; ') AS warnings, list_concat(range_w, novel_w) AS w,
  editor, CAST(edit_timestamp AS VARCHAR) AS edit_timestamp, 1 AS main_version, stale_edit, old_vals, new_vals FROM warned)"""


ENTRY_AUDIT = _audit_sql("", "entries n LEFT JOIN master o ON n.recid = o.recid")
MASTER_AUDIT = _audit_sql(
    "newer AS (SELECT * FROM entries WHERE NOT (zn_code = 'O' AND max_dua > 400000)),",
    "(SELECT * FROM newer) n FULL JOIN master o ON n.recid = o.recid WHERE "
    + " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in MASTER_COLUMNS))


def _row_text(side: str):
    def cell(c: str):
        v = F.col(side)[c]
        return F.coalesce(tx.float_text(v) if c in ("max_dua", "units_per_lot", "minimum_lot_sqft") else v.cast("string"), F.lit(""))
    return F.when(F.col(side).isNotNull(), F.concat_ws("|", *[cell(c) for c in MASTER_COLUMNS]))


def _flat_log(log: DataFrame) -> DataFrame:
    return log.select(
        "recid", "city_name", "edit_type", F.array_join("cols_updated", ",").alias("cols_updated"),
        "updated_from_nan", "updated_to_nan", "changed_vals", "out_of_range",
        F.array_join("warnings", "; ").alias("warnings"), "editor",
        F.col("edit_timestamp").cast("string").alias("edit_timestamp"), "main_version", "stale_edit",
        _row_text("old_row").alias("old_vals"), _row_text("new_row").alias("new_vals"))


@register("audit_update_log", f"WITH {ENTRY_AUDIT} SELECT * EXCLUDE (w) FROM log")
def audit_update_log(spark, sf_dir):
    master, entries = master_and_entries(spark, sf_dir)
    return _flat_log(audit.updates(master, entries).update_log)


@register("audit_warning_log", f"""WITH {ENTRY_AUDIT}
SELECT city_name AS city, editor, edit_timestamp, recid, unnest(w) AS warning FROM log""")
def audit_warning_log(spark, sf_dir):
    master, entries = master_and_entries(spark, sf_dir)
    return logs.stored_warnings(audit.updates(master, entries).warning_log)


@register("audit_masters_log", f"WITH {MASTER_AUDIT} SELECT * EXCLUDE (w) FROM log")
def audit_masters_log(spark, sf_dir):
    master, entries = master_and_entries(spark, sf_dir)
    newer = entries.where(~F.coalesce((F.col("zn_code") == "O") & (F.col("max_dua") > 400000), F.lit(None)))
    return _flat_log(audit.updates(master, newer, mode="masters").update_log)


@register("normal_ranges", f"""WITH {MASTER_SQL}
SELECT 'max_dua' AS "column", round(quantile_cont(max_dua, 0.05), 6) AS p05, round(quantile_cont(max_dua, 0.95), 6) AS p95 FROM master
UNION ALL SELECT 'units_per_lot', round(quantile_cont(units_per_lot, 0.05), 6), round(quantile_cont(units_per_lot, 0.95), 6) FROM master
UNION ALL SELECT 'minimum_lot_sqft', round(quantile_cont(minimum_lot_sqft, 0.05), 6), round(quantile_cont(minimum_lot_sqft, 0.95), 6) FROM master""")
def normal_ranges(spark, sf_dir):
    master, _ = master_and_entries(spark, sf_dir)
    found = audit.normal_ranges(master, ["max_dua", "units_per_lot", "minimum_lot_sqft"])
    rows = spark.createDataFrame([(c, *b) for c, b in found.items()], "column string, p05 double, p95 double")
    return rows.select("column", F.round("p05", 6).alias("p05"), F.round("p95", 6).alias("p95"))


@register("changed_rows_once", f"""WITH {MASTER_SQL}, {ENTRIES_SQL}
SELECT {", ".join(c if c != "edit_date" else "CAST(edit_date AS VARCHAR) AS edit_date" for c in MASTER_COLUMNS)}
FROM (SELECT * FROM master UNION ALL SELECT * FROM entries) GROUP BY {", ".join(MASTER_COLUMNS)} HAVING count(*) = 1""")
def changed_rows_once(spark, sf_dir):
    master, entries = master_and_entries(spark, sf_dir)
    return audit.changed_rows(master, entries).withColumn("edit_date", F.col("edit_date").cast("string"))


@register("keys_added_dropped", """SELECT COALESCE(k, o) AS recid, CASE WHEN o IS NULL THEN 'added' ELSE 'dropped' END AS change
FROM (SELECT DISTINCT l_orderkey * 2 AS k FROM lineitem) n FULL JOIN (SELECT o_orderkey AS o FROM orders) m ON k = o
WHERE k IS NULL OR o IS NULL""")
def keys_added_dropped(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("recid"))
    new = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 2).alias("recid"))
    return audit.keys_added_dropped(old, new)


@register("keys_with_two_rows", "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) = 2")
def keys_with_two_rows(spark, sf_dir):
    return audit.keys_with_n_rows(table(spark, sf_dir, "lineitem"), "l_orderkey", 2)


@register("duplicate_keys", """SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return audit.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register("parcels_affected", """SELECT o_orderkey AS recid, o_orderstatus, n AS num_parcels_affected
FROM orders LEFT JOIN (SELECT l_orderkey, count(CASE WHEN l_discount > 0 THEN l_partkey END) AS n FROM lineitem GROUP BY 1)
ON l_orderkey = o_orderkey""")
def parcels_affected(spark, sf_dir):
    log = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("recid"), "o_orderstatus")
    parcels = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("recid"), F.when(F.col("l_discount") > 0, F.col("l_partkey")).alias("geom_id"))
    return audit.parcels_affected(log, parcels)


AS_OF = datetime(1999, 1, 1)


@register("table_as_of", """WITH edits AS (
  SELECT l_orderkey AS recid, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'D' ELSE 'U' END AS edit_type, l_linestatus AS status, l_extendedprice AS price,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC) AS rn
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'),
last AS (SELECT * FROM edits WHERE rn = 1)
SELECT o_orderkey AS recid, COALESCE(l.status, o_orderstatus) AS status, COALESCE(l.price, o_totalprice) AS price
FROM orders LEFT JOIN last l ON l.recid = o_orderkey WHERE l.edit_type IS DISTINCT FROM 'D'""")
def table_as_of(spark, sf_dir):
    """Orders with their items read as dated edits."""
    master = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("recid"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    log = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("recid"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "D").otherwise("U").alias("edit_type"),
        F.col("l_shipdate").cast("timestamp").alias("edit_timestamp"),
        F.col("l_linenumber").alias("batch_id"), F.col("l_partkey").alias("main_version"),
        F.struct(F.col("l_orderkey").alias("recid"), F.col("l_linestatus").alias("status"),
                 F.col("l_extendedprice").alias("price")).alias("new_row"))
    return audit.table_as_of(master, log, F.lit(AS_OF))


@register("logs_before", """SELECT file_name, count(*) AS n FROM (
  SELECT CASE WHEN l_returnflag = 'A' THEN 'update-log_' || strftime(l_shipdate, '%y-%m-%d_%H-%M') || '.csv'
              WHEN l_returnflag = 'N' THEN 'warnings_' || strftime(l_shipdate, '%y-%m-%d_%H-%M') || '.csv'
              ELSE 'notes.csv' END AS file_name, l_shipdate, l_returnflag FROM lineitem)
WHERE l_returnflag <> 'R' AND l_shipdate < TIMESTAMP '2001-06-01' AND l_shipdate >= TIMESTAMP '1900-01-01' GROUP BY 1""")
def logs_before(spark, sf_dir):
    stamp = F.date_format("l_shipdate", "yy-MM-dd_HH-mm")
    named = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("update-log_"), stamp, F.lit(".csv")))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("warnings_"), stamp, F.lit(".csv")))
        .otherwise("notes.csv").alias("file_name"))
    return logs.before(named, datetime(2001, 6, 1)).groupBy("file_name").agg(F.count("*").alias("n"))


@register("newest_row_per_key", """SELECT user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def newest_row_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return corpus.latest(rows, ["user_id"], ["ts", "event_id"]).withColumn("ts", F.col("ts").cast("string"))


@register("epoch_timestamps", """SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS edit_date FROM events""")
def epoch_timestamps(spark, sf_dir):
    ms = table(spark, sf_dir, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return ms.select("event_id", audit.epoch_to_timestamp("ms").cast("string").alias("edit_date"))


@register("declared_types", """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value,
  CAST(CAST(CASE WHEN event_type = 'view' THEN NULL ELSE date_trunc('second', ts) END AS TIMESTAMP) AS VARCHAR) AS ts, NULL::VARCHAR AS note FROM events""")
def declared_types(spark, sf_dir):
    """Events as an all-text feed, typed from declared column types; ``note`` never arrives."""
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_type") == "view", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"))
    schema = tables.declared_schema({"event_id": "text", "value": "number", "ts": "calendar_date", "note": "text"})
    typed = tables.cast_declared(raw, schema)
    return typed.select(F.col("event_id").cast("bigint").alias("event_id"), "value", F.col("ts").cast("string").alias("ts"), "note")


@register("filtered_scan", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def filtered_scan(spark, sf_dir):
    return tables.scan(table(spark, sf_dir, "orders"), select=["o_orderkey", "o_totalprice"],
                       where="o_orderstatus = 'F' AND o_totalprice > 250000",
                       order=[F.desc("o_totalprice"), "o_orderkey"], limit=100)


# --- training rows and sampling -------------------------------------------------------------

def md5_place(seed: int, *key: str) -> str:
    return f"md5(concat_ws('|', '{seed}', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in key) + "))"


NONE_SQL = f"""none_lines AS (SELECT * FROM lines l
  WHERE len(regexp_extract_all(line, '[^{tx.SPACE_CLASS}]+')) > 4 AND doc_id IN (SELECT doc_id FROM hits)
  AND NOT EXISTS (SELECT 1 FROM hits h WHERE h.doc_id = l.doc_id AND h.line_no = l.line_no))"""


def held_hits(spark, sf_dir):
    """Lines and hits; hits are kept for the several passes over them."""
    lines = doc_lines(spark, sf_dir)
    return lines, hold(extract.attributes(lines, CORPUS))


@register("none_class_lines", f"WITH {hits_sql(CORPUS)}, {NONE_SQL} SELECT doc_id, line_no, line FROM none_lines")
def none_class_lines(spark, sf_dir):
    lines, hits = held_hits(spark, sf_dir)
    return training.none_lines(lines, hits).select("doc_id", "line_no", "line")


@register("none_class_lines_of_documents", f"WITH {hits_sql(CORPUS)}, {NONE_SQL} SELECT doc_id, line_no, line FROM none_lines")
def none_class_lines_of_documents(spark, sf_dir):
    return training.none_lines_of(documents(spark, sf_dir), CORPUS).select("doc_id", "line_no", "line")


@register("downsample_median", f"""WITH {hits_sql(CORPUS)}, {NONE_SQL},
medians AS (SELECT city, quantile_cont(n, 0.5) AS m FROM (SELECT city, attribute, count(*) AS n FROM hits GROUP BY ALL) GROUP BY city),
ranked AS (SELECT n.*, m, row_number() OVER (PARTITION BY city ORDER BY {md5_place(11, "doc_id", "line_no")}) AS rn
           FROM none_lines n JOIN medians USING (city))
SELECT city, attribute, line AS context FROM hits
UNION ALL SELECT city, 'none', line FROM ranked WHERE rn <= round_even(m, 0)""")
def downsample_median(spark, sf_dir):
    hits = hold(hits_of(spark, sf_dir))
    none = hold(training.none_lines_of(documents(spark, sf_dir), CORPUS))
    return training.balanced(none, hits, 11)


@register("median_class_counts", f"""WITH {hits_sql(CORPUS)}
SELECT city, quantile_cont(n, 0.5) AS median_count FROM (SELECT city, attribute, count(*) AS n FROM hits GROUP BY ALL) GROUP BY city""")
def median_class_counts(spark, sf_dir):
    return training.median_class_counts(hits_of(spark, sf_dir))


def draws_sql(label: str, key: str, source: str, size: str, seed: int) -> str:
    """``ranked`` and ``drawn``: draw_no and the row each draw takes."""
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {md5_place(seed, key)}) - 1 AS rk,
  count(*) OVER (PARTITION BY {label}) AS n FROM {source}),
sizes AS (SELECT {label}, any_value(n) AS n, any_value({size}) AS m FROM ranked GROUP BY {label}),
draws AS (SELECT {label}, n, unnest(range(0, CAST(m AS BIGINT))) AS draw_no FROM sizes),
targets AS (SELECT {label}, draw_no, CAST('0x' || substr(md5('{seed}|draw|' || {label} || '|' || draw_no), 1, 15) AS BIGINT) % n AS rk FROM draws),
drawn AS (SELECT r.*, draw_no FROM targets JOIN ranked r USING ({label}, rk))"""


@register("upsample_factor", f"""WITH {draws_sql("o_orderstatus", "o_orderkey", "orders", "CASE o_orderstatus WHEN 'F' THEN 3 * n WHEN 'P' THEN 2 * n ELSE 0 END", 13)}
SELECT o_orderkey, o_orderstatus, draw_no FROM drawn
UNION ALL SELECT o_orderkey, o_orderstatus, NULL FROM orders WHERE o_orderstatus NOT IN ('F', 'P')""")
def upsample_factor(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.upsample(rows, "o_orderstatus", {"F": 3, "P": 2}, 13, ["o_orderkey"])


@register("resample_to_target", f"""WITH goal AS (SELECT CAST(bround AS BIGINT) AS target FROM (SELECT round_even(quantile_cont(n, 0.5), 0) AS bround
  FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1))),
{draws_sql("p_brand", "p_partkey", "part", "greatest((SELECT target FROM goal) - n, 0)", 17)}
SELECT p_partkey, p_brand, CAST(NULL AS BIGINT) AS draw_no FROM ranked WHERE rk < (SELECT target FROM goal)
UNION ALL SELECT p_partkey, p_brand, draw_no FROM drawn""")
def resample_to_target(spark, sf_dir):
    """Every brand brought to the median brand size."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    counts = profile.class_counts(rows, "p_brand")
    middle = counts.agg(F.bround(F.percentile("n", 0.5)).cast("bigint")).scalar()
    return sampling.resample(rows, "p_brand", counts.select("p_brand", middle.alias("target")), 17, ["p_partkey"])


@register("split_80_20", f"""SELECT event_id, event_type, rn <= round_even(0.8 * n, 0) AS in_train FROM (
  SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {md5_place(19, "event_id")}) AS rn,
         count(*) OVER (PARTITION BY event_type) AS n FROM events)""")
def split_80_20(spark, sf_dir):
    return sampling.split(table(spark, sf_dir, "events").select("event_id", "event_type"), ["event_type"], 0.8, 19, ["event_id"])


@register("three_way_split", f"""WITH a AS (SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5_place(23, "o_orderkey")}) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
b AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5_place(24, "o_orderkey")}) AS r2,
  count(*) OVER (PARTITION BY o_orderstatus) AS n2 FROM a WHERE rn <= round_even(0.75 * n, 0))
SELECT o_orderkey, o_orderstatus, CASE WHEN r2 <= round_even(0.75 * n2, 0) THEN 'train' ELSE 'valid' END AS part FROM b
UNION ALL SELECT o_orderkey, o_orderstatus, 'test' FROM a WHERE rn > round_even(0.75 * n, 0)""")
def three_way_split(spark, sf_dir):
    return sampling.three_way(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], 23, ["o_orderkey"])


@register("split_with_unlabelled", f"""WITH e AS (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events),
a AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY {md5_place(43, "event_id")}) AS rn, count(*) OVER (PARTITION BY kind) AS n FROM e),
b AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY {md5_place(44, "event_id")}) AS r2, count(*) OVER (PARTITION BY kind) AS n2
      FROM a WHERE rn <= round_even(0.75 * n, 0))
SELECT event_id, kind, CASE WHEN r2 <= round_even(0.75 * n2, 0) THEN 'train' ELSE 'valid' END AS part FROM b
UNION ALL SELECT event_id, kind, 'test' FROM a WHERE rn > round_even(0.75 * n, 0)""")
def split_with_unlabelled(spark, sf_dir):
    """Events of the commonest type carry no class; they are split like a class of their own."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"))
    return sampling.three_way(rows, ["kind"], 43, ["event_id"])


@register("random_rows", f"SELECT c_custkey, c_name FROM customer ORDER BY {md5_place(29, 'c_custkey')} LIMIT 45")
def random_rows(spark, sf_dir):
    return sampling.sample_n(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), 45, 29, ["c_custkey"])


@register("held_out_city", f"""WITH {LINES_SQL} SELECT city = 'src3' AS held_out, count(*) AS n FROM lines GROUP BY 1""")
def held_out_city(spark, sf_dir):
    seen, held = training.hold_out(doc_lines(spark, sf_dir), "src3")
    both = seen.select(F.lit(False).alias("held_out")).union(held.select(F.lit(True)))
    return both.groupBy("held_out").agg(F.count("*").alias("n"))


@register("split_is_complete", "SELECT count(*) AS rows, true AS preserved FROM events")
def split_is_complete(spark, sf_dir):
    flagged = split_80_20(spark, sf_dir)
    return training.check_split(table(spark, sf_dir, "events"), flagged.where("in_train"), flagged.where("NOT in_train"))


# --- profiles -------------------------------------------------------------------------------

@register("class_shares", "SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM events) AS share FROM events GROUP BY 1")
def class_shares(spark, sf_dir):
    return profile.class_shares(table(spark, sf_dir, "events"), "event_type")


@register("above_median_classes", """WITH s AS (SELECT p_brand, count(*) AS n, count(*) / (SELECT count(*) FROM part) AS share FROM part GROUP BY 1)
SELECT * FROM s WHERE share > (SELECT quantile_cont(share, 0.5) FROM s)""")
def above_median_classes(spark, sf_dir):
    return profile.above_median(table(spark, sf_dir, "part"), "p_brand")


def _rates_sql(source: str, columns: list[str], expr: str = "{c}") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", avg(CAST({expr.format(c=c)} IS NULL AS DOUBLE)) AS null_rate,
        avg(CAST({expr.format(c=c)} IS NULL AS DOUBLE)) = 0 AS complete FROM {source}""" for c in columns)


@register("null_rates", f"WITH {MASTER_SQL} {_rates_sql('master', MASTER_COLUMNS)}")
def null_rates(spark, sf_dir):
    return profile.null_rates(master_and_entries(spark, sf_dir)[0])


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("null_rates_zero_as_null", _rates_sql("lineitem", MEASURES, "nullif({c}, 0)"))
def null_rates_zero_as_null(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(*MEASURES)
    return profile.null_rates(profile.zero_as_null(items))


@register("describe_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max,
    round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem"""
    for c in MEASURES))
def describe_numeric(spark, sf_dir):
    out = profile.describe(table(spark, sf_dir, "lineitem").select(*MEASURES))
    rounded = ("mean", "stddev", "q25", "q50", "q75")
    return out.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in out.columns])


@register("boxplot_stats", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
    min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker,
    max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker,
    count(*) FILTER (NOT ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
    FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {t}) GROUP BY q1, q2, q3"""
    for t, c in (("documents", "n_chars"),)))
def boxplot_stats(spark, sf_dir):
    out = profile.boxplot(table(spark, sf_dir, "documents").select(F.col("n_chars").cast("double").alias("n_chars")), ["n_chars"])
    return out.select("column", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
                      *[F.col(c).cast("bigint").alias(c) for c in ("low_whisker", "high_whisker")], "outliers")


@register("minmax_norm", """SELECT l_orderkey, l_linenumber, l_partkey,
  round((l_extendedprice - lo) / (hi - lo), 9) AS l_extendedprice, round((l_tax - tl) / (th - tl), 9) AS l_tax
FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, min(l_tax) AS tl, max(l_tax) AS th FROM lineitem)""")
def minmax_norm(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_tax")
    return profile.minmax(items, ["l_extendedprice", "l_tax"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice", 9).alias("l_extendedprice"), F.round("l_tax", 9).alias("l_tax"))


#: Quantities of returned items are null, prices of some parts NaN.
HOLEY_SQL = """holey AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
  CASE WHEN l_partkey % 5 = 0 THEN 'NaN'::DOUBLE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice FROM lineitem),
clean AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN isnan(l_extendedprice) THEN NULL ELSE l_extendedprice END AS l_extendedprice FROM holey)"""
HOLEY = ["l_quantity", "l_extendedprice"]


def holey_items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_partkey") % 5 == 0, float("nan")).when(F.col("l_partkey") % 7 == 0, None)
        .otherwise(F.col("l_extendedprice")).alias("l_extendedprice"))


@register("null_rates_with_nan", f"WITH {HOLEY_SQL} {_rates_sql('clean', HOLEY)}")
def null_rates_with_nan(spark, sf_dir):
    return profile.null_rates(holey_items(spark, sf_dir), HOLEY)


@register("describe_with_nan", f"WITH {HOLEY_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max,
    round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM clean"""
    for c in HOLEY))
def describe_with_nan(spark, sf_dir):
    out = profile.describe(holey_items(spark, sf_dir), HOLEY)
    rounded = ("mean", "stddev", "q25", "q50", "q75")
    return out.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in out.columns])


@register("boxplot_with_nan", f"WITH {HOLEY_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
    min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker,
    max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker,
    count(*) FILTER (NOT ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
    FROM clean, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM clean) GROUP BY q1, q2, q3"""
    for c in HOLEY))
def boxplot_with_nan(spark, sf_dir):
    out = profile.boxplot(holey_items(spark, sf_dir), HOLEY)
    return out.select("column", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "low_whisker", "high_whisker", "outliers")


@register("minmax_with_nan", f"""WITH {HOLEY_SQL} SELECT l_orderkey, l_linenumber, l_quantity, round((l_extendedprice - lo) / (hi - lo), 9) AS l_extendedprice
FROM clean, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM clean)""")
def minmax_with_nan(spark, sf_dir):
    return profile.minmax(holey_items(spark, sf_dir), ["l_extendedprice"]).withColumn("l_extendedprice", F.round("l_extendedprice", 9))


# --- land use -------------------------------------------------------------------------------

PRODUCT_USES = {"small": ["small", "SMALL"], "large": ["large", "LARGE"], "metal": ["bolt", "gear", "plate"], "promo": ["PROMO"]}


def described_parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("plu_description"))


_FLAGS = " + ".join(
    "CAST(" + " OR ".join(f"contains(d, '{w}')" for w in words) + " AS INT)" for words in PRODUCT_USES.values())
_CASES = " ".join(
    "WHEN " + " OR ".join(f"contains(d, '{w}')" for w in words) + f" THEN '{use}'" for use, words in PRODUCT_USES.items())


@register("land_use_labels", f"""SELECT p_partkey, d AS plu_description, CASE {_CASES} END AS label
FROM (SELECT p_partkey, p_name || ' ' || p_type AS d FROM part) WHERE {_FLAGS} = 1""")
def land_use_labels(spark, sf_dir):
    return landuse.labels(described_parts(spark, sf_dir), uses=PRODUCT_USES)


@register("land_use_described", f"""SELECT p_partkey, d AS plu_description FROM (SELECT p_partkey, p_name || ' ' || p_type AS d FROM part) WHERE {_FLAGS} > 0""")
def land_use_described(spark, sf_dir):
    return landuse.described(described_parts(spark, sf_dir), uses=PRODUCT_USES)


@register("type_join", """SELECT l_orderkey, l_linenumber, l_partkey AS building_type, p_type, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey""")
def type_join(spark, sf_dir):
    buildings = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("building_type"))
    types = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("building_type"), "p_type", "p_brand")
    return landuse.join_types(buildings, types)


@register("polygon_centroid", """SELECT l_orderkey, l_linenumber, l_partkey,
  round((2 * l_quantity + l_extendedprice + l_linenumber) / 4, 9) AS lon, round((2 * l_tax + l_discount + l_suppkey) / 4, 9) AS lat FROM lineitem""")
def polygon_centroid(spark, sf_dir):
    """A triangle per item, closed by its first vertex, read from GeoJSON text."""
    def vertex(x: str, y: str):
        return F.concat(F.lit("["), F.col(x), F.lit(","), F.col(y), F.lit("]"))

    ring = F.concat_ws(",", vertex("l_quantity", "l_tax"), vertex("l_extendedprice", "l_discount"),
                       vertex("l_linenumber", "l_suppkey"), vertex("l_quantity", "l_tax"))
    geometry = F.concat(F.lit('{"type":"MultiPolygon","coordinates":[[['), ring, F.lit("]]]}"))
    items = dealt(table(spark, sf_dir, "lineitem")).select("l_orderkey", "l_linenumber", "l_partkey", geometry.alias("geometry"))
    return landuse.with_centroid(items).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


# --- features and evaluation ----------------------------------------------------------------

@register("frequency_encode", """SELECT doc_id, share AS city_share FROM documents JOIN
(SELECT source, count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY 1) USING (source)""")
def frequency_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("city"))
    return features.encode_frequency(docs, features.city_frequency(docs)).select("doc_id", "city_share")


EVENT_CODES = {"view": 0, "click": 1, "purchase": 2, "signup": 3}


@register("label_encode", """SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 END AS code,
  CASE WHEN event_type <> 'error' THEN event_type END AS decoded FROM events""")
def label_encode(spark, sf_dir):
    coded = table(spark, sf_dir, "events").select("event_id", features.encode_label("event_type", EVENT_CODES).alias("code"))
    return coded.withColumn("decoded", features.decode_label("code", EVENT_CODES))


STOP = ["the", "of", "and", "to", "in", "is", "de", "la", "le", "el"]
_TOKENS = f"""list_filter(regexp_extract_all(regexp_replace(line, '[^\\p{{L}}\\p{{N}}_{tx.SPACE_CLASS}]', '', 'g'), '[^{tx.SPACE_CLASS}]+'),
  lambda w: lower(w) NOT IN ({", ".join(f"'{w}'" for w in STOP)}))"""


@register("text_stats", f"""WITH {LINES_SQL}, t AS (SELECT doc_id, line_no, {_TOKENS} AS tokens FROM lines)
SELECT doc_id, line_no, length(array_to_string(tokens, ' ')) AS char_count, len(tokens) AS word_count,
  CASE WHEN len(tokens) > 0 THEN length(array_to_string(tokens, ' ')) / len(tokens) END AS avg_word_length FROM t""")
def text_stats(spark, sf_dir):
    out = features.text_stats(doc_lines(spark, sf_dir), "line", STOP)
    return out.select("doc_id", "line_no", "char_count", "word_count", "avg_word_length")


def judged(spark, sf_dir):
    """Labelled documents against a length rule."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars"))
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.col("quality").cast("string").alias("label"),
        F.when(F.col("n_chars") > 300, "1").when(F.col("n_chars") > 100, "0").otherwise("short").alias("prediction"))


JUDGED_SQL = """judged AS (SELECT CAST(quality AS VARCHAR) AS label,
  CASE WHEN n_chars > 300 THEN '1' WHEN n_chars > 100 THEN '0' ELSE 'short' END AS prediction FROM labels JOIN documents USING (doc_id)),
classes AS (SELECT label AS c FROM judged UNION SELECT prediction FROM judged),
matrix AS (SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM judged j WHERE j.label = a.c AND j.prediction = b.c) AS n FROM classes a, classes b)"""


@register("confusion_matrix", f"WITH {JUDGED_SQL} SELECT * FROM matrix")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(judged(spark, sf_dir))


def _wide_sql(source: str, classes: list[str]) -> str:
    cells = ", ".join(f"""count(*) FILTER (prediction = '{c}') AS "{c}" """ for c in classes)
    listed = ", ".join(f"'{c}'" for c in classes)
    zero = " UNION ALL ".join(f"SELECT '{c}', {', '.join(['0'] * (len(classes) + 1))}" for c in classes)
    sums = ", ".join(f'CAST(sum("{c}") AS BIGINT) AS "{c}"' for c in [*classes, "other"])
    return f"""SELECT label, {sums} FROM (SELECT label, {cells}, count(*) FILTER (prediction IS NULL OR prediction NOT IN ({listed})) AS other
  FROM {source} GROUP BY label UNION ALL {zero}) GROUP BY label"""


@register("confusion_matrix_wide", f"WITH {JUDGED_SQL} {_wide_sql('judged', ['0', '1', 'short'])}")
def confusion_matrix_wide(spark, sf_dir):
    return evaluate.confusion_wide(judged(spark, sf_dir), ["0", "1", "short"])


def half_judged(spark, sf_dir):
    """As ``judged``; the rule leaves documents of some sizes without a prediction, and labels
    of toxic documents are held back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.when(F.col("toxic") == 0, F.col("quality").cast("string")).alias("label"),
        F.when(F.col("n_chars") % 3 == 0, None).when(F.col("n_chars") > 300, "1").otherwise("0").alias("prediction"))


HALF_JUDGED_SQL = """judged AS (SELECT CASE WHEN toxic = 0 THEN CAST(quality AS VARCHAR) END AS label,
  CASE WHEN n_chars % 3 = 0 THEN NULL WHEN n_chars > 300 THEN '1' ELSE '0' END AS prediction FROM labels JOIN documents USING (doc_id)),
classes AS (SELECT label AS c FROM judged UNION SELECT prediction FROM judged)"""


@register("confusion_with_unscored", f"""WITH {HALF_JUDGED_SQL} SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM judged j
  WHERE j.label IS NOT DISTINCT FROM a.c AND j.prediction IS NOT DISTINCT FROM b.c) AS n FROM classes a, classes b""")
def confusion_with_unscored(spark, sf_dir):
    return evaluate.confusion(half_judged(spark, sf_dir))


@register("confusion_wide_with_unscored", f"WITH {HALF_JUDGED_SQL} {_wide_sql('judged', ['0', '1', 'never'])}")
def confusion_wide_with_unscored(spark, sf_dir):
    return evaluate.confusion_wide(half_judged(spark, sf_dir), ["0", "1", "never"])


@register("report_with_unscored", f"""WITH {HALF_JUDGED_SQL},
per AS (SELECT c AS "class", (SELECT count(*) FROM judged WHERE label = c AND prediction = c) AS hit,
  (SELECT count(*) FROM judged WHERE label = c) AS support, (SELECT count(*) FROM judged WHERE prediction = c AND label IS NOT NULL) AS predicted
  FROM classes WHERE c IS NOT NULL)
SELECT "class", round(CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END, 9) AS "precision",
  round(CASE WHEN support > 0 THEN hit / support ELSE 0 END, 9) AS recall, support FROM per
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM per""")
def report_with_unscored(spark, sf_dir):
    out = evaluate.report(evaluate.confusion(half_judged(spark, sf_dir))).where("class NOT LIKE '% avg'")
    return out.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall")], "support")


@register("accuracy_with_unscored", f"""WITH {HALF_JUDGED_SQL} SELECT avg(CAST(label IS NOT DISTINCT FROM prediction AS DOUBLE)) AS accuracy
FROM judged WHERE label IS NOT NULL""")
def accuracy_with_unscored(spark, sf_dir):
    return evaluate.accuracy(half_judged(spark, sf_dir))


@register("classification_report", f"""WITH {JUDGED_SQL},
per AS (SELECT c AS "class", (SELECT n FROM matrix WHERE label = c AND prediction = c) AS hit,
  (SELECT sum(n) FROM matrix WHERE label = c) AS support, (SELECT sum(n) FROM matrix WHERE prediction = c) AS predicted FROM classes),
m AS (SELECT "class", CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS r,
  CASE WHEN support + predicted > 0 THEN 2 * hit / (support + predicted) ELSE 0 END AS f, support, hit FROM per)
SELECT "class", round(p, 9) AS "precision", round(r, 9) AS recall, round(f, 9) AS f1, CAST(support AS BIGINT) AS support FROM m
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9), round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM m""")
def classification_report(spark, sf_dir):
    out = evaluate.report(evaluate.confusion(judged(spark, sf_dir)))
    return out.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("accuracy", f"WITH {JUDGED_SQL} SELECT avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM judged")
def accuracy(spark, sf_dir):
    return evaluate.accuracy(judged(spark, sf_dir))
