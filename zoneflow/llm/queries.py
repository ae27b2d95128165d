"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, decontaminate, divergence, exact_dedup, language_id, line_dedup, lm_scoring, merkle, mixing,
               simhash, substring_dedup, token_counts, token_files)
from .common import new_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated spans of at least 120 bytes: place, chunks, bytes that go."""
    spans = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start", "stop", "n_chunks", "n_bytes_dropped")


@register
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closeness of each document to those labelled good and not toxic."""
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


@register
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best overlap of each document with each benchmark item that it holds a passage of."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.language_id(docs, docs.where(~language_id.held_out()))


@register
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op6_exact_dedup"] = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
"""


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@register
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op8_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM split),
keyed AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
hot AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE hot.k IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN hot USING (k) GROUP BY doc_id
"""


@register
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_dir(spark, "tokens")
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), folder)


@register
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of documents by language, against documents of which some have another n_chars."""
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    audited = merkle.audited(table(spark, sf_dir, "documents"), touched)
    return audited.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLES["op11_merkle"] = r"""
WITH RECURSIVE docs AS (
  SELECT *, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
      lambda crc, d: list_reduce(list_concat([xor(crc, d)], list_transform(range(8), lambda i: 0::BIGINT)),
                                 lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 7 = 0 AS touched
  FROM documents),
hashed AS (
  SELECT lang, doc_id, sha256(a || n || z) AS leaf, sha256(a || CASE WHEN touched THEN m ELSE n END || z) AS now
  FROM (SELECT lang, doc_id, touched,
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') AS a,
               coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
               coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS m,
               coalesce(strlen(text) || ':' || text, '-') AS z FROM docs)),
leaves AS (
  SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
low(lang, level, pos, node) AS (
  SELECT lang, 0, pos, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM low) WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (
  SELECT lang, arg_max(node, level) AS node, max(level) AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM low GROUP BY lang),
top(level, pos, node) AS (
  SELECT 0, pos, node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level, pos // 2),
head AS (SELECT arg_max(node, level) AS root, max(level) AS height FROM top),
ways AS (
  SELECT k, leaves.lang, 0 AS part, unnest(range(s.height)) AS level, leaves.pos, 0 AS below
  FROM leaves JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang
  UNION ALL
  SELECT k, NULL, 1, unnest(range((SELECT height FROM head))), s.pos, s.height
  FROM leaves JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang),
nodes AS (SELECT 0 AS part, lang, level, pos, node FROM low UNION ALL SELECT 1, NULL, level, pos, node FROM top),
steps AS (
  SELECT k, below + w.level AS step, (w.pos >> w.level) % 2 = 1 AS right_one, coalesce(node, '') AS sibling
  FROM ways w LEFT JOIN nodes n ON n.part = w.part AND n.lang IS NOT DISTINCT FROM w.lang AND n.level = w.level AND n.pos = xor(w.pos >> w.level, 1)),
proofs AS (SELECT k, sha256(string_agg(sibling, '' ORDER BY step)) AS proof, count(*) AS n FROM steps GROUP BY k),
fold(k, step, x) AS (
  SELECT k, 0, now FROM leaves
  UNION ALL
  SELECT k, step + 1, sha256(CASE WHEN right_one THEN sibling || x ELSE x || sibling END) FROM fold JOIN steps USING (k, step)),
folded AS (SELECT k, arg_max(x, step) AS x FROM fold GROUP BY k)
SELECT doc_id, leaf, s.node AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, x AS folded_root, x = root AS verified
FROM leaves JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang JOIN folded USING (k) CROSS JOIN head LEFT JOIN proofs USING (k)
"""


@register
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
vs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
ps AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (coalesce(total, 0) + v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v)::HUGEINT AS q
  FROM groups JOIN kept USING (lang) JOIN vs USING (lang) LEFT JOIN counts USING (lang, source, term) LEFT JOIN totals USING (lang, source)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM ps a JOIN ps b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM ps WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@register
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
