"""Raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes
every result as Parquet to the shared folder and reads it back. All stages but the last return the
columns of documents.

1. ``language_id``       documents in which no language is found (no text, no letter) go; where no
                         language could be learned, all with a letter stay.
2. ``near_dedup``        of rows whose fingerprints connect, the one with the smallest id stays.
3. ``decontaminate``     documents that hold a passage of a benchmark item go.
4. ``mix``               each document is given once, twice or not at all: whole for each scheduled
                         slot of its source that its first token lies in.
5. ``token_files``       the texts as token files, and what is read back from them.

Near duplicates follow the simhash rules of ``zoneflow.llm.simhash`` and are decided by row: of a group
the row with the least (id, hash of the text) stays, null ids last. So rows go only for a near copy,
never for an id, null or not, that they share with an unlike text. Of rows equal in id and text the
least by all columns stays (maps by their JSON). Ids are integers, or null. Columns beside those of documents go
along, whatever their names; an empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import decontaminate, language_id, mixing, simhash, token_files
from zoneflow.llm.common import in_order, new_dir, settle

TOKENIZER = "byte_bpe_50k.json"


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned = language_id.learn(docs.where(~language_id.held_out()))
    if not learned:
        return docs.where(language_id.lettered(spark)("text"))
    found = language_id.predictor(spark, learned)
    named = found("text").getField("lang_pred") != "und"
    # a learned language may bear that name
    return docs.where(named | language_id.lettered(spark)("text") if "und" in learned else named)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = settle(simhash.fingerprints(docs, text_hash=F.xxhash64("text")), "fingerprints")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = settle(rows.groupBy("fp").agg(F.min(least).alias("head")), "classes")
    kept = simhash.roots(classes).groupBy("root").agg(F.min("head").alias("head"))
    kept = kept.select(F.struct("head.doc_id", "head.text_hash").alias("key"))
    given = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")).alias("key"),
                        F.struct(*docs.columns).alias("row"))
    # nulls within equal structs are equal; merged at every size, so that disk use grows in proportion
    left = given.join(kept.hint("merge"), "key", "left_semi")
    first = F.min_by("row", in_order(docs, "row")) if "map<" in docs.schema.simpleString() else F.min("row")
    return left.groupBy("key").agg(first.alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.copies(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_files(docs, public_tokenizers.path(TOKENIZER), new_dir(spark, "tokens"))


STAGES = [
    ("language_id", find_language),
    ("near_dedup", near_dedup),
    ("decontaminate", drop_contaminated),
    ("mix", mix),
    ("token_files", write_tokens),
]

#: The stages hold statistics, a trie join and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
