"""Registered queries that write and read back: streams, log tables, files. What comes back is compared."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.operators import audit, features
from zoneflow.plans.queries import ENTRY_AUDIT, master_and_entries
from zoneflow.plans.registry import register, table
from zoneflow.session import shared_path, written
from zoneflow.sources import logs, tables
from zoneflow.streaming import audit_stream

STREAM_FILES, FILES_PER_BATCH = 4, 2


@register("audit_stream", f"""WITH {ENTRY_AUDIT}
SELECT recid, city_name, edit_type, CASE WHEN edit_type = 'C' THEN 'row created' ELSE cols_updated END AS cols_updated,
  COALESCE(updated_from_nan, -1) AS updated_from_nan, COALESCE(updated_to_nan, -1) AS updated_to_nan, COALESCE(changed_vals, -1) AS changed_vals,
  out_of_range, warnings, editor, edit_timestamp, list_count(w) AS n_warned FROM log""")
def audit_stream_(spark, sf_dir):
    """Entries as they arrive in files, compared batch by batch, first with a master of fewer rows and then
    again with the whole one: only what the last run found is left in both logs."""
    master, entries = master_and_entries(spark, sf_dir)
    inbox, out = shared_path(spark, "inbox"), shared_path(spark, "stream-log")
    entries.repartition(STREAM_FILES, "recid").write.option("timestampFormat", logs.ROW_STAMP).json(inbox)
    for seen in (master.where("zn_code <> 'F'"), master):
        arriving = audit_stream.read_entries(spark, inbox, entries.schema, FILES_PER_BATCH, multi_line=False)
        run = audit_stream.audit_entries(arriving, lambda m=seen: m, out, shared_path(spark, "stream-state"))
        run.awaitTermination()
    updates, warned = (spark.read.parquet(f"{out}/{name}") for name in ("updates", "warnings"))

    def listed(c: str, by: str):
        return F.array_join(F.from_json(c, "array<string>"), by)

    created = F.col("edit_type__c_u_d__") == "C"
    found = warned.groupBy("recid").agg(F.count("*").alias("n"))
    return updates.join(found, "recid", "left").select(
        "recid", "city_name", F.col("edit_type__c_u_d__").alias("edit_type"),
        F.when(created, F.col("cols_updated")).otherwise(listed("cols_updated", ",")).alias("cols_updated"),
        "updated_from_nan", "updated_to_nan", "changed_vals", "out_of_range", listed("warnings", "; ").alias("warnings"),
        "editor", "edit_timestamp", F.coalesce("n", F.lit(0)).alias("n_warned"))


CUTOFF = datetime(1997, 1, 1)
#: Orders as they were, and as they are: the pending ones gone, the open ones dearer and later, new ones from customers
#: in debt. Every date has microseconds.
LEDGER_SQL = """older AS (SELECT CAST(o_orderkey AS VARCHAR) AS recid, o_orderstatus AS status, o_totalprice AS price,
  CAST(o_orderdate AS TIMESTAMP) + to_microseconds(o_orderkey % 1000000) AS edit_date FROM orders),
newer AS (
  SELECT recid, status, CASE WHEN status = 'O' THEN price * 1.5 ELSE price END AS price,
    CASE WHEN status = 'O' THEN edit_date + INTERVAL 40 DAY ELSE edit_date END AS edit_date FROM older WHERE status <> 'P'
  UNION ALL SELECT 'c' || c_custkey, 'O', c_acctbal, TIMESTAMP '1996-12-31 23:59:59.9' + to_microseconds(c_custkey * 1000) FROM customer WHERE c_acctbal < 0)"""


def ledgers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    micros = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 1_000_000)
    older = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("recid"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"), micros.alias("edit_date"))
    open_ = F.col("status") == "O"
    edited = older.where("status <> 'P'").select(
        "recid", "status", F.when(open_, F.col("price") * 1.5).otherwise(F.col("price")).alias("price"),
        F.when(open_, F.col("edit_date") + F.expr("INTERVAL 40 DAY")).otherwise(F.col("edit_date")).alias("edit_date"))
    added = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.concat(F.lit("c"), "c_custkey").alias("recid"), F.lit("O").alias("status"), F.col("c_acctbal").alias("price"),
        F.timestamp_micros(F.unix_micros(F.lit("1996-12-31 23:59:59.9").cast("timestamp")) + F.col("c_custkey") * 1000).alias("edit_date"))
    return older, edited.unionByName(added)


@register("rollback_from_log", f"""WITH {LEDGER_SQL}, cut AS (SELECT TIMESTAMP '1997-01-01' AS cutoff),
rolled AS (
  SELECT o.* FROM older o LEFT JOIN newer n USING (recid), cut
  WHERE (n.recid IS NULL AND o.edit_date >= cutoff) OR n.edit_date >= cutoff OR (o.price = n.price AND o.edit_date = n.edit_date)
  UNION ALL
  SELECT n.* FROM newer n LEFT JOIN older o USING (recid), cut
  WHERE n.edit_date < cutoff AND (o.recid IS NULL OR o.price <> n.price OR o.edit_date <> n.edit_date))
SELECT recid, status, price, epoch_us(edit_date) AS edit_micros FROM rolled""")
def rollback_from_log(spark, sf_dir):
    """The master as of a date, from its older state and the stored log table: edits are found by comparing
    two states, stored as JSON rows, read back and those before the date applied."""
    older, newer = ledgers(spark, sf_dir)
    edits = audit.updates(older, newer, mode="masters", city=None, editor=None, bounds={}).update_log
    name = "zoneflow_edit_log"
    logs.create_log_table(spark, name, logs.UPDATE_LOG, shared_path(spark, "edit-log"))
    stored = logs.stored_updates(edits)
    for part in ("edit_type__c_u_d__ <> 'D'", "edit_type__c_u_d__ = 'D'"):
        logs.append_log(stored.where(part), name)
    log = logs.typed_updates(spark.table(name), older.schema)
    back = audit.table_as_of(older, log, F.lit(CUTOFF))
    return back.select("recid", "status", "price", F.unix_micros("edit_date").alias("edit_micros"))


@register("sorted_logs", f"""WITH {ENTRY_AUDIT} SELECT 'updates' AS log, count(*) AS n, true AS in_order FROM log
UNION ALL SELECT 'warnings', CAST(sum(len(w)) AS BIGINT), true FROM log""")
def sorted_logs(spark, sf_dir):
    """Both logs sorted by city and key. Their order is checked: within parts each row against the one before
    it, and from part to part by their ends."""
    found = audit.updates(*master_and_entries(spark, sf_dir))
    # Dealing by range reads its rows twice, so the log is made once and both kinds are taken from it.
    rows = written(found.update_log.select("recid", "city_name", "editor", "edit_timestamp", "warnings"), "log")
    found = audit.AuditLogs(rows, audit.warnings_of(rows, "recid"))
    kinds = {"updates": (found.update_log, ["city_name", "recid"]), "warnings": (found.warning_log, ["editor", "city", "recid"])}
    return _ordered("updates", *kinds["updates"]).unionByName(_ordered("warnings", *kinds["warnings"]))


def _ordered(name: str, log: DataFrame, by: list[str]) -> DataFrame:
    rows = logs.sorted_log(log.select(*by), by).select(
        F.struct(*by).alias("at"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("no"))
    within = rows.withColumn("last", F.lag("at").over(Window.partitionBy("part").orderBy("no")))
    parts = within.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"),
                                       F.bool_and(F.coalesce(F.col("last") <= F.col("at"), F.lit(True))).alias("rising"))
    # a row a part
    parts = parts.withColumn("before", F.lag("high").over(Window.orderBy("part")))
    follows = F.coalesce(F.col("before") <= F.col("low"), F.lit(True))
    return parts.agg(F.lit(name).alias("log"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.bool_and(F.col("rising") & follows).alias("in_order"))


def _texts(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "source", F.md5("text").alias("text_md5"), F.octet_length("text").cast("long").alias("n_bytes"))


def awkward(spark, sf_dir) -> DataFrame:
    """Documents, some in quotes and with line feeds, quoted commas and hard spaces at both ends."""
    text = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(' "a, ""b""\n '), "text", F.lit('\n"'))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", text.alias("text"))


AWKWARD_SQL = """SELECT doc_id, source, md5(t) AS text_md5, strlen(t) AS n_bytes FROM (
  SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN ' "a, ""b""' || chr(10) || chr(160) || text || chr(10) || '"' ELSE text END AS t FROM documents)"""


@register("csv_round_trip", AWKWARD_SQL)
def csv_round_trip(spark, sf_dir):
    """Whole texts written as CSV and read back."""
    path = shared_path(spark, "csv")
    tables.write_csv(awkward(spark, sf_dir), path)
    return _texts(tables.read_csv(spark, path, awkward(spark, sf_dir).schema))


@register("csv_with_saved_index", AWKWARD_SQL)
def csv_with_saved_index(spark, sf_dir):
    """CSV whose first column is a row number without a name."""
    path = shared_path(spark, "csv")
    rows = awkward(spark, sf_dir)
    tables.write_csv(rows.select(F.monotonically_increasing_id().alias(" "), "*"), path)
    return _texts(tables.read_csv(spark, path, rows.schema, saved_index=True))


@register("ndjson_round_trip", AWKWARD_SQL)
def ndjson_round_trip(spark, sf_dir):
    path = shared_path(spark, "ndjson")
    rows = awkward(spark, sf_dir)
    tables.write_ndjson(rows, path)
    return _texts(tables.read_table(spark, path, rows.schema, "json"))


@register("json_batches", AWKWARD_SQL)
def json_batches(spark, sf_dir):
    """Entries as JSON arrays, one of at most a hundred a file, read as batches are."""
    path = shared_path(spark, "json")
    rows = awkward(spark, sf_dir)
    batch = F.to_json(F.collect_list(F.struct(*rows.columns)))
    rows.groupBy(F.expr("doc_id div 100").alias("no")).agg(batch.alias("value")).repartition("no").select(
        F.concat("value", F.lit("\n")).alias("value"), (F.col("no") % 50).alias("no")).write.partitionBy("no").option("maxRecordsPerFile", 1).text(path)
    return _texts(tables.read_json_batch(spark, path, rows.schema))


@register("frequency_file", """WITH f AS (SELECT source, count(*) AS n FROM documents WHERE doc_id % 2 = 0 GROUP BY 1)
SELECT doc_id, n / (SELECT sum(n) FROM f) AS city_share FROM documents LEFT JOIN f USING (source)""")
def frequency_file(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("city"))
    path = shared_path(spark, "frequencies")
    logs.write_frequencies(features.city_frequency(docs.where("doc_id % 2 = 0")), path)
    return features.encode_frequency(docs, logs.read_frequencies(spark, path)).select("doc_id", "city_share")


@register("table_metadata", """SELECT CAST(ordinal_position AS INTEGER) - 1 AS position, column_name AS "column",
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE lower(data_type) END AS type
FROM information_schema.columns WHERE table_name = 'documents'""")
def table_metadata(spark, sf_dir):
    return tables.columns_of(table(spark, sf_dir, "documents")).select("position", "column", "type")


@register("filtered_row_count", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def filtered_row_count(spark, sf_dir):
    n = tables.row_count(table(spark, sf_dir, "orders"), "o_orderstatus = 'F' AND o_totalprice > 1000")
    return spark.createDataFrame([(n,)], "n long")


@register("warehouse_query", """SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def warehouse_query(spark, sf_dir):
    return tables.query(spark, """SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM {o} JOIN {c} ON c_custkey = o_custkey GROUP BY 1""", o=table(spark, sf_dir, "orders"), c=table(spark, sf_dir, "customer"))
