"""Rows that several passes read are made once."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import audit
from zoneflow.plans import log_queries, model_queries
from zoneflow.streaming import audit_stream


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Tables of one file each."""
    root = str(tmp_path_factory.mktemp("tables"))
    n = spark.range(600)
    day = F.lit("1997-01-01").cast("timestamp")
    made = {
        "orders": n.select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
                           (F.col("id") * 10.5).alias("o_totalprice"), day.alias("o_orderdate"), F.element_at(F.array(F.lit("1-URGENT"), F.lit("5-LOW")), (F.col("id") % 2 + 1).cast("int")).alias("o_orderpriority")),
        "lineitem": n.select(F.col("id").alias("l_orderkey"), F.lit(2.0).alias("l_quantity"), F.lit(3.0).alias("l_extendedprice")),
        "customer": n.select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"), (F.col("id") - 20.0).alias("c_acctbal")),
        "part": n.select(F.col("id").alias("p_partkey"), F.concat(F.lit("brand"), F.col("id") % 4).alias("p_brand"), (F.col("id") % 50).cast("int").alias("p_size"), (F.col("id") * 1.5).alias("p_retailprice"),
                         F.lit("thing").alias("p_name"), F.when(F.col("id") % 3 == 0, "SMALL").otherwise("LARGE").alias("p_type")),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def read(df) -> set[str]:
    """Kinds of written tables (or folders) that the frame reads."""
    return {path.split("/")[-2].split("-")[0] for path in df.inputFiles()}


def test_both_logs_are_taken_from_one(spark, tables):
    found = log_queries.sorted_logs(spark, tables)
    assert read(found) == {"log"}
    rows = {r["log"]: (r["n"], r["in_order"]) for r in found.collect()}
    whole = audit.updates(*log_queries.master_and_entries(spark, tables))
    assert rows == {"updates": (620, True), "warnings": (whole.warning_log.count(), True)}


def test_a_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    schema = "recid string, city_name string, max_dua double, editor string, edit_date timestamp"
    master = spark.createDataFrame([(f"k{i}", "c", float(i), "ed", datetime(2020, 1, 1)) for i in range(30)], schema)
    inbox, seen, plain = str(tmp_path / "inbox"), [], audit.updates
    master.withColumn("max_dua", F.col("max_dua") + 1).coalesce(1).write.json(inbox)
    monkeypatch.setattr(audit, "updates", lambda m, batch, **kw: seen.append(read(batch)) or plain(m, batch, **kw))
    arriving = audit_stream.read_entries(spark, inbox, master.schema, multi_line=False)
    audit_stream.audit_entries(arriving, lambda: master, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert seen == [{"batch"}]
    assert spark.read.parquet(str(tmp_path / "out/updates")).where("changed_vals = 1").count() == 30


def test_land_rows_are_written_once_and_dealt(spark, tables):
    rows = model_queries.land_rows(spark, tables)
    assert read(rows) == {"land"}
    assert rows.count() == 600 and len(rows.inputFiles()) > 1
    even, rest = model_queries.balanced_land(spark, tables)
    assert read(even) == read(rest) == {"filled"}
