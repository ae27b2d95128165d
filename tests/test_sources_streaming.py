import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators import audit
from zoneflow.sources import logs, tables
from zoneflow.streaming import audit_stream

SCHEMA = "recid string, city_name string, max_dua double, editor string, edit_date timestamp"


def test_declared_schema_and_cast(spark):
    schema = tables.declared_schema({"a": "number", "d": "calendar_date", "t": "text", "gone": "number"})
    df = spark.createDataFrame([("x", "1.5", "2020-01-02T03:04:05.000"), ("y", "bad", "never"), ("z", "NaN", None)], "t string, a string, d string")
    got = tables.cast_declared(df, schema)
    assert got.columns == ["a", "d", "t", "gone"]
    assert [(r.a, r.d, r.gone) for r in got.collect()] == [(1.5, datetime(2020, 1, 2, 3, 4, 5), None), (None, None, None), (None, None, None)]
    assert isinstance(tables.declared_schema({"d": "calendar_date"}, cast_dates=False)["d"].dataType, T.StringType)


def test_scan_and_counts(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("odd"))
    assert [r.id for r in tables.scan(df, ["id"], "odd = 1", ["id"], 2).collect()] == [1, 3]
    assert tables.scan(df, where="odd = 5").count() == 0 and tables.scan(df, where="odd = 5").columns == df.columns
    assert tables.row_count(df, "odd = 1") == 5
    assert tables.query(spark, "SELECT sum(id) AS s FROM {t}", t=df).first().s == 45


def test_columns_are_listed(spark):
    df = spark.createDataFrame([], "a string, n int")
    assert [tuple(r) for r in tables.columns_of(df).collect()] == [(0, "a", "string", True), (1, "n", "int", True)]


def test_csv_round_trip_with_awkward_text(spark, tmp_path):
    schema = T.StructType.fromDDL("a string, n int")
    df = spark.createDataFrame([('he said "no", twice', 1), ("two\nlines", 2), ("", 3)], schema)
    tables.write_csv(df, str(tmp_path / "c"))
    back = tables.read_csv(spark, str(tmp_path / "c"), schema)
    assert {r.n: r.a or "" for r in back.collect()} == {r.n: r.a for r in df.collect()}
    (tmp_path / "saved.csv").write_text(",a,n\n0,x,1\n1,y,2\n")
    saved = tables.read_csv(spark, str(tmp_path / "saved.csv"), schema, saved_index=True)
    assert [(r.a, r.n) for r in saved.collect()] == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        tables.read_table(spark, "x", fmt="csv")


def test_json_and_parquet(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps([{"recid": "a", "n": 1}, {"recid": "b"}]))
    schema = T.StructType.fromDDL("recid string, n int")
    df = tables.read_json_batch(spark, str(tmp_path / "b.json"), schema)
    assert sorted((r.recid, r.n) for r in df.collect()) == [("a", 1), ("b", None)]
    tables.write_ndjson(df, str(tmp_path / "nd"))
    assert spark.read.schema(schema).json(str(tmp_path / "nd")).count() == 2
    df.write.parquet(str(tmp_path / "p"))
    assert tables.read_table(spark, str(tmp_path / "p")).count() == 2


def test_logs_before(spark, tmp_path):
    header = ",".join(c.split()[0] for c in logs.UPDATE_LOG.split(", "))
    for name, key in (("19-10-25_14-00", "a"), ("19-11-14_09-30", "b"), ("19-12-30_10-15", "at"), ("20-01-01_00-00", "late"), ("soon", "odd")):
        (tmp_path / f"update-log_{name}.csv").write_text(f"{header}\n{key}" + "," * 13 + "\n")
        (tmp_path / f"warnings_{name}.csv").write_text(f"city,editor,edit_timestamp,recid,warning\nc,e,t,{key},w\n")
    updates, warned = logs.logs_before(spark, str(tmp_path), datetime(2019, 12, 30, 10, 15))
    assert {r.recid for r in updates.collect()} == {r.recid for r in warned.collect()} == {"a", "b"}
    assert logs.log_name("update-log", datetime(2019, 10, 25, 14, 0)) == "update-log_19-10-25_14-00.csv"


def test_log_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS editlogs LOCATION '{tmp_path}/db'")
    logs.create_log_table(spark, "editlogs.warnings", logs.WARNING_LOG)
    row = spark.createDataFrame([("c", "e", "t", "a", "w")], logs.WARNING_LOG)
    logs.append_log(row, "editlogs.warnings")
    logs.append_log(row, "editlogs.warnings")
    assert spark.table("editlogs.warnings").count() == 2
    logs.create_log_table(spark, "editlogs.warnings", logs.WARNING_LOG)
    assert spark.table("editlogs.warnings").count() == 0
    logs.write_frequencies(spark.createDataFrame([("c", 2)], "city string, n int"), str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).first().n == 2


def test_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    day = datetime(2020, 1, 1)
    master = spark.createDataFrame([(f"k{i}", "c", float(i), "e", day) for i in range(1, 22)], SCHEMA).persist()
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    entries = [[{"recid": "k2", "city_name": "c", "max_dua": 30.0, "editor": "e", "edit_date": "2020-02-01T00:00:00"}],
               [{"recid": "n1", "city_name": "new", "max_dua": 3.0, "editor": "e", "edit_date": "2020-02-01T00:00:00"}]]
    for i, batch in enumerate(entries):
        (inbox / f"{i}.json").write_text(json.dumps(batch))
    schema = T.StructType.fromDDL(SCHEMA)

    def run(checkpoint):
        feed = audit_stream.read_entries(spark, str(inbox), schema, files_per_batch=1)
        q = audit_stream.audit_entries(feed, lambda: master, out, str(tmp_path / checkpoint))
        assert q.awaitTermination(120)

    run("cp1")
    stored = spark.read.parquet(f"{out}/updates")
    every = spark.read.schema(schema).option("multiLine", True).json(str(inbox))
    want = logs.stored_updates(audit.updates(master, every).update_log)
    assert sorted(map(str, stored.drop("batch_id").collect())) == sorted(map(str, want.collect()))
    assert stored.select("batch_id").distinct().count() == 2
    run("cp2")  # the same batches once more
    assert spark.read.parquet(f"{out}/updates").count() == 2
    assert {r.warning for r in spark.read.parquet(f"{out}/warnings").collect()} == {
        "max_dua value is out of range (val = 30.0)", '"new" not in other row records for city_name'}
    # a newer master that holds those values: the same batches leave no warning of the earlier runs
    newer = spark.createDataFrame([("k2", "new", 50.0, "e", day)], SCHEMA).unionByName(master.where("recid <> 'k2'"))
    feed = audit_stream.read_entries(spark, str(inbox), schema, files_per_batch=1)
    audit_stream.audit_entries(feed, lambda: newer, out, str(tmp_path / "cp3"), bounds={"max_dua": (0.0, 99.0)}).awaitTermination(120)
    assert spark.read.parquet(f"{out}/warnings").count() == 0 and spark.read.parquet(f"{out}/updates").count() == 2


def test_sorted_log(spark):
    df = spark.createDataFrame([(f"c{i * 7 % 10}", i * 13 % 500) for i in range(500)], "city string, recid int")
    got = [tuple(r) for r in logs.sorted_log(df, ["city", "recid"]).collect()]
    assert got == sorted(got)
