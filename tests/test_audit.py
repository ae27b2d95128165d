from datetime import datetime

import pytest
from pyspark.sql import functions as F

from zoneflow.functions import stats
from zoneflow.operators import audit
from zoneflow.sources import logs

SCHEMA = ("recid string, city_name string, zn_code string, max_dua double, max_far double, "
          "editor string, edit_date timestamp")
DAY = datetime(2020, 1, 1)
LATER = datetime(2020, 2, 1)
EARLIER = datetime(2019, 1, 1)


@pytest.fixture(scope="module")
def master(spark):
    # max_dua holds 1.0 ... 21.0: 5th and 95th percentile are 2.0 and 20.0. max_far is all null.
    rows = [(f"k{i:02d}", f"city{i % 2}", f"Z{i}", float(i), None, "ed", DAY) for i in range(1, 22)]
    rows[4] = ("k05", "city1", None, 5.0, None, "ed", DAY)
    rows.append(("k22", "city0", "x" * 60 + "a", None, None, "ed", DAY))
    return spark.createDataFrame(rows, SCHEMA)


def entry(key, dua, zn="Z1", far=None, date=LATER, city="city0", editor="ed"):
    return (key, city, zn, dua, far, editor, date)


def log_of(spark, master, rows, **kw):
    out = audit.updates(master, spark.createDataFrame(rows, SCHEMA), **kw)
    return {r.recid: r for r in out.update_log.collect()}, out


def test_entries_golden(spark, master):
    nan = float("nan")
    log, out = log_of(spark, master, [
        entry("k02", 20.0, "Z2"),                       # on the bound
        entry("k04", 20.5, "Z4"),                       # above
        entry("k06", 1.5, "Q9"),                        # below, new text
        entry("k08", None, "Z8"),                       # value to null
        entry("k22", 7.0, "x" * 60 + "b"),              # null to value, long text differs at its end
        entry("k05", 5.0, "N1", city="city1"),          # text had no old value: not novel
        entry("k10", 10.0, "Z10", date=DAY),            # sent again unchanged
        entry("k12", nan, "Z12", date=EARLIER),         # NaN is missing; older than the master
        entry("n01", 99.0, "NEW", city="city9"),        # created
        entry("n02", 3.0),                              # created, nothing odd
    ])
    assert {k: r.edit_type for k, r in log.items()} == {k: "C" if k[0] == "n" else "U" for k in log}
    assert len(log) == 10
    assert log["k02"].cols_updated == ["max_dua", "edit_date"] and log["k02"].warnings == []
    assert log["k04"].warnings == ["max_dua value is out of range (val = 20.5)"] and log["k04"].out_of_range == 1
    assert log["k06"].warnings == ["max_dua value is out of range (val = 1.5)",
                                   '"Q9" not in other row records for zn_code']
    assert (log["k08"].updated_from_nan, log["k08"].updated_to_nan, log["k08"].changed_vals) == (-1, 1, 3)
    assert (log["k22"].updated_from_nan, log["k22"].changed_vals) == (1, 2)
    assert "zn_code" in log["k22"].cols_updated and len(log["k22"].warnings) == 1
    assert log["k05"].warnings == []
    assert log["k10"].cols_updated == [] and log["k10"].changed_vals == 0
    assert log["k12"].new_row.max_dua is None and log["k12"].stale_edit is True
    assert log["n01"].warnings == ["max_dua value is out of range (val = 99.0)",
                                   '"city9" not in other row records for city_name',
                                   '"NEW" not in other row records for zn_code']
    assert (log["n01"].changed_vals, log["n01"].updated_from_nan, log["n01"].old_row) == (None, None, None)
    assert log["n02"].warnings == []
    warned = [(r.recid, r.warning) for r in out.warning_log.collect()]
    assert sorted(warned) == sorted((k, w) for k, r in log.items() for w in r.warnings)


def test_text_without_old_value_is_not_novel(spark, master):
    log, _ = log_of(spark, master, [entry("k05", 5.0, "N1", city="city1")])
    assert log["k05"].cols_updated == ["zn_code", "edit_date"] and log["k05"].warnings == []


def test_masters_mode(spark, master):
    same, _ = log_of(spark, master, [tuple(r) for r in master.collect()], mode="masters")
    assert same == {}
    rows = [tuple(r) for r in master.where("recid not in ('k01', 'k03')").collect()] + [entry("n01", 3.0)]
    log, _ = log_of(spark, master, rows, mode="masters")
    assert {k: r.edit_type for k, r in log.items()} == {"k01": "D", "k03": "D", "n01": "C"}
    # A deleted row is tested on every number it held; its texts are in the master.
    assert log["k01"].warnings == ["max_dua value is out of range (val = 1.0)"]
    assert log["k03"].warnings == [] and log["k03"].new_row is None and log["k03"].edit_timestamp == DAY


@pytest.mark.parametrize("mode", ["entries", "masters"])
def test_repeated_keys_fail(spark, master, mode):
    with pytest.raises(Exception, match="repeated key"):
        log_of(spark, master, [entry("k02", 1.0), entry("k02", 2.0)], mode=mode)
    doubled = master.union(master.where("recid = 'k02'"))
    with pytest.raises(Exception, match="repeated key"):
        log_of(spark, doubled, [entry("k02", 1.0)], mode=mode)


def test_large_batches_take_the_shuffled_path(spark, master, monkeypatch):
    rows = [entry(f"k{i:02d}", float(i), "Z1") for i in range(1, 10)]
    small, _ = log_of(spark, master, rows)
    monkeypatch.setattr(audit, "is_small", lambda df: False)
    large, _ = log_of(spark, master, rows)
    assert small == large


def test_keys_and_digests_are_compared_before_rows(spark, master):
    rows = spark.createDataFrame([entry("k02", 9.0)], SCHEMA).unionByName(master.where("recid <> 'k02'"))
    before = set(spark.sparkContext._jsc.sc().getPersistentRDDs().keySet().toString())
    found = audit.edits(master, rows, "recid", "masters")
    assert [tuple(r) for r in found.collect()] == [("k02", "U")]
    assert "Window" not in audit.pair_rows(master, rows, "recid", "masters")._jdf.queryExecution().toString()
    log = audit.updates(master, rows, mode="masters").update_log.collect()
    assert [r.recid for r in log] == ["k02"]
    assert set(spark.sparkContext._jsc.sc().getPersistentRDDs().keySet().toString()) == before


def test_digests_tell_nulls_apart(spark):
    rows = spark.createDataFrame([(None, "a", 0.0), ("a", None, -0.0), ("", "a", 0.0), ("a", "", 0.0), ("a", "", None)], "x string, y string, z double")
    got = rows.select(*audit._digests(rows.columns)).collect()
    assert len({tuple(r) for r in got}) == 5
    signed = spark.createDataFrame([(0.0,), (-0.0,)], "z double")
    assert len({tuple(r) for r in signed.select(*audit._digests(["z"])).collect()}) == 1


def test_a_null_key_is_a_key(spark, master):
    held = master.unionByName(spark.createDataFrame([entry(None, 3.0)], SCHEMA))
    log, _ = log_of(spark, held, [entry(None, 4.0), entry("n", 5.0)])
    assert {k: r.edit_type for k, r in log.items()} == {None: "U", "n": "C"} and log[None].cols_updated == ["max_dua"]
    with pytest.raises(Exception, match="repeated key: null"):
        log_of(spark, held, [entry(None, 4.0), entry(None, 5.0)])


def test_without_number_or_text_columns(spark):
    old = spark.createDataFrame([(1, DAY), (2, DAY)], "recid int, edit_date timestamp")
    new = spark.createDataFrame([(1, LATER), (2, DAY), (3, DAY)], "recid int, edit_date timestamp")
    log = {r.recid: r for r in audit.updates(old, new, mode="masters").update_log.collect()}
    assert {k: (r.edit_type, r.cols_updated, r.warnings) for k, r in log.items()} == {1: ("U", ["edit_date"], []), 3: ("C", [], [])}
    assert stats.exact_percentiles(old, [], [0.5]) == {}


def test_ranges_of_null_column(spark, master):
    found = audit.normal_ranges(master, ["max_dua", "max_far"])
    assert found == {"max_dua": (2.0, 20.0), "max_far": None}


def test_stored_log_and_table_as_of(spark, master, tmp_path):
    rows = [tuple(r) for r in master.where("recid <> 'k01'").collect() if r.recid != "k02"]
    rows += [entry("k02", 9.0, "Z2"), entry("n01", 3.0)]
    out = audit.updates(master, spark.createDataFrame(rows, SCHEMA), mode="masters")
    stored = logs.stored_updates(out.update_log)
    assert stored.schema.simpleString() == spark.createDataFrame([], logs.UPDATE_LOG).schema.simpleString()
    kinds = {r.recid: r for r in stored.collect()}
    assert kinds["k01"].cols_updated == "row deleted" and kinds["k01"].changed_vals == -1
    assert kinds["n01"].cols_updated == "row created" and kinds["n01"].old_vals is None
    assert kinds["k02"].cols_updated == '["max_dua","edit_date"]'
    stored.write.parquet(str(tmp_path / "log"))
    log = logs.typed_updates(spark.read.parquet(str(tmp_path / "log")), master.schema)
    after = {r.recid: r.max_dua for r in audit.table_as_of(master, log, F.lit(datetime(2021, 1, 1))).collect()}
    assert "k01" not in after and after["k02"] == 9.0 and after["n01"] == 3.0 and len(after) == 22
    # Strictly before: edits at the cut-off itself do not count; k01's deletion is dated by its old row.
    at = {r.recid: r.max_dua for r in audit.table_as_of(master, log, F.lit(LATER)).collect()}
    assert at["k02"] == 2.0 and "n01" not in at


def test_stored_rows_keep_microseconds(spark, master):
    when = datetime(2020, 2, 1, 1, 2, 3, 123456)
    out = audit.updates(master, spark.createDataFrame([entry("k02", 0.1 + 0.2, date=when)], SCHEMA))
    log = logs.typed_updates(logs.stored_updates(out.update_log), master.schema)
    row = log.first()
    assert (row.edit_timestamp, row.new_row.edit_date, row.new_row.max_dua) == (when, when, 0.1 + 0.2)
    older = spark.createDataFrame([('{"edit_date":"2020-02-01T01:02:03.123Z"}',), ('{"edit_date":"2020-02-01T01:02:03"}',)], "v string")
    got = older.select(F.from_json("v", "edit_date timestamp", {"timestampFormat": logs.READ_STAMP}).alias("r")).collect()
    assert [r.r.edit_date for r in got] == [datetime(2020, 2, 1, 1, 2, 3, 123000), datetime(2020, 2, 1, 1, 2, 3)]


def test_last_edit_counts(spark):
    master = spark.createDataFrame([("a", 1), ("b", 1)], "recid string, v int")
    log = spark.createDataFrame(
        [("a", "U", datetime(2020, 1, 1), ("a", 2)), ("a", "D", datetime(2020, 1, 2), None), ("a", "C", datetime(2020, 1, 3), ("a", 5))],
        "recid string, edit_type string, edit_timestamp timestamp, new_row struct<recid: string, v: int>")
    def at(day):
        return {r.recid: r.v for r in audit.table_as_of(master, log, F.lit(datetime(2020, 1, day))).collect()}
    assert [at(d) for d in (1, 2, 3, 4)] == [{"a": 1, "b": 1}, {"a": 2, "b": 1}, {"b": 1}, {"a": 5, "b": 1}]


def test_parcels_keys_and_changed_rows(spark):
    log = spark.createDataFrame([("a",), ("b",), ("c",)], "recid string")
    parcels = spark.createDataFrame([("a", "g1"), ("a", None), ("b", None), ("z", "g")], "recid string, geom_id string")
    got = {r.recid: r.num_parcels_affected for r in audit.parcels_affected(log, parcels).collect()}
    assert got == {"a": 1, "b": 0, "c": None}
    new = spark.createDataFrame([("b",), ("d",)], "recid string")
    assert {(r.recid, r.change) for r in audit.keys_added_dropped(log, new).collect()} == {
        ("a", "dropped"), ("c", "dropped"), ("d", "added")}
    old = spark.createDataFrame([(1, None), (2, 1.0), (2, 1.0), (3, float("nan"))], "a int, b double")
    new = spark.createDataFrame([(1, None), (4, None), (3, float("nan"))], "a int, b double")
    assert [r.a for r in audit.changed_rows(old, new).collect()] == [4]
    assert [r.a for r in audit.keys_with_n_rows(old, "a", 2).collect()] == [2]


def test_epoch(spark):
    got = spark.range(1).select(audit.epoch_to_timestamp(F.lit(1577836800999)).cast("string").alias("t")).first().t
    assert got == "2020-01-01 00:00:00"


def test_percentile_brackets_match_sorting(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    hot = np.where(rng.random(20000) < 0.4, 0.25, rng.normal(size=20000))
    df = spark.createDataFrame([(float(v),) for v in hot] + [(None,), (float("nan"),)], "v double").repartition(7)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    want = [float(np.percentile(hot, 100 * p)) for p in probs]
    for accuracy, bound in ((500, 20_000), (2000, 100), (10**6, 10), (20_000, 1)):
        found = stats.exact_percentiles(df, ["v"], probs, accuracy, bound)["v"]
        assert [found[p] for p in probs] == want


def test_a_missed_bracket_is_done_again(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("double").alias("v"))
    narrow, calls = stats._Wanted.narrow, []

    def off(self, grid, accuracy):
        narrow(self, grid, accuracy)
        calls.append(self.slack)
        if len(calls) <= 2:
            self.low, self.high = 4990.0, 4995.0

    monkeypatch.setattr(stats._Wanted, "narrow", off)
    found = stats.exact_percentiles(df, ["v"], [0.25, 0.5], bound=50)["v"]
    assert found == {0.25: 1249.75, 0.5: 2499.5} and max(calls) == 16.0


def test_brackets_are_small(spark, monkeypatch):
    seen, inside = [], stats._inside

    def spy(typed, wanted):
        seen.extend(typed.where(F.col(w.column).between(w.low, w.high)).count() for w in wanted)
        return inside(typed, wanted)

    monkeypatch.setattr(stats, "_inside", spy)
    df = spark.range(60_000).select((F.col("id") * 7919 % 60_000).cast("double").alias("v"))
    found = stats.exact_percentiles(df, ["v"], [0.1, 0.5, 0.9], bound=200)["v"]
    assert [found[p] for p in (0.1, 0.5, 0.9)] == [pytest.approx(5999.9), 29999.5, pytest.approx(53999.1)]
    assert max(seen) <= 300


def test_novel_values_are_looked_up_without_a_shuffle(spark, master):
    """Few unseen values meet the pairs by broadcast, column by column, and warn in column order."""
    rows = [("k02", "city9", "Q9", 2.0, None, "ed", LATER), ("k03", "city1", "Z3", 3.0, None, "new", LATER),
            ("n1", "city9", "Q9", 2.0, None, None, LATER), (None, "city0", "Q8", 2.0, None, "ed", LATER)]
    log, out = log_of(spark, master, rows)
    said = {k: [w.split(" ")[0] + " " + w.split(" ")[-1] for w in r.warnings if "not in other" in w] for k, r in log.items()}
    assert said == {"k02": ['"city9" city_name', '"Q9" zn_code'], "k03": ['"new" editor'],
                    "n1": ['"city9" city_name', '"Q9" zn_code'], None: ['"Q8" zn_code']}
    assert log["k02"].cols_updated == ["city_name", "zn_code", "edit_date"] and log["k02"].changed_vals == 3
    plan = out.update_log._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "ObjectHashAggregate" not in plan and "ShuffledHashJoin" not in plan
