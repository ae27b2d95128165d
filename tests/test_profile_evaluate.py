import numpy as np
import pytest

from zoneflow.operators import evaluate, landuse, profile, training


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1.0, 0.0, 5.0, "a"), (2.0, 0.0, 5.0, "a"), (3.0, 0.0, 5.0, None), (None, 0.0, 5.0, "b"), (50.0, 0.0, 5.0, "a")],
                                 "x double, zeros double, same double, s string")


def test_null_rates(numbers):
    got = {r.column: (r.null_rate, r.complete) for r in profile.null_rates(numbers).collect()}
    assert got == {"x": (0.2, False), "zeros": (0.0, True), "same": (0.0, True), "s": (0.2, False)}
    after = {r.column: r.null_rate for r in profile.null_rates(profile.zero_as_null(numbers)).collect()}
    assert after["zeros"] == 1.0 and after["same"] == 0.0


def test_describe_and_boxplot(numbers):
    d = {r.column: r for r in profile.describe(numbers).collect()}["x"]
    assert (d["count"], d["min"], d["q50"], d["max"]) == (4, 1.0, 2.5, 50.0)
    assert d.stddev == pytest.approx(np.std([1, 2, 3, 50], ddof=1))
    b = {r.column: r for r in profile.boxplot(numbers, ["x", "same"]).collect()}
    assert (b["x"].low_whisker, b["x"].high_whisker, b["x"].outliers) == (1.0, 3.0, 1)
    assert (b["same"].q1, b["same"].outliers) == (5.0, 0)


def test_shares_and_minmax(numbers):
    assert {r.s: (r.n, r.share) for r in profile.class_shares(numbers, "s").collect()} == {"a": (3, 0.75), "b": (1, 0.25)}
    assert [r.s for r in profile.above_median(numbers, "s").collect()] == ["a"]
    got = [(r.x, r.same) for r in profile.minmax(numbers, ["x", "same"]).collect()]
    assert got[0] == (0.0, None) and got[4] == (1.0, None) and got[3][0] is None


def test_confusion_and_report(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), ("a", "d")]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    matrix = evaluate.confusion(df)
    assert matrix.count() == 16
    got = {r["class"]: r for r in evaluate.report(matrix).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (0.5, pytest.approx(1 / 3), 3)
    assert (got["b"].precision, got["b"].recall) == (pytest.approx(2 / 3), 1.0)
    assert (got["c"].precision, got["c"].recall, got["c"].f1, got["c"].support) == (0.0, 0.0, 0.0, 1)
    assert (got["d"].precision, got["d"].recall, got["d"].support) == (0.0, 0.0, 0)
    assert got["accuracy"].f1 == 0.5 and evaluate.accuracy(df).first().accuracy == 0.5
    assert got["macro avg"].recall == pytest.approx((1 / 3 + 1) / 4)
    assert got["weighted avg"].recall == pytest.approx(0.5)
    wide = {r.label: (r.a, r.b, r.c, r.d, r.other) for r in evaluate.confusion_wide(df, ["a", "b", "c", "d"]).collect()}
    assert wide == {"a": (1, 1, 0, 1, 0), "b": (0, 2, 0, 0, 0), "c": (1, 0, 0, 0, 0), "d": (0, 0, 0, 0, 0)}


def test_unscored_rows_count_as_wrong(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), ("b", "b"), ("b", None), (None, "a")], "label string, prediction string")
    cells = {(r.label, r.prediction): r.n for r in evaluate.confusion(df).collect()}
    assert len(cells) == 9 and cells["a", None] == 1 and cells[None, "a"] == 1 and sum(cells.values()) == 5
    got = {r["class"]: r for r in evaluate.report(evaluate.confusion(df)).collect()}
    assert got["a"].support == 2 and got["a"].recall == 0.5 and got["accuracy"].recall == 0.5 and got["accuracy"].support == 4
    assert evaluate.accuracy(df).first().accuracy == 0.5
    wide = {r.label: (r.a, r.other) for r in evaluate.confusion_wide(df, ["a"]).collect()}
    assert wide == {"a": (1, 1), "b": (0, 2), None: (1, 0)}


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert profile.null_rates(df).first().null_rate == 0.5
    d = profile.describe(df).first()
    assert (d["count"], d["mean"], d["max"], d["q50"]) == (2, 1.5, 2.0, 1.5)
    assert profile.boxplot(df, ["x"]).first().outliers == 0
    assert [r.x for r in profile.minmax(df, ["x"]).collect()] == [0.0, 1.0, None, None]


def test_null_rates_are_sorted(numbers):
    rates = [r.null_rate for r in profile.null_rates(numbers).collect()]
    assert rates == sorted(rates, reverse=True)


def test_hold_out_keeps_rows_without_a_city(spark):
    rows, held = training.hold_out(spark.createDataFrame([("a",), ("b",), (None,)], "city string"), "a")
    assert {r.city for r in rows.collect()} == {"b", None} and held.count() == 1


def test_land_use(spark):
    names = ["Low Density Residential", "Business Commercial", "Light Industrial Production", "Downtown",
             "Downtown Residential", "residential", None]
    df = spark.createDataFrame([(n,) for n in names], "plu_description string")
    assert [r.label for r in landuse.labels(df).collect()] == ["residential", "commercial", "industrial", "downtown"]
    assert landuse.described(df).count() == 5


def test_centroid(spark):
    shapes = ['{"type":"MultiPolygon","coordinates":[[[[-122,37],[-121,37],[-121,38],[-122,37]],[[0,0],[1,1]]],[[[9,9]]]]}', None, "not json"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "i int, geometry string")
    got = {r.i: (r.lon, r.lat) for r in landuse.with_centroid(df).collect()}
    assert got == {0: (-121.5, 37.25), 1: (None, None), 2: (None, None)}
    parsed = df.select("i", landuse.parse_geometry("geometry").alias("shape"))
    assert landuse.with_centroid(parsed, "shape").where("i = 0").first().lat == 37.25


def test_join_types_drops_unlabelled(spark):
    b = spark.createDataFrame([("RS", 1), ("XX", 2)], "building_type string, n int")
    t = spark.createDataFrame([("RS", "single")], "building_type string, building_type_description string")
    assert [r.n for r in landuse.join_types(b, t).collect()] == [1]


def test_none_lines_and_balance(spark):
    long = "one two three four five"
    lines = spark.createDataFrame(
        [(1, "c", 1, long), (1, "c", 2, "one two three four"), (1, "c", 3, long + " x"), (1, "c", 4, long + " y"), (2, "c", 1, long)],
        "doc_id int, city string, line_no int, line string")
    hits = spark.createDataFrame([(1, "c", 1, "max_far", long), (1, "c", 1, "max_dua", long)],
                                 "doc_id int, city string, line_no int, attribute string, context string")
    none = training.none_lines(lines, hits)
    assert sorted(r.line_no for r in none.collect()) == [3, 4]
    out = training.balanced(none, hits, 1).collect()
    assert sorted(r.attribute for r in out) == ["max_dua", "max_far", "none"]
    seen, held = training.hold_out(lines, "c")
    assert (seen.count(), held.count()) == (0, 5)
    assert training.check_split(lines, lines.where("doc_id = 1"), lines.where("doc_id = 2")).first().preserved
