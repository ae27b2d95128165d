import random
from datetime import date

from pyspark.sql import functions as F

from zoneflow.functions import text as tx


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn("v").alias("x")).orderBy("i").collect()]


def test_digits_for_words(spark):
    cases = {
        "thirty five feet": "30 5 feet",
        "  two  units\tper lot ": "2 units per lot",
        "Twenty-five or ONE": "25 or 1",
        "two-story, three,": "2 three,",
        "one-hundred-twenty-five": "125",
        "two-thousand hundred": "2000 100",
        "None of the tone": "None of the tone",
        "10-20 and 2.5": "10-20 and 2.5",
        "": "",
    }
    assert apply(spark, cases, tx.digits_for_words) == list(cases.values())


def test_integers_traps(spark):
    cases = {
        "x 5 6 7 y": [5.0, 7.0],
        "35 feet maximum 9": [],
        "(600) and 2.5 or 17.172.050 x": [600.0],
        "a 5,000 b": [5000.0],
        "a " + "9" * 40 + " b": [float("9" * 40)],
    }
    got = apply(spark, cases, lambda c: tx.integers(tx.without_commas(tx.digits_for_words(c))))
    assert got == list(cases.values())


def test_float_text_matches_python(spark):
    random.seed(5)
    values = [0.0, 1.0, 1e7, 12345678.0, 123456789.125, 9.99e15, 1e16, 0.001, 0.0005, 9.9e-5, -2.5e8, 1e100, 20.5]
    values += [random.uniform(-1, 1) * 10 ** random.randint(-6, 15) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert all(r.t == repr(r.v) for r in df.select("v", tx.float_text("v").alias("t")).collect())
    assert spark.range(1).select(tx.float_text(F.lit(None)).alias("t")).first().t is None


def test_codes(spark):
    assert apply(spark, ["R1 RM2-5A R-1 C-12"], lambda c: tx.codes(c, tx.ZONE_CODE)) == [["R1", "RM2-5A"]]
    assert apply(spark, ["R-1 C-12 RM2-5A"], lambda c: tx.codes(c, tx.DISTRICT_CODE)) == [["R-1", "C-1"]]


def test_line_pattern_passes_carriage_return_and_folds_letters(spark):
    found = apply(spark, ["floor\rarea ratio", "FLOOR AREA RATIO", "flooſ"],
                  lambda c: F.col(c).rlike(tx.line_pattern(r"(?i)floor.+area.+ratio|floos")))
    assert found == [True, True, True]


def test_path_expressions(spark):
    path = "policies/walnut creek/01-23-20/Title 17.04 Zoning, general.txt"
    assert apply(spark, [path], tx.path_tokens)[0] == [
        "policies", "walnut", "creek", "01-23-20", "title-17", "04", "zoning", "general", "txt"]
    assert apply(spark, [path], tx.path_section) == ["Title 17"]
    assert apply(spark, [path, "a"], lambda c: tx.path_part(c, 1)) == ["walnut creek", None]


def test_short_date(spark):
    got = apply(spark, ["01-23-20", "1-2-69", "12-31-68", "13-01-20", "x", "01-23-2020"], tx.short_date)
    assert got == [date(2020, 1, 23), date(1969, 1, 2), date(2068, 12, 31), None, None, None]


def test_words_and_counts(spark):
    assert apply(spark, ["The lots, (and) Élan_2's x "], lambda c: tx.words(c, ["the", "and"])) == [["lots", "Élan_2s", "x"]]
    assert apply(spark, ["a b c d", " a b  c d e "], tx.word_count) == [4, 5]
