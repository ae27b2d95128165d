import random
import re

from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.operators import extract, training
from zoneflow.plans.rules import ZONING, RuleSet
from zoneflow.sources import corpus

GOLDEN = [
    "The minimum lot area shall be 5,000 square feet (600) per unit",
    "Maximum building height is thirty five feet or 35 feet in R1 zone",
    "35 feet maximum height",
    "height of structures: 20 25 30 feet",
    "RM2-5A and R-1 districts",
    "floor area ratio of 2.5 or 3 max",
    "2 units per each lot (2)",
    "",
    "building height 5000 feet",
]
NO_DUA = RuleSet(r for r in ZONING.rules if r.attribute != "max_dua")


def lines_of(spark, docs):
    rows = [(k, city, "s", "\n".join(v)) for k, city, v in docs]
    return corpus.lines(spark.createDataFrame(rows, "doc_id int, city string, section string, text string"))


def test_golden_document(spark):
    lines = lines_of(spark, [(1, "c", GOLDEN)])
    hits = extract.zone_candidates(lines, extract.attributes(lines, NO_DUA))
    got = sorted((r.line_no, r.attribute, r.pattern_id, r["values"], round(r.fraction, 3), r.zone_candidates) for r in hits.collect())
    zones = "R1, RM2-5A"
    assert got == [
        (1, "minimum_lot_sqft", 1, "5000.0", 0.0, zones),
        (1, "minimum_lot_sqft", 2, "5000.0", 0.0, zones),
        (2, "building_height", 0, "30.0, 35.0", 11.111, zones),
        (2, "building_height", 1, "30.0, 35.0", 11.111, zones),
        (4, "building_height", 2, "20.0, 30.0", 33.333, zones),
        (6, "max_far", 0, "3.0", 55.556, zones),
        (7, "units_per_lot", 0, "2.0", 66.667, zones),
    ]


def test_context_keeps_the_line_and_no_zone_is_null(spark):
    lines = lines_of(spark, [(1, "c", ["building height of  30 feet", "x"])])
    hit = extract.zone_candidates(lines, extract.attributes(lines, ZONING)).first()
    assert hit.context == "building height of  30 feet"
    assert hit.zone_list is None and hit.zone_candidates is None


def test_window_reaches_nineteen_lines(spark):
    text = [""] * 80
    text[39] = "building height of 30 feet"
    for offset, code in ((-20, "A1"), (-19, "B1"), (19, "C1"), (20, "D1")):
        text[39 + offset] = code
    lines = lines_of(spark, [(1, "c", text)])
    hits = extract.attributes(lines, ZONING)
    assert extract.zone_candidates(lines, hits).first().zone_candidates == "B1, C1"
    around = extract.context(lines, hits).collect()
    assert sorted(r.line_no for r in around) == list(range(21, 60))
    assert [r.line_no for r in around if r.is_hit] == [40]


def test_windows_match_brute_force(spark):
    random.seed(3)
    docs = []
    for d in range(4):
        n = random.choice([1, 15, 90, 400])
        docs.append((d, "c", [random.choice(["", "x", f"R{random.randint(1, 30)} zone", "building height of 30 feet"]) for _ in range(n)]))
    lines = lines_of(spark, docs)
    hits = extract.attributes(lines, ZONING)
    got = {(r.doc_id, r.line_no): r.zone_candidates for r in extract.zone_candidates(lines, hits).collect()}
    want = {}
    for d, _, text in docs:
        for i, line in enumerate(text):
            if "height" in line:
                near = {z for t in text[max(0, i - 19): i + 20] for z in re.findall(tx.ZONE_CODE, t)}
                want[(d, i + 1)] = ", ".join(sorted(near)) or None
    assert got == want
    pairs = {(r.doc_id, r.hit_line, r.line_no) for r in extract.context(lines, hits).collect()}
    assert pairs == {(d, i + 1, j + 1) for d, _, text in docs for i, line in enumerate(text) if "height" in line
                     for j in range(max(0, i - 19), min(len(text), i + 20))}


def test_hits_do_not_depend_on_partitioning(spark):
    lines = lines_of(spark, [(d, f"c{d % 3}", GOLDEN) for d in range(30)])
    one = extract.attributes(lines.coalesce(1), ZONING).collect()
    many = extract.attributes(lines.repartition(13), ZONING).collect()
    assert sorted(map(str, one)) == sorted(map(str, many)) and one


def test_every_rule_agrees_with_python(spark):
    probes = GOLDEN + ["Dual use", "dwelling and unit per acre", "lots of acres", "acres and dwelling or unit", "DWELLING x ACRE",
                       "units and acre", "max the far", "unit sq ft", "units in square feet", "minimum lot square feet", "gross lot x area", "sq foot"]
    df = spark.createDataFrame([(p,) for p in probes], "line string")
    got = df.select("line", *[F.col("line").rlike(tx.line_pattern(r.pattern)).alias(str(i)) for i, r in enumerate(ZONING.rules)]).collect()
    for row in got:
        assert [bool(re.search(r.pattern, row.line)) for r in ZONING.rules] == list(row)[1:]


def test_rules_from_tables(spark):
    again = RuleSet.from_frames(ZONING.rules_frame(spark), ZONING.ranges_frame(spark))
    assert set(again.rules) == set(ZONING.rules)


def test_zone_split_and_values(spark):
    lines = lines_of(spark, [(1, "c", ["R1 and R2: building height of 40 or 30 feet", "R1 building height of 99 feet", "building height of 50 feet"])])
    hits = extract.attributes(lines, ZONING).where("pattern_id = 0")
    zoned = extract.split_by_zone(hits, ["R1", "R2", "R9"])
    assert sorted((r.zone, r.line_no) for r in zoned.collect()) == [("R1", 1), ("R1", 2), ("R2", 1), ("no_zone", 3)]
    table = spark.createDataFrame([("R1", 7.0), ("R3", 8.0)], "zn_code string, building_height double")
    new, updates = extract.apply_values(table, zoned, ["building_height", "max_far"])
    assert updates.count() == 2
    assert sorted((r.zn_code, r.building_height, r.max_far) for r in new.collect()) == [
        ("R1", 30.0, None), ("R2", 30.0, None), ("R3", 8.0, None)]


def test_coverage_districts_and_lookup(spark):
    lines = lines_of(spark, [(1, "a", ["building height of 30 feet in R-1"]), (2, "b", ["R-1 and C-2A"])])
    hits = extract.attributes(lines, ZONING)
    cities = spark.createDataFrame([("a",), ("b",)], "city string")
    assert extract.coverage(hits, cities).first().pct_found == 50.0
    tokens, found = extract.districts(lines)
    assert {(r.city, r.district) for r in tokens.collect()} == {("a", "R-1"), ("b", "R-1"), ("b", "C-2A")}
    assert found.count() == 2
    assert extract.find_information(hits, "a", "building_height").count() == 1
    assert extract.find_information(hits, "b", "building_height").count() == 0


def test_none_lines_inside_documents_equal_the_join(spark):
    pad = "one long line of plain words"
    docs = spark.createDataFrame(
        [(1, "c", "s", "\n".join([*GOLDEN, pad, "too short"])), (2, "c", "s", pad), (3, "c", "s", None)],
        "doc_id int, city string, section string, text string")
    lines = corpus.lines(docs)
    joined = training.none_lines(lines, extract.attributes(lines, ZONING))
    direct = training.none_lines_of(docs, ZONING)
    def shape(df):
        return sorted((r.doc_id, r.line_no, r.line) for r in df.collect())
    assert shape(joined) == shape(direct) and (1, 10, pad) in shape(direct)
    assert "Exchange" not in direct._jdf.queryExecution().executedPlan().toString()


def test_hits_inside_documents_equal_the_tables(spark):
    random.seed(8)
    pool = ["", "x", "R1 zone", "R2 and R1", "building height of 30 feet in R7", *GOLDEN]
    rows = [(d, "c", "s", "\n".join(random.choice(pool) for _ in range(n))) for d, n in enumerate([0, 1, 30, 120, 500])]
    docs = spark.createDataFrame([*rows, (99, "c", "s", None)], "doc_id int, city string, section string, text string")
    direct = extract.document_hits(docs, ZONING)
    lines = corpus.lines(docs)
    joined = extract.zone_candidates(lines, extract.attributes(lines, ZONING))
    assert direct.columns == joined.columns
    assert sorted(map(str, direct.collect())) == sorted(map(str, joined.collect()))
    assert "Exchange" not in direct._jdf.queryExecution().executedPlan().toString()


def test_patterns_are_tried_once_and_only_where_their_letters_are(spark):
    from zoneflow.functions import text as tx
    assert tx.required_letters(r"(?i)sq(uare)*.+fo*e*t") == ["sq", "f", "t"]
    assert tx.required_letters(r"(?i)unit.+acres?") == ["acre", "unit"] and tx.required_letters(r"(?i)a+b*cd?") == ["a", "c"]
    for other in (r"unit", r"(?i)a|b", r"(?i)[ab]c", r"(?i)a\d", r"(?i)a{0}b", r"(?i)((a)b)?c", r"(?i)(la|de).+(el|le)", r"(?i)a(?=b)"):
        assert tx.required_letters(other) == []
    # the long s and the Kelvin sign fold to ASCII letters
    texts = ["Maximum BUILDING height 30 feet tall", "FLOOR area ratio 2 max", "ſq 700 feet a", "unitſ per 3 lot", "no rule 30 x", "height of ſtructure is 40 feet"]
    docs = spark.createDataFrame([(1, "c", "s", "\n".join(texts))], "doc_id long, city string, section string, text string")
    lines = corpus.lines(docs)
    found = extract.attributes(lines, ZONING)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all(plan.count(tx.line_pattern(r.pattern) + ")") == 1 for r in ZONING.rules)
    rows = {(r.line_no, r.attribute, r.pattern_id) for r in found.collect()}
    assert rows == {(1, "building_height", 0), (1, "building_height", 1), (2, "max_far", 0), (3, "minimum_lot_sqft", 2), (4, "units_per_lot", 0), (6, "building_height", 2)}
    assert rows == {(r.line_no, r.attribute, r.pattern_id) for r in extract.document_hits(docs, ZONING).collect()}
