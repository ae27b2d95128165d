import threading
import time

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from zoneflow.operators import features, models
from zoneflow.plans.rules import LABEL_CODES

WORDS = {"max_dua": "dwelling units acre", "minimum_lot_sqft": "square feet minimum lot", "building_height": "height of building stories",
         "units_per_lot": "units on each lot", "max_far": "floor area ratio", "none": "general purpose chapter title"}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"city{i % 3}", a, f"{w} number {i} {w}") for i in range(12) for a, w in WORDS.items()]
    df = spark.createDataFrame(data, "city string, attribute string, context string")
    return features.line_features(df, features.city_frequency(df)).persist()


def test_text_stats(spark):
    df = spark.createDataFrame([("The lots, and units",), ("the and",)], "context string")
    got = [(r.tokens, r.char_count, r.word_count, r.avg_word_length) for r in features.text_stats(df, "context", ["the", "and"]).collect()]
    assert got == [(["lots", "units"], 10, 2, 5.0), ([], 0, 0, None)]


def test_lemmas_are_joined(spark):
    df = spark.createDataFrame([(1, "Lots lots units lot"), (2, None), (3, "none listed"), (None, "units")], "k int, context string")
    lemmas = spark.createDataFrame([("lots", "lot"), ("UNITS", "unit"), ("units", "unity"), (None, "x"), ("unused", "y")], "word string, lemma string")
    got = features.text_stats(df.where("k is not null"), "context", lemmas=lemmas, key=["k"])
    assert {r.k: (r.tokens, r.char_count) for r in got.collect()} == {
        1: (["lot", "lot", "unit", "lot"], 16), 2: ([], 0), 3: (["none", "listed"], 11)}
    assert "keys: [" not in got._jdf.queryExecution().toString()


def test_encodings(spark, rows):
    assert {r.label for r in rows.select("label").collect()} == {float(c) for c in LABEL_CODES.values()}
    assert rows.first().city_share == pytest.approx(1 / 3)
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "city string")
    fitted = features.city_frequency(df)
    assert {r.city: (r.n, r.share) for r in fitted.collect()} == {"x": (2, 2 / 3), "y": (1, 1 / 3)}
    unseen = features.encode_frequency(spark.createDataFrame([("z",)], "city string"), fitted).first()
    assert unseen.city_share is None
    code = spark.createDataFrame([("max_far",), ("odd",)], "attribute string").select(features.encode_label().alias("c"))
    assert [r.c for r in code.collect()] == [4, None]
    back = code.select(features.decode_label("c").alias("d"))
    assert [r.d for r in back.collect()] == ["max_far", None]
    assert spark.createDataFrame([("ab",)], "t string").select(features.characters("t").alias("c")).first().c == ["a", "b"]


@pytest.mark.parametrize("kind", ["hash", "count"])
def test_logistic_learns_and_gives_probabilities(rows, kind, tmp_path):
    if kind == "count":
        keyed = rows.withColumn("id", F.monotonically_increasing_id())
        rows = features.counted(keyed, "id", features.vocabulary(keyed))
    model = features.line_pipeline(models.logistic(maxIter=20), kind, 256).fit(rows)
    out = models.score(model, rows)
    assert out.where("prediction = label").count() >= 0.95 * rows.count()
    first = out.first()
    assert sum(first[f"p_{name}"] for name in LABEL_CODES) == pytest.approx(1.0)
    models.save(model, str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m")).transform(rows)
    assert again.select("prediction").collect() == out.select("prediction").collect()


def test_forest_and_boosting(rows):
    forest = features.line_pipeline(models.forest(1, numTrees=5, maxDepth=5), size=64).fit(rows)
    assert "p_none" in models.score(forest, rows).columns
    boosted = features.line_pipeline(models.boosting(1, maxIter=1, maxDepth=2), size=32).fit(rows)
    assert "p_none" not in models.score(boosted, rows).columns


def test_search_and_leaderboard(rows):
    grid = {"maxDepth": [1, 2], "maxIter": [1]}
    assert models.draws(models.BOOSTING_GRID, 50, 1) == models.draws(models.BOOSTING_GRID, 50, 1)
    assert len(models.draws(models.BOOSTING_GRID, 50, 1)) == 50
    data = features.feature_stages(size=32).fit(rows).transform(rows).select("context", "label", "features")
    data = models.with_folds(data, 2, 3, ["context"]).persist()
    assert {r["n"] for r in data.groupBy("label", "fold").count().withColumnRenamed("count", "n").collect()} == {6}
    found = models.search(lambda p: models.boosting(1, **p), data, grid, n=2, folds=2, parallelism=2)
    assert [p for p, _ in found] == models.draws(grid, 2, 0) and all(0 <= m <= 1 for _, m in found)
    table = models.leaderboard({"stump": models.forest(1, numTrees=1, maxDepth=1), "logistic": models.logistic(maxIter=10)}, data, folds=2)
    assert [r.model for r in table.collect()] == ["logistic", "stump"]
    data.unpersist()


def test_rounds_read_off_one_fit_are_those_of_separate_fits(spark, rows):
    grid = {"stepSize": [0.1], "maxDepth": [2], "minInstancesPerNode": [1], "maxIter": [1, 3], "subsamplingRate": [0.6]}
    data = features.feature_stages(size=32).fit(rows).transform(rows).select("context", "label", "features")
    data = models.with_folds(data.where("label < 3"), 2, 3, ["context"]).persist()
    apart = models.search(lambda p: models.boosting(1, **p), data, grid, n=2, folds=2)
    assert models.search_boosted(data, grid, n=2, folds=2) == apart
    estimator = dict(stepSize=0.1, maxDepth=2, subsamplingRate=0.6)
    long, short = (models.boosting(1, maxIter=n, **estimator).fit(data) for n in (3, 1))
    cut = models.after_rounds(long, 1)
    assert [m.toDebugString.split("\n", 1)[1] for m in cut.models] == [m.toDebugString.split("\n", 1)[1] for m in short.models]
    raw = [[r[0] for r in m.transform(data).orderBy("context").select(F.col("rawPrediction").cast("string")).collect()] for m in (cut, short)]
    assert raw[0] == raw[1]
    data.unpersist()


def most_at_once(monkeypatch, work) -> int:
    """How many boosted fits ran side by side while ``work`` did."""
    lock, seen, fit = threading.Lock(), [0, 0], models.GBTClassifier._fit

    def counted(self, dataset):
        with lock:
            seen[0] += 1
            seen[1] = max(seen)
        try:
            time.sleep(0.2)
            return fit(self, dataset)
        finally:
            with lock:
                seen[0] -= 1

    with monkeypatch.context() as m:
        m.setattr(models.GBTClassifier, "_fit", counted)
        work()
    return seen[1]


def test_fits_at_once_are_bounded_by_what_they_keep(rows, monkeypatch):
    data = features.feature_stages(size=32).fit(rows).transform(rows).select("context", "label", "features")
    data = models.with_folds(data.where("label < 3"), 2, 3, ["context"]).persist()
    grid = {"maxDepth": [1], "maxIter": [1]}
    bins = 4 * data.count() * data.first()["features"].size
    assert [models.fits_at_once(data, n) for n in (0, bins - 1, bins, 3 * bins)] == [1, 1, 1, 3]
    assert models.fits_at_once(data) > 100 and models.fits_at_once(data.where("label < 0"), bins) == 1
    assert [models.shared_out(n, 4, 4) for n in (1, 2, 8, 9, 100)] == [(1, 1), (1, 2), (2, 4), (2, 4), (4, 4)]

    def work():
        found.append(models.search_boosted(data, grid, n=1, folds=2))
        found.append(models.search(lambda p: models.boosting(1, **p), data, grid, n=1, folds=2))

    found = []
    assert most_at_once(monkeypatch, work) > 1
    monkeypatch.setattr(models, "fits_at_once", lambda data: 1)
    assert most_at_once(monkeypatch, work) == 1
    assert found[0] == found[1] == found[2] == found[3]
    data.unpersist()


def test_counted_vocabulary_has_no_limit(spark):
    words = " ".join(f"w{i}" for i in range(5000))
    df = spark.createDataFrame([("x", words), ("y", None), ("z", "")], "city string, context string").withColumn("city_share", F.lit(0.5))
    df = features.fill_numbers(features.text_stats(df))
    vectors = {r["city"]: r["token_vector"] for r in features.counted(df, "city", features.vocabulary(df)).collect()}
    assert {v.size for v in vectors.values()} == {5000}
    assert vectors["x"].indices.tolist() == list(range(5000)) and set(vectors["x"].values) == {1.0}
    assert not len(vectors["y"].indices) and not len(vectors["z"].indices)
    counts = features.token_counts(df, "city", features.vocabulary(df))
    assert counts.count() == 5000


def test_missing_number_fails_instead_of_losing_the_row(spark, rows):
    fitted = features.feature_stages(size=32).fit(rows)
    with pytest.raises(Exception, match="(?i)null"):
        fitted.transform(rows.withColumn("city_share", F.lit(None).cast("double"))).select("features").collect()


def test_fills_and_unseen_categories(spark):
    columns, schema = ["city", "acres"], "city string, acres double, label string"
    data = [("a" if i % 3 else "b", float(i % 7) if i % 5 else None, "residential" if i % 3 else "commercial") for i in range(60)]
    df = spark.createDataFrame([*data, (None, float("nan"), "commercial")], schema)
    fills = features.learn_fills(df, columns)
    assert fills == {"city": "a", "acres": 3.0}
    ready = features.filled(df, columns, fills)
    assert ready.where("city is null or acres is null").count() == 0 and ready.where("acres_missing = 1").count() == 13
    model = features.land_use_pipeline(ready, columns, models.forest(1, "label_index", numTrees=3)).fit(ready)
    new = features.filled(spark.createDataFrame([("zzz", None, "residential"), ("b", 1.0, "residential")], schema), columns, fills)
    hot = [r["h"] for r in model.transform(new).select(vector_to_array("city_hot").alias("h")).collect()]
    assert hot == [[0.0, 0.0], [0.0, 1.0]]


def test_count_vectors_without_a_vocabulary_on_the_driver(spark):
    """Slots are those of the numbered words, counts those of the rows; unknown words count nowhere."""
    rows = spark.createDataFrame([(1, "b a b c".split()), (2, []), (3, "c z".split()), (4, None), (5, ["z"])], "id long, tokens array<string>")
    words = features.vocabulary(rows.where("id < 3"))
    slots = {r["token"]: r["slot"] for r in features.numbered(words).collect()}
    assert sorted(slots) == ["a", "b", "c"] and sorted(slots.values()) == [0, 1, 2]
    got = {r["id"]: r["token_vector"] for r in features.counted(rows, "id", words).collect()}
    assert {i: dict(zip(v.indices.tolist(), v.values.tolist())) for i, v in got.items()} == {
        1: {slots["a"]: 1.0, slots["b"]: 2.0, slots["c"]: 1.0}, 2: {}, 3: {slots["c"]: 1.0}, 4: {}, 5: {}}
    assert all(v.indices.tolist() == sorted(v.indices.tolist()) and v.size == 3 for v in got.values())
    none = features.counted(rows.where("id > 9"), "id", words)
    assert none.count() == 0 and none.schema["token_vector"].dataType.typeName() == "vectorudt"


def test_lemmas_of_a_long_row_and_of_a_repeated_key(spark):
    """Every other word of 200,000 has a lemma, in seconds; a key that occurs twice fails the job."""
    from time import monotonic
    df = spark.range(1).selectExpr("id", "transform(sequence(1, 200000), i -> IF(i % 2 = 0, concat('w', i), 'plain')) AS tokens")
    lemmas = spark.range(200001).selectExpr("concat('w', id) AS word", "concat('l', id) AS lemma")
    began = monotonic()
    got = features.lemmatised(df, lemmas, ["id"]).first()["tokens"]
    assert got == [f"l{i}" if i % 2 == 0 else "plain" for i in range(1, 200001)] and monotonic() - began < 20
    twice = df.union(df)
    with pytest.raises(Exception):
        features.lemmatised(twice, lemmas, ["id"]).collect()


def test_counted_rows_move_codes_and_not_words(spark, tmp_path, monkeypatch):
    """Blocks of rows ask once for a word; keys that repeat share their counts, a null key has none."""
    data = [(i, [f"w{i % 7}", "each", "each", None, f"rare{i}"]) for i in range(40)] + [(50, ["each"]), (50, ["each", "w1"]), (None, ["each"]), (60, []), (61, None)]
    df = spark.createDataFrame(data, "id int, tokens array<string>").repartition(3)
    words = spark.createDataFrame([(w,) for w in ["each", *(f"w{i}" for i in range(7))]], "token string")
    slot = {r["token"]: r["slot"] for r in features.numbered(words).collect()}
    plans = []
    real = features._vectors
    monkeypatch.setattr(features, "_vectors", lambda coded, known, *more: plans.append((coded, known)) or real(coded, known, *more))
    got = features.counted(df, "id", words, keep_words=False)
    assert got.columns == ["id", "token_vector"] and got.count() == 45
    for r in got.collect():
        v = dict(zip(r["token_vector"].indices.tolist(), r["token_vector"].values))
        want = {} if r["id"] in (None, 60, 61) else {slot["each"]: 2.0, slot["w1"]: 1.0} if r["id"] == 50 else {slot["each"]: 2.0, slot[f"w{r['id'] % 7}"]: 1.0}
        assert v == want and r["token_vector"].indices.tolist() == sorted(v) and r["token_vector"].size == 8
    coded, known = plans[0]
    assert "tokens" not in coded.columns and known.count() <= 3 * 8  # once a block, not once a row


def test_assembled_vectors_describe_no_slot(spark, rows):
    """A description of every slot on the driver grows with the vocabulary."""
    for stages in (features.feature_stages(size=1 << 18), features.scaled_stages(size=1 << 18)):
        out = stages.fit(rows).transform(rows)
        column = "features" if "_assembled" not in out.columns else "_assembled"
        assert len(out.schema[column].json()) < 1000
        first = out.select(*features.NUMERIC_FEATURES, "token_vector", column).first()
        v, tokens = first[column], first["token_vector"]
        assert v.size == 4 + (1 << 18) and [v[i] for i in range(4)] == [first[c] for c in features.NUMERIC_FEATURES]
        assert v.indices[4:].tolist() == [i + 4 for i in tokens.indices] and v.values[4:].tolist() == tokens.values.tolist()
