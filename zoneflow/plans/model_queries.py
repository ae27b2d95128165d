"""Registered model queries.

What SQL can express of them is compared with SQL: features before the fit, folds, splits. A fit is
checked by what must hold for any good one; metrics themselves have no SQL.

Slots: linear models, and models that are compared over the same features, have 2^18 hash slots. Spark's forests keep a bin
per feature and row in a dense array (1 MB a row at 2^18), so a tree model alone gets ``TREE_SLOTS``; both are parameters.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.operators import evaluate, features, landuse, models, profile, sampling
from zoneflow.operators.wide_logistic import WideLogistic
from zoneflow.plans.queries import PRODUCT_USES, STOP, _CASES, _FLAGS, dealt, md5_place
from zoneflow.plans.registry import register, table
from zoneflow.session import kept, shared_path, spread, written

LANGUAGES = {"en": 0, "fr": 1, "de": 2, "es": 3}
HASH_SLOTS, TREE_SLOTS = 1 << 18, 1 << 10


def language_documents(spark, sf_dir) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("source").alias("city"), F.col("lang").alias("attribute"), F.col("text").alias("context"))
    return sampling.split(docs, ["attribute"], 0.8, 31, ["doc_id"])


def language_rows(spark, sf_dir) -> DataFrame:
    """Documents as rows to classify by language, with features, label and train flag."""
    flagged = language_documents(spark, sf_dir)
    frequency = features.city_frequency(flagged.where("in_train").select("city"))
    rows = features.text_stats(features.encode_frequency(flagged, frequency), "context", STOP)
    return features.fill_numbers(rows).withColumn(
        "label", features.encode_label("attribute", LANGUAGES).cast("double")).drop("context")


def document_words(spark, sf_dir) -> DataFrame:
    """Documents' words and train flag, written: the vocabulary and the counts both read them."""
    rows = features.text_stats(language_documents(spark, sf_dir), "context", STOP)
    return written(rows.select("doc_id", "in_train", "tokens"), "words", "zstd")


SPLIT_SQL = f"""split AS (SELECT doc_id, source AS city, lang AS attribute, text AS line, row_number() OVER (PARTITION BY lang ORDER BY {md5_place(31, "doc_id")})
  <= round_even(0.8 * count(*) OVER (PARTITION BY lang), 0) AS in_train FROM documents)"""
FIT_SQL = f"""WITH {SPLIT_SQL} SELECT attribute AS class, count(*) AS support, true AS all_scored, true AS beats_majority
FROM split WHERE NOT in_train GROUP BY 1"""


def checked(scored: DataFrame, given: DataFrame, codes: dict[str, int]) -> DataFrame:
    """Per class: support in the report; and whether every given row was scored and whether the
    accuracy reaches the largest class's share."""
    named = scored.select(F.col("attribute").alias("label"), features.decode_label("prediction", codes).alias("prediction"))
    report = evaluate.report(evaluate.confusion(named))
    whole = report.agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("recall"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "accuracy", F.col("support"))).alias("n"),
        F.max(F.when(F.col("class").isin(list(codes)), F.col("support"))).alias("largest")).first()
    all_scored, beats = whole["n"] == given.count(), whole["accuracy"] >= whole["largest"] / max(1, whole["n"])
    return report.where(F.col("class").isin(list(codes)) & (F.col("support") > 0)).select(
        "class", "support", F.lit(all_scored).alias("all_scored"), F.lit(beats).alias("beats_majority"))


def fit_and_check(spark, sf_dir, pipeline, rows: DataFrame | None = None) -> DataFrame:
    with kept(language_rows(spark, sf_dir) if rows is None else rows) as rows:
        test = rows.where("NOT in_train")
        model = pipeline.fit(rows.where("in_train"))
        with kept(models.score(model, test, LANGUAGES).select("attribute", "prediction")) as scored:
            found = checked(scored, test, LANGUAGES).collect()
    return spark.createDataFrame(found, "class string, support long, all_scored boolean, beats_majority boolean")


@register("line_classifier_forest", FIT_SQL)
def line_classifier_forest(spark, sf_dir):
    return fit_and_check(spark, sf_dir, features.line_pipeline(models.forest(1, numTrees=10, maxDepth=6), size=TREE_SLOTS))


@register("line_classifier_logistic", FIT_SQL)
def line_classifier_logistic(spark, sf_dir):
    return fit_and_check(spark, sf_dir, features.line_pipeline(models.logistic(maxIter=15, regParam=0.01), size=HASH_SLOTS))


@register("line_classifier_boosting", FIT_SQL)
def line_classifier_boosting(spark, sf_dir):
    boosted = models.boosting(1, parallelism=4, maxIter=10, maxDepth=3)
    return fit_and_check(spark, sf_dir, features.line_pipeline(boosted, size=TREE_SLOTS))


@register("line_classifier_counts", FIT_SQL)
def line_classifier_counts(spark, sf_dir):
    """Over the whole vocabulary of the training rows, coefficients in tables."""
    rows = written(language_rows(spark, sf_dir), "rows")
    rows = features.counted(rows, "doc_id", features.vocabulary(rows.where("in_train")), keep_words=False)
    return fit_and_check(spark, sf_dir, features.line_pipeline(WideLogistic(["doc_id"], max_iter=15, reg=0.01), "count"), rows)


@register("token_count_vectors", f"""WITH {SPLIT_SQL},
t AS (SELECT doc_id, in_train, unnest(list_filter(regexp_extract_all(regexp_replace(line, '[^\\p{{L}}\\p{{N}}_\\x09-\\x0D\\x1C-\\x20\\x85\\xA0]', '', 'g'), '[^\\x09-\\x0D\\x1C-\\x20\\x85\\xA0]+'),
  lambda w: lower(w) NOT IN ({", ".join(f"'{w}'" for w in STOP)}))) AS token FROM split),
v AS (SELECT DISTINCT token FROM t WHERE in_train),
placed AS (SELECT token, row_number() OVER (ORDER BY md5('0|' || token)) - 1 AS slot FROM v),
c AS (SELECT doc_id, slot, count(*) AS n FROM t JOIN placed USING (token) GROUP BY ALL)
SELECT s.doc_id, (SELECT count(*) FROM v) AS places, count(slot) AS slots,
  md5(coalesce(string_agg(slot || ':' || n, ' ' ORDER BY slot), '')) AS vector_md5
FROM split s LEFT JOIN c ON c.doc_id = s.doc_id GROUP BY s.doc_id""")
def token_count_vectors(spark, sf_dir):
    """Documents' sparse count vectors, slot by slot: numbers of words, their counts and the length."""
    rows = document_words(spark, sf_dir)
    words = features.vocabulary(rows.where("in_train"))
    counted = features.counted(rows.select("doc_id", "tokens"), "doc_id", words, keep_words=False)
    vector = counted.select("doc_id", F.unwrap_udt("token_vector").alias("v"))
    listed = F.zip_with("v.indices", "v.values", lambda i, n: F.concat_ws(":", i, n.cast("long")))
    return vector.select("doc_id", F.col("v.size").cast("long").alias("places"), F.size("v.indices").cast("long").alias("slots"),
                         F.md5(F.array_join(listed, " ")).alias("vector_md5"))


@register("line_classifier_scaled", FIT_SQL)
def line_classifier_scaled(spark, sf_dir):
    """Features scaled to unit deviation, then a linear support vector machine."""
    from pyspark.ml import Pipeline
    svm = models.svm(parallelism=4, maxIter=10, regParam=0.1)
    return fit_and_check(spark, sf_dir, Pipeline(stages=[*features.scaled_stages(size=HASH_SLOTS).getStages(), svm]))


@register("line_probabilities", f"WITH {SPLIT_SQL} SELECT doc_id, true AS in_range, true AS sums_to_one, true AS same_when_loaded FROM split")
def line_probabilities(spark, sf_dir):
    """Every document scored by a fitted and by the saved and loaded model."""
    names = [f"p_{name}" for name in LANGUAGES]
    with kept(language_rows(spark, sf_dir)) as rows:
        model = features.line_pipeline(models.logistic(maxIter=10, regParam=0.01), size=HASH_SLOTS).fit(rows.where("in_train"))
    path = shared_path(spark, "model")
    models.save(model, path)
    rows = language_rows(spark, sf_dir)
    scored = models.score(model, rows, LANGUAGES).select("doc_id", "prediction", *names)
    again = models.score(models.load(path), rows, LANGUAGES).select("doc_id", F.array("prediction", *names).alias("again"))
    total = sum(F.col(n) for n in names)
    return scored.join(again, "doc_id").select(
        "doc_id", F.forall(F.array(*names), lambda p: p.between(0, 1)).alias("in_range"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"), (F.col("again") == F.array("prediction", *names)).alias("same_when_loaded"))


@register("token_count_rows", f"""WITH {SPLIT_SQL},
t AS (SELECT doc_id, in_train, unnest(list_filter(regexp_extract_all(regexp_replace(line, '[^\\p{{L}}\\p{{N}}_\\x09-\\x0D\\x1C-\\x20\\x85\\xA0]', '', 'g'), '[^\\x09-\\x0D\\x1C-\\x20\\x85\\xA0]+'),
  lambda w: lower(w) NOT IN ({", ".join(f"'{w}'" for w in STOP)}))) AS token FROM split)
SELECT doc_id, token, count(*) AS n FROM t WHERE token IN (SELECT token FROM t WHERE in_train) GROUP BY ALL""")
def token_count_rows(spark, sf_dir):
    """Counts of each document's words over the whole vocabulary of the training documents."""
    rows = document_words(spark, sf_dir)
    return features.token_counts(rows, "doc_id", features.vocabulary(rows.where("in_train")))


@register("lemmatised_words", f"""WITH {SPLIT_SQL},
t AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (
  SELECT doc_id, list_filter(regexp_extract_all(regexp_replace(line, '[^\\p{{L}}\\p{{N}}_\\x09-\\x0D\\x1C-\\x20\\x85\\xA0]', '', 'g'), '[^\\x09-\\x0D\\x1C-\\x20\\x85\\xA0]+'),
    lambda w: lower(w) NOT IN ({", ".join(f"'{w}'" for w in STOP)})) AS ws FROM split)),
lemmas AS (SELECT DISTINCT lower(w) AS word, left(lower(w), 5) AS lemma FROM t WHERE length(w) >= 7)
SELECT doc_id, count(*) AS n, md5(string_agg(coalesce(lemma, w), ' ' ORDER BY pos)) AS words_md5 FROM t LEFT JOIN lemmas ON word = lower(w) GROUP BY doc_id""")
def lemmatised_words(spark, sf_dir):
    """Documents' words by a lemma table of thousands of rows: the first five letters of each long word."""
    rows = written(features.text_stats(language_documents(spark, sf_dir), "context", STOP).select("doc_id", "tokens"), "words")
    word = F.lower("word")
    table_ = rows.select(F.explode("tokens").alias("word")).where(F.length("word") >= 7).select(word.alias("word"), F.left(word, F.lit(5)).alias("lemma"))
    out = features.lemmatised(rows, table_.distinct(), ["doc_id"])
    return out.where(F.size("tokens") > 0).select("doc_id", F.size("tokens").cast("long").alias("n"), F.md5(F.array_join("tokens", " ")).alias("words_md5"))


@register("fold_sizes", f"""WITH {SPLIT_SQL}, r AS (SELECT attribute, (row_number() OVER (PARTITION BY attribute ORDER BY {md5_place(47, "doc_id")}) - 1) % 5 AS fold FROM split)
SELECT attribute, CAST(fold AS INTEGER) AS fold, count(*) AS n FROM r GROUP BY ALL""")
def fold_sizes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("attribute"))
    return models.with_folds(docs, 5, 47, ["doc_id"], "attribute").groupBy("attribute", "fold").agg(F.count("*").alias("n"))


@register("model_leaderboard", "SELECT unnest(['boosting', 'forest', 'logistic', 'svm']) AS model, 5 AS folds, true AS beats_chance")
def model_leaderboard(spark, sf_dir):
    """Four kinds of model by five stratified folds over features prepared once."""
    candidates = {
        "boosting": models.boosting(1, parallelism=4),
        "forest": models.forest(1),
        "logistic": models.logistic(),
        "svm": models.svm(parallelism=4),
    }
    table_ = models.leaderboard(candidates, prepared(spark, sf_dir), 5)
    return table_.select("model", F.lit(5).alias("folds"), (F.col("accuracy") > 0.25).alias("beats_chance"))


def prepared(spark, sf_dir) -> DataFrame:
    """Features, label and fold of each document, written: fits keep copies of their own, for which the memory is left."""
    rows = language_rows(spark, sf_dir)
    data = features.feature_stages(size=HASH_SLOTS).fit(rows).transform(rows).select("doc_id", "label", "features")
    return written(models.with_folds(data, 5, 47, ["doc_id"]), "folds")


# --- land use: features of parts, the label never among them ---------------------------------

LAND_COLUMNS = ["p_brand", "p_size", "p_retailprice"]


def land_rows(spark, sf_dir) -> DataFrame:
    """Labelled parts with holes: some have no brand, others no size. Written once and dealt evenly, because
    splitting, filling and balancing scan them some twenty times and parts may lie in one file."""
    parts = table(spark, sf_dir, "part")
    labelled = landuse.labels(parts.select(
        "p_partkey", F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double")).alias("p_size"), "p_retailprice",
        F.concat_ws(" ", "p_name", "p_type").alias("plu_description")), uses=PRODUCT_USES)
    labelled = written(spread(labelled.select("p_partkey", *LAND_COLUMNS, "label")), "land")
    return sampling.split(labelled, ["label"], 0.75, 37, ["p_partkey"])


LAND_SQL = f"""d AS (SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS p_size,
  p_retailprice, p_name || ' ' || p_type AS d FROM part),
land AS (SELECT p_partkey, p_brand, p_size, p_retailprice, CASE {_CASES} END AS label FROM d WHERE {_FLAGS} = 1),
flagged AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {md5_place(37, "p_partkey")}) <= round_even(0.75 * count(*) OVER (PARTITION BY label), 0) AS in_train FROM land),
train AS (SELECT * FROM flagged WHERE in_train),
brands AS (SELECT p_brand, count(*) AS n FROM train WHERE p_brand IS NOT NULL GROUP BY 1),
fills AS (SELECT (SELECT p_brand FROM brands ORDER BY n DESC, p_brand LIMIT 1) AS brand, (SELECT quantile_cont(p_size, 0.5) FROM train) AS size),
filled AS (SELECT p_partkey, coalesce(p_brand, brand) AS p_brand, coalesce(p_size, size) AS p_size, p_retailprice, CAST(p_size IS NULL AS DOUBLE) AS p_size_missing, in_train, label FROM flagged, fills)"""


def filled_land(spark, sf_dir) -> DataFrame:
    rows = land_rows(spark, sf_dir)
    return features.filled(rows, LAND_COLUMNS, features.learn_fills(rows.where("in_train"), LAND_COLUMNS))


@register("imputed_features", f"WITH {LAND_SQL} SELECT p_partkey, p_brand, p_size, p_size_missing FROM filled")
def imputed_features(spark, sf_dir):
    return filled_land(spark, sf_dir).select("p_partkey", "p_brand", "p_size", "p_size_missing")


@register("scaled_features", f"""WITH {LAND_SQL}, m AS (SELECT avg(p_size) AS a, stddev_samp(p_size) AS s, avg(p_retailprice) AS b, stddev_samp(p_retailprice) AS t FROM filled WHERE in_train)
SELECT p_partkey, round((p_size - a) / s, 6) AS size_scaled, round((p_retailprice - b) / t, 6) AS price_scaled FROM filled, m""")
def scaled_features(spark, sf_dir):
    rows = filled_land(spark, sf_dir)
    fitted = features.land_use_pipeline(rows, LAND_COLUMNS, models.forest(1, "label_index", numTrees=1, maxDepth=1))
    stages = type(fitted)(stages=fitted.getStages()[:2]).fit(rows.where("in_train"))
    scaled = vector_to_array("_scaled")
    return stages.transform(rows).select("p_partkey", F.round(scaled[0], 6).alias("size_scaled"), F.round(scaled[1], 6).alias("price_scaled"))


@register("one_hot_unknown", f"""WITH {LAND_SQL}, shown AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND NOT in_train THEN 'never seen' ELSE p_brand END AS p_brand FROM filled),
seen AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS place, count(*) OVER () AS places FROM filled WHERE in_train GROUP BY 1)
SELECT p_partkey, CAST((SELECT max(places) FROM seen) AS INTEGER) AS places, CAST(coalesce(place, -1) AS INTEGER) AS place FROM shown LEFT JOIN seen USING (p_brand)""")
def one_hot_unknown(spark, sf_dir):
    """The slot of each part's brand; brands not seen in training have none."""
    rows = filled_land(spark, sf_dir)
    fitted = features.land_use_pipeline(rows, ["p_brand"], models.forest(1, "label_index", numTrees=1, maxDepth=1))
    stages = type(fitted)(stages=fitted.getStages()[:2]).fit(rows.where("in_train"))
    shown = rows.withColumn("p_brand", F.when((F.col("p_partkey") % 3 == 0) & ~F.col("in_train"), "never seen").otherwise(F.col("p_brand")))
    hot = vector_to_array("p_brand_hot")
    return stages.transform(shown).select("p_partkey", F.size(hot).alias("places"), (F.array_position(hot, 1.0) - 1).cast("int").alias("place"))


def balanced_land(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Filled training parts with every class brought to the median class size, and the others."""
    rows = written(filled_land(spark, sf_dir), "filled")  # counted, sampled, drawn from and scored
    train = rows.where("in_train").drop("in_train")
    counts = profile.class_counts(train, "label")
    middle = counts.agg(F.bround(F.percentile("n", 0.5)).cast("bigint")).scalar()
    even = sampling.resample(train, "label", counts.select("label", middle.alias("target")), 37, ["p_partkey"])
    return even, rows.where("NOT in_train")


@register("land_use_forest", f"WITH {LAND_SQL} SELECT label AS class, count(*) AS support, true AS all_scored FROM filled WHERE NOT in_train GROUP BY 1")
def land_use_forest(spark, sf_dir):
    """Land-use labels from brand, size and price, classes first balanced. The description, from
    which the label is read, is no feature."""
    even, rest = balanced_land(spark, sf_dir)
    with kept(even) as even:
        model = features.land_use_pipeline(even, LAND_COLUMNS, models.forest(1, "label_index", numTrees=10, maxDepth=5)).fit(even)
    labels = F.array(*[F.lit(v) for v in model.stages[-3].labels])
    named = model.transform(rest).select("label", F.get(labels, F.col("prediction").cast("int")).alias("prediction"))
    with kept(evaluate.report(evaluate.confusion(named))) as report:
        n = report.where("class = 'accuracy'").first()["support"]
        return spark.createDataFrame(
            [(r["class"], r["support"], n == rest.count()) for r in report.where("class NOT LIKE '% avg' AND class <> 'accuracy' AND support > 0").collect()],
            "class string, support long, all_scored boolean")


#: What is tried: the whole boosted grid, as often and over as many folds as ``search_boosted`` has it by default.
SEARCH_GRID, SEARCH_DRAWS, SEARCH_FOLDS, SEARCH_SEED = models.BOOSTING_GRID, 50, 5, 41


@register("random_search", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{p}', {SEARCH_DRAWS}, {SEARCH_FOLDS}, true)" for i, p in enumerate(
        str(p).replace("'", "") for p in models.draws(SEARCH_GRID, SEARCH_DRAWS, SEARCH_SEED)))
    + ") t(draw, params, draws, folds, reaches_majority)")
def random_search(spark, sf_dir):
    """Seeded draws of a boosted grid by stratified folds over features prepared once. Draws that differ in
    rounds share a fit; each must reach the share of the largest class."""
    data = prepared(spark, sf_dir)
    found = models.search_boosted(data, SEARCH_GRID, n=SEARCH_DRAWS, folds=SEARCH_FOLDS, seed=SEARCH_SEED)
    majority = profile.class_shares(data, "label").agg(F.max("share")).first()[0]
    return spark.createDataFrame(
        [(i, str(p).replace("'", ""), SEARCH_DRAWS, SEARCH_FOLDS, m >= majority) for i, (p, m) in enumerate(found)],
        "draw int, params string, draws int, folds int, reaches_majority boolean")
