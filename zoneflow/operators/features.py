"""Feature columns and pyspark.ml stages for the line and land-use classifiers."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import (
    HashingTF, Normalizer, OneHotEncoder, StandardScaler,
    StopWordsRemover, StringIndexer, VectorAssembler,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions import text as tx
from zoneflow.functions.stats import exact_percentiles
from zoneflow.operators import sampling
from zoneflow.plans.rules import LABEL_CODES
from zoneflow.session import checked_broadcast, nan_to_null, shared_path, tidied, written

# Functions travel whole, so that workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NUMERIC_FEATURES = ["city_share", "char_count", "word_count", "avg_word_length"]


def stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def lemmatised(df: DataFrame, lemmas: DataFrame, key: list[str], tokens: str = "tokens") -> DataFrame:
    """``tokens`` with each word that the table (word, lemma) lists in lower case replaced by its lemma.

    Each distinct word is looked up once: words combine before the shuffle, so a frequent one is one row,
    and only rows that hold a listed word have their words put together again: the stretches between lemmas are
    cut out in order, so the time grows with the words of a row. Rows are read
    several times, so costly ones should be ``written`` first. ``key`` must identify rows. A word listed more than once takes its least lemma.
    """
    table = lemmas.select(F.lower("word").alias("_word"), F.col("lemma").alias("_lemma")).where("_word is not null")
    table = table.groupBy("_word").agg(F.min("_lemma").alias("_lemma"))
    each = df.select(*key, F.posexplode(tokens).alias("_pos", "_token")).withColumn("_word", F.lower("_token"))
    used = each.select("_word").distinct().join(table, "_word")
    found = each.select(*key, "_pos", "_word").join(checked_broadcast(used), "_word")
    per_row = found.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_lemma"))).alias("_found"))

    def end(i: Column) -> Column:
        """Words up to and with the lemma before the i-th."""
        return F.when(i > 0, F.get("_found", i - 1)["_pos"] + 1).otherwise(0)

    # A repeated key repeats a position, which makes a length negative and fails the job.
    stretch = F.transform("_found", lambda x, i: F.concat(
        F.slice(tokens, end(i) + 1, x["_pos"] - end(i)),
        F.array(F.coalesce(x["_lemma"], F.get(tokens, x["_pos"])))))
    last = F.element_at("_found", -1)["_pos"]
    put = F.concat(F.flatten(stretch), F.slice(tokens, last + 2, F.size(tokens)))
    joined = df.join(per_row, key, "left")
    return joined.withColumn(tokens, F.when(F.col("_found").isNull(), F.col(tokens)).otherwise(put)).select(*df.columns)


def text_stats(df: DataFrame, column: str = "context", stop: list[str] | None = None,
               lemmas: DataFrame | None = None, key: list[str] | None = None) -> DataFrame:
    """``tokens`` plus characters (spaces included), words and characters per word of the
    text left after punctuation and stop words. ``lemmas`` (word, lemma) needs the rows' ``key``."""
    words = df.withColumn("tokens", F.coalesce(tx.words(column, stop), F.array().cast("array<string>")))
    return (
        (words if lemmas is None else lemmatised(words, lemmas, key))
        .withColumn("char_count", F.length(F.array_join("tokens", " ")))
        .withColumn("word_count", F.size("tokens"))
        .withColumn("avg_word_length", F.try_divide("char_count", "word_count"))
    )


def city_frequency(df: DataFrame, column: str = "city") -> DataFrame:
    """(column, n, share), one scan; the raw counts are worth keeping beside the model."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def encode_frequency(df: DataFrame, frequency: DataFrame, column: str = "city",
                     out: str = "city_share") -> DataFrame:
    """Replace a category by its share; one unseen when fitted gets null."""
    return df.join(checked_broadcast(frequency.select(column, F.col("share").alias(out))), column, "left")


def encode_label(column: str = "attribute", codes: dict[str, int] = LABEL_CODES) -> Column:
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.element_at(table, F.col(column))


def decode_label(column: str = "prediction", codes: dict[str, int] = LABEL_CODES) -> Column:
    table = F.create_map(*[F.lit(x) for name, code in codes.items() for x in (code, name)])
    return F.element_at(table, F.col(column).cast("int"))


def characters(c: Column | str) -> Column:
    """Characters of a text as tokens, the alternative to words."""
    return F.filter(F.split(c, ""), lambda x: x != "")


def token_stages(kind: str = "hash", size: int = 1 << 18, column: str = "tokens") -> list:
    """Sparse token vectors: hashed to ``size`` slots and length-normalised, or those that the rows have
    from ``counted``."""
    if kind == "hash":
        return [HashingTF(inputCol=column, outputCol="_tf", numFeatures=size),
                Normalizer(inputCol="_tf", outputCol="token_vector", p=2.0)]
    if kind == "count":
        return []
    raise ValueError(f"kind must be 'hash' or 'count', not {kind!r}")


def vocabulary(rows: DataFrame, column: str = "tokens") -> DataFrame:
    """(token, rows) of all words, by the rows that hold them."""
    return rows.select(F.explode(F.array_distinct(column)).alias("token")).groupBy("token").agg(F.count("*").alias("rows"))


def token_counts(rows: DataFrame, key: str, words: DataFrame, column: str = "tokens") -> DataFrame:
    """(key, token, n) for the words of a vocabulary, however long it is."""
    counts = rows.select(key, F.explode(column).alias("token")).groupBy(key, "token").agg(F.count("*").alias("n"))
    return counts.join(words.select("token"), "token", "left_semi").select(key, "token", "n")


def numbered(words: DataFrame) -> DataFrame:
    """(token, slot): each word of a vocabulary with its own number from 0, by the hash of the word. Numbers
    add up bucket offsets, so no task and not the driver sees all words."""
    return sampling.ranked(words.select("token"), [], 0, ["token"]).select("token", F.col("rank").cast("int").alias("slot"))


def counted(rows: DataFrame, key: str, words: DataFrame, column: str = "tokens", out: str = "token_vector",
            keep_words: bool = True) -> DataFrame:
    """Rows with a sparse vector that counts their words, one slot for each word of the vocabulary, and without
    ``column`` unless ``keep_words``.

    Rows are coded in blocks, and a block asks once for the number of each of its words, so what moves is a block's
    words and a row's codes. They are written to the shared folder, in the form that vectors have there.
    A word outside the vocabulary counts nowhere; a row without words or with a null key has a vector of zeros, and
    rows of one key have the counts of all of them.
    """
    spark = rows.sparkSession
    with tidied(spark):
        words = written(words.select("token"), "vocabulary", "zstd")  # counted and ranked
        numbers, n_words = written(numbered(words), "numbers", "zstd"), words.count()
        path = shared_path(spark, "vectors")
        fields = [f for f in rows.schema.fields if keep_words or f.name != column]
        twice = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
        alone = rows
        if not twice.isEmpty():
            alone = rows.join(twice, key, "left_anti").select(*rows.columns)
            _counted_by_key(rows.join(twice, key, "left_semi").select(*rows.columns), key, numbers, n_words, column, out).select(
                *[f.name for f in fields], out).write.option("compression", "zstd").parquet(path)
        coded = written(_coded(alone, key, column, fields), "coded", "zstd")
        asked = coded.where(F.size("_dictionary") > 0).select(F.col("_block").alias("_asking"), F.posexplode("_dictionary").alias("_code", "token"))
        known = asked.join(numbers, "token").select("_asking", "_code", "slot")
        _vectors(coded, known, fields, n_words, out).write.option("compression", "zstd").mode("append").parquet(path)
    return spark.read.schema(T.StructType([*fields, T.StructField(out, VectorUDT())])).parquet(path)


_SPARSE = T.StructType([T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
                        T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))])


def _counted_by_key(rows: DataFrame, key: str, numbers: DataFrame, n_words: int, column: str, out: str) -> DataFrame:
    """``counted`` where several rows share a key: counts are added up by key and word."""
    counts = rows.select(key, F.explode(column).alias("token")).groupBy(key, "token").agg(F.count("*").cast("double").alias("n"))
    slots = counts.join(numbers, "token").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("slot", "n"))).alias("_slots"))
    sparse = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(n_words).cast("int").alias("size"),
        F.coalesce(F.col("_slots.slot"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("_slots.n"), F.array().cast("array<double>")).alias("values"))
    return rows.join(slots, key, "left").select(*rows.columns, sparse.alias(out))


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values, kind))


def _coded(rows: DataFrame, key: str, column: str, fields: list[T.StructField], block_words: int = 1 << 21) -> DataFrame:
    """Rows with ``_codes`` and ``_counts`` of their words. Codes are places in the ``_dictionary`` of their ``_block``, which
    its first row has. A block is a part of a batch, of ``block_words`` words or one row."""
    names = [f.name for f in fields]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            upto = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("_words")).fill_null(0).to_numpy(zero_copy_only=False))])
            at = 0
            while at < batch.num_rows:
                n = max(1, int(np.searchsorted(upto, upto[at] + block_words, "right")) - 1 - at)
                part = batch.slice(at, n)
                n = part.num_rows
                flat = part.column("_words").flatten().dictionary_encode()
                real = flat.indices.is_valid().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(n, dtype=np.int64), np.diff(upto[at:at + n + 1]))[real]
                size = max(1, len(flat.dictionary))
                found, counts = np.unique(row * size + flat.indices.drop_null().to_numpy(), return_counts=True)
                lengths = np.bincount(found // size, minlength=n)
                first = np.zeros(n, np.int64)
                first[0] = len(flat.dictionary)
                dictionary = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(first)]), pa.int32()), flat.dictionary)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(np.full(n, block)), _lists(found % size, lengths, pa.int32()),
                     _lists(counts, lengths, pa.int32()), dictionary], [*names, "_block", "_codes", "_counts", "_dictionary"])
                at, block = at + n, block + 1

    own = F.when(F.col(key).isNotNull(), F.col(column)).alias("_words")
    return rows.select(*names, own).mapInArrow(code, T.StructType([
        *fields, T.StructField("_block", T.LongType()), T.StructField("_codes", T.ArrayType(T.IntegerType())),
        T.StructField("_counts", T.ArrayType(T.IntegerType())), T.StructField("_dictionary", T.ArrayType(T.StringType()))]))


def _vectors(coded: DataFrame, known: DataFrame, fields: list[T.StructField], n_words: int, out: str) -> DataFrame:
    """Rows of ``_coded`` with their vectors, by the numbers (``_asking``, ``_code``, ``slot``) of words in the vocabulary."""
    names = [f.name for f in fields]

    def vectors(rows: pa.Table, known: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        lengths = pc.list_value_length(rows["_codes"]).to_numpy()
        codes, counts = (pc.list_flatten(rows[c]).to_numpy() for c in ("_codes", "_counts"))
        slot_of = np.full(int(codes.max(initial=-1)) + 1, -1, np.int32)
        if known.num_rows:
            slot_of[known["_code"].to_numpy()] = known["slot"].to_numpy()
        slots, row = slot_of[codes], np.repeat(np.arange(len(lengths)), lengths)
        order = np.flatnonzero(slots >= 0)
        order = order[np.lexsort((slots[order], row[order]))]
        lengths = np.bincount(row[order], minlength=len(lengths))
        sparse = pa.StructArray.from_arrays(
            [pa.array(np.zeros(len(lengths), np.int8)), pa.array(np.full(len(lengths), n_words, np.int32)),
             _lists(slots[order], lengths, pa.int32()), _lists(counts[order], lengths, pa.float64())], _SPARSE.names)
        return pa.table([*[rows[c] for c in names], sparse], [*names, out])

    return coded.drop("_dictionary").groupBy("_block").cogroup(known.groupBy("_asking")).applyInArrow(
        vectors, T.StructType([*fields, T.StructField(out, _SPARSE)]))


class Assembler(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Number columns and, last, a vector column as one sparse vector. Spark's own assembler describes every slot on
    the driver and in the schema, which a vocabulary outgrows; here a slot has no description. A missing number fails the job."""

    def __init__(self, inputCols: list[str] | None = None, outputCol: str | None = None):
        super().__init__()
        if inputCols:
            self._set(inputCols=inputCols, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        *numbers, vector = self.getInputCols()
        v, n = F.unwrap_udt(vector), len(numbers)
        none = F.array().cast("array<int>")
        at = F.coalesce(v["indices"], F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(none))
        missing = reduce(or_, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in numbers], F.col(vector).isNull())
        sparse = F.struct(
            F.lit(0).cast("byte").alias("type"), (F.coalesce(v["size"], F.size(v["values"])) + n).alias("size"),
            F.concat(F.array(*[F.lit(i) for i in range(n)]).cast("array<int>"), F.transform(at, lambda i: i + n)).alias("indices"),
            F.concat(F.array(*[F.col(c).cast("double") for c in numbers]).cast("array<double>"), v["values"]).alias("values"))
        whole = F.when(missing, F.raise_error(F.lit("null or NaN in a row to assemble")).cast(_SPARSE)).otherwise(sparse)

        def typed(vectors: pa.Array) -> pa.Array:
            return vectors

        return dataset.withColumn(self.getOutputCol(), F.arrow_udf(typed, VectorUDT())(whole))


def feature_stages(kind: str = "hash", size: int = 1 << 18) -> Pipeline:
    """City share, text statistics and token vector as ``features``. The numbers must be filled
    (``fill_numbers``): a missing one fails the job rather than dropping its row."""
    assemble = Assembler(inputCols=[*NUMERIC_FEATURES, "token_vector"], outputCol="features")
    return Pipeline(stages=[*token_stages(kind, size), assemble])


def scaled_stages(kind: str = "hash", size: int = 1 << 18) -> Pipeline:
    """``feature_stages`` with the features scaled to unit deviation; sparse vectors stay sparse."""
    assembled = [*token_stages(kind, size), Assembler(inputCols=[*NUMERIC_FEATURES, "token_vector"], outputCol="_assembled")]
    return Pipeline(stages=[*assembled, StandardScaler(inputCol="_assembled", outputCol="features", withMean=False)])


def line_pipeline(estimator, kind: str = "hash", size: int = 1 << 18) -> Pipeline:
    return Pipeline(stages=[*feature_stages(kind, size).getStages(), estimator])


def fill_numbers(rows: DataFrame) -> DataFrame:
    """A city unseen in training has share 0, an empty text average word length 0."""
    return rows.fillna(0.0, ["avg_word_length", "city_share"])


def line_features(rows: DataFrame, frequency: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """Training rows (city, attribute, context) with numeric features and integer ``label``."""
    featured = text_stats(encode_frequency(rows, frequency), "context", stop)
    return fill_numbers(featured).withColumn(
        "label", encode_label().cast("double")
    )


def _typed(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    return tuple([c for c in features if isinstance(df.schema[c].dataType, kind)] for kind in (T.NumericType, T.StringType))


def learn_fills(train: DataFrame, features: list[str]) -> dict:
    """Exact median of each number, most frequent value of each text (ties: the first one)."""
    numeric, text = _typed(train, features)
    fills = {c: v[0.5] for c, v in exact_percentiles(train, numeric, [0.5]).items()} if numeric else {}
    if text:
        values = train.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in text]))).where("v is not null")
        counts = values.groupBy("c", "v").agg(F.count("*").alias("n"))
        most = counts.groupBy("c").agg(F.max("n").alias("n"))
        fills |= {r["c"]: r["v"] for r in counts.join(most, ["c", "n"]).groupBy("c").agg(F.min("v").alias("v")).collect()}
    return {c: v for c, v in fills.items() if v is not None}


def filled(df: DataFrame, features: list[str], fills: dict) -> DataFrame:
    """Missing features filled, with a ``{c}_missing`` flag per number. A column that training
    never saw filled gets 0 or the empty text."""
    numeric, text = _typed(df, features)
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c, 0.0)).cast("double")) for c in numeric}
    value |= {c: F.coalesce(F.col(c), F.lit(fills.get(c, ""))) for c in text}
    df = nan_to_null(df)
    flags = [F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in numeric]
    return df.select(*[value[c].alias(c) if c in value else F.col(c) for c in df.columns], *flags)


def land_use_pipeline(df: DataFrame, features: list[str], estimator) -> Pipeline:
    """Typed from the schema of a ``filled`` table: numbers are scaled, with their flags beside
    them; texts are indexed and one-hot encoded, a value not seen in training as zeros."""
    numeric, text = _typed(df, features)
    stages: list = []
    inputs: list[str] = []
    if numeric:
        stages += [
            VectorAssembler(inputCols=numeric, outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
        inputs += ["_scaled", *[f"{c}_missing" for c in numeric]]
    if text:
        # The indexer gives unseen values the last place, and the encoder leaves the last one out.
        stages += [
            StringIndexer(inputCols=text, outputCols=[f"{c}_index" for c in text], handleInvalid="keep"),
            OneHotEncoder(inputCols=[f"{c}_index" for c in text], outputCols=[f"{c}_hot" for c in text], dropLast=True),
        ]
        inputs += [f"{c}_hot" for c in text]
    target = StringIndexer(inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc")
    return Pipeline(stages=[*stages, target, VectorAssembler(inputCols=inputs, outputCol="features"), estimator])
