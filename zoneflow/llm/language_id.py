"""Language identification by rank-order n-gram profiles (out-of-place distance).

A profile is the list of the ``size`` most frequent n-grams (n = 1, 2, 3) of lower-cased letters,
with word boundaries; of equally frequent ones those of three come first, then single letters, then pairs, each in
code-point order. A language's profile counts all its training
texts whole. A document's own profile, of its whole text, is compared with each language's: an
n-gram costs the difference of its two ranks, or ``size`` where the language lacks it. The language
with the least cost wins, ties going to the first in code-point order. The score is one minus
cost / greatest possible cost.

Counting combines per task, so the largest language does not weigh on one task. Profiles are at
most ``size`` rows a language. A text that is null or has no letter is ``und`` with score 0, as is
every text where nothing was learned. Rows are independent, repeated ones too; a document without an id
is learned from. An empty table gives an empty result, a text of any length counts whole, and columns not named
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import begin, map_arrow

#: Profile length; one value for languages and documents.
SIZE = 300
_SHIFT = np.int64(21)  # bits of a code point
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str | None) -> np.ndarray:
    """The codes of all n-grams of the text: up to three code points, 0 for a word boundary."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    c = np.where(_letters()[c], c, 0)
    c = np.concatenate([[0], c, [0]])
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    one = c[c != 0]
    if not len(one):
        return one
    two = (c[:-1] << _SHIFT) | c[1:]
    three = ((two[:-1] << _SHIFT) | c[2:])[c[1:-1] != 0]
    # the number of code points makes codes of different n differ
    return np.concatenate([one, two | (np.int64(1) << np.int64(42)), three | np.int64(-(2**63))])


def profile(text: str | None, size: int = SIZE) -> np.ndarray:
    codes, n = np.unique(grams(text), return_counts=True)
    return codes[np.argsort(-n, kind="stable")[:size]]


def learn(docs: DataFrame, size: int = SIZE) -> dict[str, list[int]]:
    """lang -> n-gram codes in order of rank, from the texts of docs with a lang."""
    begin(docs.sparkSession)

    def count(batch: pa.RecordBatch):
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            found = [grams(texts[i]) for i in np.flatnonzero(langs == lang)]
            codes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "gram": pa.array(codes), "n": pa.array(n)})

    rows = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    counts = map_arrow(rows, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    out: dict[str, list[int]] = {}
    for r in counts.withColumn("rank", rank).where(F.col("rank") <= size).orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Profiles:
    """Language profiles as one table: rank of each known n-gram in each language."""

    def __init__(self, learned: dict[str, list[int]], size: int = SIZE):
        self.langs, self.size = sorted(learned), size
        self.codes = np.unique(np.array([c for p in learned.values() for c in p], np.int64))
        self.rank = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.rank[i, np.searchsorted(self.codes, learned[lang])] = np.arange(len(learned[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = profile(text, self.size)
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        at = np.where(self.codes[at] == own, at, len(self.codes))
        rank = self.rank[:, at]
        cost = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own)))).sum(axis=1)
        best = int(cost.argmin())
        return self.langs[best], float(1 - cost[best] / (self.size * len(own)))


def predictor(spark: SparkSession, learned: dict[str, list[int]], size: int = SIZE):
    """A function of a text column: struct of lang_pred and score."""
    profiles = begin(spark).sparkContext.broadcast(Profiles(learned, size))

    @F.pandas_udf("lang_pred string, score double")
    def run(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.value.predict(t) for t in text], columns=["lang_pred", "score"])

    return run


def lettered(spark: SparkSession):
    """A function of a text column: whether it has a letter."""
    begin(spark)

    @F.pandas_udf("boolean")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([bool(len(grams(t))) for t in text], dtype=bool)

    return run


def language_id(docs: DataFrame, training: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs; nothing is shuffled."""
    found = predictor(docs.sparkSession, learn(training, size), size)
    return docs.select("doc_id", held_out().alias("held_out"), found("text").alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
