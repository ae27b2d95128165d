"""Language identification: rules and held-out accuracy. LM scoring: against plain Python."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import language_id, lm_scoring
from zoneflow.llm.common import words

from .conftest import frame


def test_grams():
    assert len(language_id.grams("Ab")) == 2 + 3 + 2 and not len(language_id.grams("12 !")) and not len(language_id.grams(None))
    assert sorted(language_id.grams("a1b").tolist()) == sorted(language_id.grams("A  b!").tolist())


def brute_profile(text, size):
    found = Counter()
    for w in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        w = [0, *map(ord, w), 0]
        for n in (1, 2, 3):
            found.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1) if n > 1 or w[i])
    return found


def test_profile_is_by_frequency():
    text = "the cat sat on the mat, the end"
    n = brute_profile(text, 10)
    assert len(set(language_id.grams(text).tolist())) == len(n)
    assert len(language_id.grams(text)) == sum(n.values())
    top = language_id.profile(text, 1)
    assert top[0] == ord("t")


def test_messy_rows(spark, messy_rows):
    docs = frame(spark, messy_rows)
    got = language_id.language_id(docs, docs.where(~language_id.held_out())).collect()
    assert len(got) == len(messy_rows)
    for r in got:
        assert 0 <= r["score"] <= 1
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[2] == by[3] == by[4] == by[8] == "und" and by[1] == "en"


def ranked(found, size):
    """N-grams by frequency; of equal ones those of three first, then single letters, then pairs."""
    return sorted(found, key=lambda g: (-found[g], (3, 1, 2).index(len(g)), g))[:size]


def brute_languages(rows, size):
    """Out-of-place distances of every document, gram by gram, ties to the first language."""
    counts = {}
    for i, t, lang in rows:
        if lang is not None and (i is None or zlib.crc32(str(i).encode()) % 3 != 1):
            counts.setdefault(lang, Counter()).update(brute_profile(t or "", size))
    learned = {lang: {g: k for k, g in enumerate(ranked(n, size))} for lang, n in sorted(counts.items()) if n}
    out = []
    for i, t, _ in rows:
        own = ranked(brute_profile(t or "", size), size)
        if not own:
            out.append((i, "und", 0.0))
            continue
        cost = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for lang, p in learned.items()}
        best = min(cost, key=lambda lang: (cost[lang], lang))
        out.append((i, best, 1 - cost[best] / (size * len(own))))
    return out


@pytest.mark.parametrize("size", [5, 40, language_id.SIZE])
def test_each_distance_against_plain_python(spark, size):
    rng = random.Random(size)
    sounds = {"en": "aeiothrsn", "de": "aeiüßchnr", "fr": "aeéèoulst", "ru": "абвгдежзи"}
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(sounds))
        text = " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 60)))
        rows.append((i if i % 29 else None, text.title() if i % 2 else f"{text} 12, !", None if i % 7 == 0 else lang))
    # equal profiles of two languages: the first wins
    rows += [(200, None, "en"), (201, "", "fr"), (202, "??", "zz"), (203, "a", "en"), (204, "日本語", "ja"), (205, "日本語", "jb"), (206, "日本語", None)]
    docs = frame(spark, rows)
    got = language_id.language_id(docs, docs.where(~language_id.held_out()), size).collect()
    order = lambda rs: sorted(((i, lang, round(x, 9)) for i, lang, x in rs), key=repr)
    assert order((r["doc_id"], r["lang_pred"], r["score"]) for r in got) == order(brute_languages(rows, size))


def test_nothing_learned(spark):
    docs = frame(spark, [(1, "some text"), (2, None)])
    assert {r["lang_pred"] for r in language_id.language_id(docs, docs).collect()} == {"und"}
    assert language_id.language_id(frame(spark, []), docs).count() == 0


def test_held_out_accuracy(documents):
    found = language_id.language_id(documents, documents.where(~language_id.held_out()))
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 30 and sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95


def brute_scores(rows, target, word_share, gram_share, mu):
    split = [(r[0], words(r[1])) for r in rows]
    uni = Counter(w for _, s in split for w in s)
    total = sum(uni.values())
    vocab = {w for w, n in uni.items() if n >= word_share * total}
    coded = [(i, ["<s>", *(w if w in vocab else "<unk>" for w in s)]) for i, s in split]
    size = len(vocab) + 2

    def model(ids):
        grams = Counter(g for i, s in coded if ids is None or i in ids for g in zip(s, s[1:], strict=False))
        n = sum(grams.values())
        first, last, kept, held = Counter(), Counter(), {}, Counter()
        for (v, w), c in grams.items():
            first[v] += c
            last[w] += c
            if c >= gram_share * n:
                kept[v, w] = c
                held[v] += c
        p1 = lambda w: (last[w] + 0.5) / (n + 0.5 * size)
        return lambda v, w: -math.log((kept.get((v, w), 0) + (first[v] - held[v] + mu) * p1(w)) / (first[v] + mu))
    t, b = model(target), model(None)
    out = []
    for i, s in coded:
        g = list(zip(s, s[1:], strict=False))
        a, c = (sum(m(*x) for x in g) / len(g) if g else None for m in (t, b))
        out.append((i, len(g), a, c, a - c if g else None))
    return out


@pytest.mark.parametrize("target", [[(1, 1), (5, 1), (5, 1), (None, 1), (77, 1)], []])
def test_scores(spark, messy_rows, target):
    marks = spark.createDataFrame(target, "doc_id long, n int")
    got = lm_scoring.score(frame(spark, messy_rows), marks, 0.001, 0.002).collect()
    want = brute_scores(messy_rows, {i for i, _ in target if i is not None}, 0.001, 0.002, 10.0)
    key = lambda r: repr((r[0], r[1], round(r[2] or 0, 6)))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:2] == w[:2]
        assert g[2:] == pytest.approx(w[2:]) if g[1] else g[2:] == (None, None, None)


@pytest.mark.parametrize("sizes", [{}, {"slice_tokens": 7, "bucket_keys": 5}, {"slice_tokens": 1, "bucket_keys": 1}])
@pytest.mark.parametrize("target", [[(1, 1), (5, 1), (5, 1), (None, 1), (77, 1)], []])
def test_every_word_and_bigram_counts(spark, messy_rows, target, sizes):
    """No word and no bigram is cut, however documents and hashes are dealt."""
    marks = spark.createDataFrame(target, "doc_id long, n int")
    rows = [*messy_rows, (1, "another text of one id, the cat sat")]
    got = lm_scoring.score(frame(spark, rows), marks, **sizes).collect()
    want = brute_scores(rows, {i for i, _ in target if i is not None}, 0, 0, 10.0)
    key = lambda r: repr((r[0], r[1], round(r[2] or 0, 6)))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:2] == w[:2]
        assert g[2:] == pytest.approx(w[2:]) if g[1] else g[2:] == (None, None, None)


def test_probabilities_sum_to_one(spark, messy_rows):
    docs = frame(spark, messy_rows)
    vocab = lm_scoring.vocabulary(docs, 0.01)
    counts = lm_scoring.bigram_counts(docs, docs.where("doc_id = 5"), spark.sparkContext.broadcast(vocab)).cache()
    import numpy as np
    size = len(vocab) + 2
    for column in ("n", "t"):
        m = lm_scoring.learn(counts, size, column, 0.01, 10.0)
        for v in (0, 1, 2, size - 1):
            assert np.exp(-m.losses((np.int64(v) << np.int64(32)) | np.arange(size))).sum() == pytest.approx(1)


def test_scores_of_nothing(spark):
    empty = frame(spark, [])
    assert lm_scoring.score(empty, empty).count() == 0


def test_target_documents_score_lower(documents):
    target = documents.where("lang = 'de'")
    means = {r["de"]: r["m"] for r in lm_scoring.score(documents, target).join(documents.select("doc_id", (F.col("lang") == "de").alias("de")), "doc_id")
             .groupBy("de").agg(F.avg("score").alias("m")).collect()}
    assert means[True] < means[False]
