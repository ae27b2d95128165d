"""Source divergence against a plain sum over all terms."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from zoneflow.llm import divergence

from .conftest import frame

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top):
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, source = ((r[2] if len(r) > 2 else None) or ""), ((r[3] if len(r) > 3 else None) or "")
        terms = [t.translate(UP) for t in TERM.findall(r[1] or "")]
        docs[lang].update(set(terms))
        groups[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: c for (g, s), c in groups.items() if g == lang}
        every = sum(own.values(), Counter())

        def p_of(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // q

        ps, lang_p = {s: p_of(c) for s, c in own.items()}, p_of(every)
        for s, p in ps.items():
            pairs = [("pair", o, sum(f(p[t], q[t]) for t in kept)) for o, q in ps.items() if o != s]
            terms = [("term", t, f(p[t], lang_p[t])) for t in kept if own[s][t] and p[t] > lang_p[t]]
            for part, limit in ((pairs, None), (terms, top)):
                part = sorted(part, key=lambda x: (-x[2], x[1].encode()))[:limit]
                out += [(lang, s, *x, i + 1) for i, x in enumerate(part)]
    return sorted(out)


def check(spark, rows, least=3, top=200, slice_postings=500_000):
    got = divergence.divergence(frame(spark, rows), least, top, slice_postings)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


@pytest.mark.parametrize("least, top, slice_postings", [(1, 200, 500_000), (3, 2, 50), (2, 3, 7)])
def test_messy_rows(spark, messy_rows, least, top, slice_postings):
    check(spark, messy_rows, least, top, slice_postings)


def test_many_sources_with_ties(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{'x' * (i % 5)}{chr(97 + i % 26)}É" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocab, rng.integers(0, 12))), "de" if i % 3 else "en", f"s{i % 17}") for i in range(400)]
    check(spark, rows, slice_postings=100)


def test_a_language_without_kept_terms(spark):
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, "", "en", "c"), (4, "lonely", "fr", "a")]
    check(spark, rows)


def test_tasks_hand_on_early(spark, messy_rows, monkeypatch):
    whole = divergence.postings(frame(spark, messy_rows)).groupBy("lang", "source", "term").sum("n", "docs").collect()
    monkeypatch.setattr(divergence, "HELD", 3)
    held = divergence.postings(frame(spark, messy_rows)).groupBy("lang", "source", "term").sum("n", "docs").collect()
    assert sorted(map(tuple, whole), key=repr) == sorted(map(tuple, held), key=repr)


def test_nothing(spark):
    assert divergence.divergence(frame(spark, [])).count() == 0
