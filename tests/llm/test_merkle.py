"""The manifest against a plain tree."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import merkle

from .conftest import frame


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree_of(nodes):
    """The root and each leaf's (sibling, whether the leaf's side is the right one) from below."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            path.append((nodes[i ^ 1] if i ^ 1 < len(nodes) else "", i % 2))
        at = [i // 2 for i in at]
        nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute(rows, touched):
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        fields = [i, source, lang, n, text]
        now = [*fields[:3], n + 1 if n is not None and touched(i) else n, text]
        groups[lang].append((i, leaf_of(fields), leaf_of(now)))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = tree_of([r[1] for r in groups[g]])
    root, over = tree_of([trees[g][0] for g in langs]) if langs else (None, [])
    out = []
    for g, above in zip(langs, over, strict=True):
        for (i, leaf, now), path in zip(groups[g], trees[g][1], strict=True):
            path = path + above
            for sibling, right in path:
                now = digest(sibling, now) if right else digest(now, sibling)
            out.append((i, leaf, trees[g][0], root, digest(*[s for s, _ in path]), now, now == root))
    return out


def full(rows):
    return [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]


def found(docs):
    got = merkle.audited(docs, F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)))
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def third(i):
    return i is not None and i % 3 == 0


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2}, {None: 3}, {"en": 700, "de": 1, None: 5, "": 256, "é": 257}])
def test_trees(spark, sizes):
    rows = [(100 * k + i, f"text {i} {g}", g, "s") for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    assert found(frame(spark, rows)) == sorted(brute(full(rows), third), key=repr)


def test_messy_rows(spark, messy_rows):
    # many copies of one row, which lie side by side over several blocks
    rows = messy_rows + [(7, "copies", "en", "a")] * 900 + [(None, None, "en", "a")] * 300
    assert found(frame(spark, rows)) == sorted(brute(full(rows), third), key=repr)


def test_null_fields(spark):
    rows = [(3, "a", "en", None, None), (6, None, None, "x", 4), (9, "b", "en", "y", 1), (12, "-", "en", "-", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(docs) == sorted(brute(rows, third), key=repr)


def test_nothing(spark):
    assert found(frame(spark, [])) == []


def test_a_wrong_level_is_noticed(spark):
    docs = frame(spark, [(i, f"t{i}", "en", "s") for i in range(40)])
    assert merkle.manifest(docs, "lang", "doc_id", merkle.FIELDS).where("verified").count() == 40
    other = merkle.manifest(docs, "lang", "doc_id", merkle.FIELDS, F.sha2(F.lit("x"), 256))
    assert other.where("verified").count() == 0
