"""Fingerprints, trie walk, groups and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from zoneflow.llm import components, simhash

from .conftest import frame


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(ids_fps):
    root = {f: f for _, f in ids_fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fps = sorted(root)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i, f in ids_fps:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [(i, f, least.get(find(f))) for i, f in ids_fps]


def near(rng, n, bits):
    """Random fingerprints and copies of them with some bits flipped, in both halves."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for f in list(out[: n // 2]):
        for _ in range(3):
            out.append(f ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(bits))}))
    return sorted(set(out))


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_fingerprints(messy_rows):
    for r in messy_rows[:6] + messy_rows[9:]:
        assert simhash.fingerprint(r[1]) == brute_fingerprint(r[1])


def test_messy_groups(spark, messy_rows):
    rows = messy_rows + [(50, "  "), (40, None)]
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.simhash_groups(frame(spark, rows)).collect()]
    assert order(got) == order(brute_groups([(r[0], brute_fingerprint(r[1])) for r in rows]))


def test_given_documents(spark, documents):
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.simhash_groups(documents).collect()]
    assert order(got) == order(brute_groups([(r["doc_id"], brute_fingerprint(r["text"])) for r in documents.collect()]))


def test_empty(spark):
    assert simhash.simhash_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_walk_finds_every_pair(dense, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 50)
    rng = random.Random(4)
    fps = near(rng, 200, 5)
    if dense:
        fps = sorted({fps[0] ^ sum(1 << rng.randrange(12) for _ in range(4)) & (2**64 - 1) for _ in range(300)})
    bits = np.array(fps, np.uint64)
    want = {(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 3 and ((fps[i] ^ fps[j]) >> 32).bit_count() <= 1}
    got = [(a, b) for i, j in simhash.walk(bits, None, 0, 0, 3) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("capacity", [20, 100_000])
def test_links_connect_all(spark, capacity):
    """Small capacity: many subtrees and, in the dense part, several blocks of one subtree."""
    rng = random.Random(7)
    fps = near(rng, 150, 5)
    fps = sorted({*fps, *(0xABCD << 40 ^ sum({1 << rng.randrange(20) for _ in range(3)}) for _ in range(150))})
    table = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    links = simhash.forest_links(table, capacity=capacity)
    found = {r["node"]: r["component"] for r in components.components(links).collect()}
    mine = {}
    for f in fps:
        s = f - 2**64 if f >= 2**63 else f
        mine.setdefault(found.get(s, s), set()).add(f)
    want = {}
    for i, f, c in brute_groups(list(enumerate(fps))):
        want.setdefault(c, set()).add(f)
    assert {frozenset(x) for x in mine.values()} == {frozenset(x) for x in want.values()}


def test_components_of_paths_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
