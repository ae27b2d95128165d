"""SimHash fingerprints and their near-duplicate groups by a binary trie self-join.

Fingerprints. Words are runs without ASCII white space, A-Z lower-cased; shingles are ``width``
words joined by one space, repeats included (fewer words: the whole sequence; none, or text None:
fingerprint zero, linked like any other). A bit is set if it is set in over half the shingles'
XXH64 (seed 42).

Join. The tries are walked over pairs of nodes from the root: a pair's children differ in one bit
more or none, and a pair is pruned once its differing bits exceed the budget. Of two fingerprints
within ``budget`` bits, either the upper or the lower halves differ in at most ``budget // 2``
bits; so the walk is done twice, over the bits in their order and with the halves swapped, and the
budget in the first half is ``budget // 2``. This keeps the frontier small.

Distribution. Copies collapse first: the join sees each distinct fingerprint once. The first
``top`` bits name a subtree; ``top`` follows from the number of fingerprints so that a subtree
holds an eighth of ``capacity`` on average. A fingerprint goes to the pairs of its subtree with
each subtree within the budget. A subtree over ``capacity`` is cut into blocks by hash and every
pair of blocks is a group of its own, so no group exceeds two blocks. Within a group the frontier
is walked in slices. Only a spanning forest of a group's links leaves it, so a dense group of
near copies sends at most as many links as it has members, and no connection is lost.

Groups link fingerprints only: rows with the same doc_id and different texts belong each to their own
text's group, and a shared id does not join the two.
doc_id must be an integer; a null doc_id gets a fingerprint and its group's smallest other id.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, map_arrow, settle, words
from .components import components

HALF, SLICE, LEAF = 32, 1 << 19, 16
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    line = b" ".join(w)
    if len(w) <= width:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = np.concatenate([[0], ends[:-width]]).tolist()
    h = xxhash.xxh64_intdigest
    return np.array([h(line[a:b], 42) for a, b in zip(starts, (ends[width - 1:] - 1).tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    h = shingle_hashes(text, width)
    if not len(h):
        return 0
    octets = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(h)).tolist())


def fingerprints(docs: DataFrame, width: int = 3, **also: Column) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) and the longs of ``also`` for each row."""
    begin(docs.sparkSession)
    names = list(also)

    def run(batch: pa.RecordBatch):
        fp = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(fp.view(np.int64)),
                                            **{c: batch.column(2 + i) for i, c in enumerate(names)}})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[e.cast("long").alias(c) for c, e in also.items()])
    return map_arrow(rows, run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *names)))


def _swap(fp: np.ndarray) -> np.ndarray:
    return (fp << np.uint64(HALF)) | (fp >> np.uint64(HALF))


class _Forest:
    """Smallest member of each joined set, for the members of one group."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def walk(left: np.ndarray, right: np.ndarray | None, depth: int, diff: int, budget: int):
    """Index pairs within the budget of two sorted arrays; right None: of left with itself.

    All of an array shares its first ``depth`` bits, and the two differ in ``diff`` of them.
    """
    own = right is None
    right = left if own else right
    stack = [(depth, *(np.array([x]) for x in (0, len(left), 0, len(right), diff)))]
    while stack:
        depth, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) > SLICE:
            half = len(a0) // 2
            stack += [(depth, *(x[s] for x in (a0, a1, b0, b1, diff))) for s in (slice(half, None), slice(half))]
            continue
        few = ((a1 - a0) * (b1 - b0) <= LEAF) | (depth == 64)
        if few.any():
            na, nb = (a1 - a0)[few], (b1 - b0)[few]
            ends = np.cumsum(na * nb)
            # the pairs of all small node pairs, a slice at a time
            for at in range(0, int(ends[-1]), SLICE):
                k = np.arange(at, min(at + SLICE, int(ends[-1])))
                pair = np.searchsorted(ends, k, "right")
                k = k - (ends - na * nb)[pair]
                i, j = a0[few][pair] + k // nb[pair], b0[few][pair] + k % nb[pair]
                x = left[i] ^ right[j]
                near = (np.bitwise_count(x) <= budget) & (np.bitwise_count(x >> np.uint64(HALF)) <= budget // 2)
                if own:
                    near &= i < j
                if near.any():
                    yield i[near], j[near]
            a0, a1, b0, b1, diff = (x[~few] for x in (a0, a1, b0, b1, diff))
        if not len(a0):
            continue
        bit = np.uint64(1) << np.uint64(63 - depth)
        above = ~(bit | (bit - np.uint64(1)))
        am = np.searchsorted(left, (left[a0] & above) | bit)
        bm = np.searchsorted(right, (right[b0] & above) | bit)
        am, bm = np.clip(am, a0, a1), np.clip(bm, b0, b1)
        most = budget // 2 if depth < HALF else budget
        kids = [(a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1), (am, a1, b0, bm, diff + 1)]
        if own:  # of a node with itself, the two crossed pairs are one
            same = (a0 == b0) & (a1 == b1)
            kids[3] = tuple(np.where(same, a0, x) if n < 2 else x for n, x in enumerate(kids[3]))
        kids = [np.concatenate(x) for x in zip(*kids, strict=True)]
        live = (kids[0] < kids[1]) & (kids[2] < kids[3]) & (kids[4] <= most)
        if live.any():
            stack.append((depth + 1, *(x[live] for x in kids)))


def _pairs(prefix: np.ndarray, top: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For each subtree, all subtrees within the budget: row numbers and the other's prefix."""
    flips = [sum(1 << b for b in c) for n in range(min(budget // 2, top) + 1) for c in combinations(range(top), n)]
    rows = np.repeat(np.arange(len(prefix)), len(flips))
    return rows, (prefix[:, None] ^ np.array(flips, np.int64)).ravel()


def forest_links(fps: DataFrame, budget: int = 3, capacity: int = 32_768) -> DataFrame:
    """a, b: links between the distinct fingerprints of fps that connect all within the budget."""
    spark = begin(fps.sparkSession)
    n = fps.count()
    top = max(1, min(HALF, math.ceil(math.log2(max(2, 8 * n / capacity)))))
    shift = np.uint64(64 - top)

    def prefixes(batch: pa.RecordBatch):
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_pydict({
            "turn": pa.array(np.repeat(np.arange(2, dtype=np.int32), len(fp))),
            "prefix": pa.array(np.concatenate([fp >> shift, _swap(fp) >> shift]).astype(np.int64))})

    # subtrees over capacity: at most 2 n / capacity rows
    heavy = (map_arrow(fps.select("fp"), prefixes, "turn int, prefix long").groupBy("turn", "prefix").count()
             .where(F.col("count") > capacity).collect())
    cut = spark.sparkContext.broadcast({(r["turn"], r["prefix"]): math.ceil(r["count"] / capacity) for r in heavy})

    def deal(batch: pa.RecordBatch):
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for turn in range(2):
            bits = _swap(fp) if turn else fp
            prefix = (bits >> shift).astype(np.int64)
            rows, other = _pairs(prefix, top, budget)
            own = prefix[rows]
            block, mine, theirs = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64), np.ones(len(rows), np.int64)
            if cut.value:
                mine = np.array([cut.value.get((turn, p), 1) for p in own.tolist()])
                theirs = np.array([cut.value.get((turn, p), 1) for p in other.tolist()])
                block = ((bits[rows] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % mine
            lower = own <= other
            each = np.repeat(np.arange(len(rows)), theirs)
            number = np.arange(len(each)) - np.repeat(np.cumsum(theirs) - theirs, theirs)
            low, up = np.where(lower, own, other)[each], np.where(lower, other, own)[each]
            x = np.where(lower[each], block[each], number)
            y = np.where(lower[each], number, block[each])
            twin = low == up
            x, y = np.where(twin, np.minimum(x, y), x), np.where(twin, np.maximum(x, y), y)
            first = np.where(twin, block[each] == x, lower[each])
            yield pa.RecordBatch.from_pydict({
                "turn": pa.array(np.full(len(each), turn, np.int32)), "low": pa.array(low), "up": pa.array(up),
                "x": pa.array(x.astype(np.int32)), "y": pa.array(y.astype(np.int32)), "first": pa.array(first),
                "bits": pa.array(bits[rows][each].view(np.int64))})

    def links(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        turn, low, up, x, y = key
        bits, first = group["bits"].to_numpy().view(np.uint64), group["first"].to_numpy()
        if low == up and x == y:
            left, right = np.sort(bits), None
        else:
            left, right = np.sort(bits[first]), np.sort(bits[~first])
        if not len(left) or right is not None and not len(right):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        members = left if right is None else np.concatenate([left, right])
        forest = _Forest(len(members))
        for i, j in walk(left, right, top, int(low ^ up).bit_count(), budget):
            forest.join(i, j if right is None else j + len(left))
        members = _swap(members) if turn else members
        child = np.flatnonzero(forest.root != np.arange(len(members)))
        return pd.DataFrame({"a": members[child].view(np.int64), "b": members[forest.root[child]].view(np.int64)})

    dealt = map_arrow(fps.select("fp"), deal, "turn int, low long, up long, x int, y int, first boolean, bits long", 4096)
    return dealt.groupBy("turn", "low", "up", "x", "y").applyInPandas(links, "a long, b long")


def roots(classes: DataFrame, budget: int = 3, capacity: int = 32_768) -> DataFrame:
    """classes, a row for each distinct fp, with ``root``: the same for all that links of at most ``budget`` bits connect."""
    linked = components(forest_links(classes.select("fp"), budget, capacity))
    linked = linked.withColumnsRenamed({"node": "fp", "component": "root"})
    return classes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_groups(docs: DataFrame, width: int = 3, budget: int = 3, capacity: int = 32_768) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links of at most ``budget`` bits) for each row."""
    rows = settle(fingerprints(docs, width), "fingerprints")
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("head")), "classes")
    named = roots(classes, budget, capacity)
    least = named.groupBy("root").agg(F.min("head").alias("component_id"))
    return rows.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
