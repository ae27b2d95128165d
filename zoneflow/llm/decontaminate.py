"""Benchmark passages in documents, found by spaced seeds and verified with substitutions allowed.

A seed is a fixed mask over ``len(mask)`` consecutive tokens; positions marked 0 are ignored, so a
window still matches when a word there was replaced. Hashes of all windows of the benchmark are
the build side of the join. They go out in blocks of at most ``BLOCK`` items and ``BLOCK_BYTES`` of text,
so what a worker holds is bounded whatever the benchmark's size; documents are only read, never shuffled,
and a hot passage or window is matched where its document lies. A document's word that no item of the block
contains gets code 0 and no window with such a word at a marked position is looked up.

Hits are reduced to diagonals (item, document position minus item position). On each diagonal the
best aligned stretch is taken: matching tokens add 1, others subtract ``PENALTY``. If less than
``min_share`` of it agrees, the longest stretch of which enough agrees takes its place. Stretches begin and
end with agreeing tokens. One is reported if it holds at least ``min_tokens`` (or the whole item, if
shorter) tokens, of which at least ``min_share`` agree; of an item's stretches in a document the one with
most agreeing tokens, of equal ones that of the smallest diagonal. The masks survive any word replaced
in four. An item shorter than every mask is looked up whole, as it is and with one inner word ignored.

Tokens are runs without ASCII white space, A-Z lower-cased, ASCII punctuation stripped at both
ends. Null or empty texts and items, and items under ``SHORTEST`` tokens, give nothing; null ids are kept.
Repeated rows repeat their result, repeated items too. Without items, or documents, nothing is found. Columns
not named are ignored; ``decontaminate`` returns them, whatever their names.
"""

from __future__ import annotations

import string
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .common import begin, map_arrow, words

#: Marked positions are compared, the others ignored.
MASKS = ("11101011", "11010111", "11101110111", "1101001100101")
BLOCK, BLOCK_BYTES, PENALTY, SHORTEST = 20_000, 8_000_000, 2, 4
_EDGE = string.punctuation.encode()


def tokens(text: str | None) -> list[bytes]:
    return [w for w in (w.strip(_EDGE) for w in words(text)) if w]


def _windows(codes: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions of windows whose marked words are all known, and their hashes."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h, known = np.full(n, len(mask), np.uint64), np.ones(n, bool)
    for i, bit in enumerate(mask):
        if bit == "1":
            part = codes[i:i + n]
            known &= part > 0
            h = (h ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    at = np.flatnonzero(known)
    return at, h[at]


def longest(same: np.ndarray, share: float) -> tuple[int, int]:
    """The longest stretch of which at least ``share`` is true, the first of equal ones, from a true to a true."""
    total = np.concatenate([[0.0], np.cumsum(same - share)])
    # the first place from which the sum up to each place is not negative
    first = np.searchsorted(-np.minimum.accumulate(total), -total - 1e-9)
    b = int((np.arange(len(total)) - first).argmax())
    true = np.flatnonzero(same[first[b]:b])
    return (int(first[b] + true[0]), int(first[b] + true[-1] + 1)) if len(true) else (0, 0)


class Block:
    """Codes, windows and words of some benchmark items."""

    def __init__(self, items: list[tuple], masks: tuple[str, ...]):
        self.ids = [i for i, _ in items]
        split = [tokens(t) for _, t in items]
        self.code = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for s in split for w in s))}
        self.items = [np.array([self.code[w] for w in s], np.int64) for s in split]
        self.seeds = []
        least = min(map(len, masks))
        short = {len(c) for c in self.items if SHORTEST <= len(c) < least}
        whole = [(n, "1" * i + "0" + "1" * (n - i - 1) if i else "1" * n) for n in sorted(short) for i in range(n - 1)]
        self.masks = [*masks, *(m for _, m in whole)]
        for n, mask in [*((0, m) for m in masks), *whole]:
            # items of n tokens, or of any number
            found = [_windows(c if n in (0, len(c)) else c[:0], mask) for c in self.items]
            h = np.concatenate([np.empty(0, np.uint64), *(h for _, h in found)])
            item = np.repeat(np.arange(len(found)), [len(h) for _, h in found])
            pos = np.concatenate([np.empty(0, np.int64), *(at for at, _ in found)])
            order = np.argsort(h, kind="stable")
            self.seeds.append((h[order], item[order], pos[order]))

    def hits(self, codes: np.ndarray) -> set[tuple[int, int]]:
        """(item, diagonal) of all equal windows."""
        out: set[tuple[int, int]] = set()
        for mask, (h, item, pos) in zip(self.masks, self.seeds, strict=True):
            at, own = _windows(codes, mask)
            lo, hi = np.searchsorted(h, own, "left"), np.searchsorted(h, own, "right")
            some = np.flatnonzero(hi > lo)
            for a, b, p in zip(lo[some].tolist(), hi[some].tolist(), at[some].tolist(), strict=True):
                out.update(zip(item[a:b].tolist(), (p - pos[a:b]).tolist(), strict=True))
        return out

    def overlap(self, codes: np.ndarray, item: int, diagonal: int, min_share: float) -> tuple[int, int, int, int]:
        """Document position, item position, length and agreeing tokens of the best stretch."""
        own = self.items[item]
        first, last = max(0, -diagonal), min(len(own), len(codes) - diagonal)
        same = own[first:last] == codes[first + diagonal:last + diagonal]
        total = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
        gain = total - np.minimum.accumulate(total)
        b = int(gain.argmax())
        a = int(np.flatnonzero(total[:b + 1] == total[:b + 1].min())[-1])
        if same[a:b].sum() < min_share * (b - a):
            a, b = longest(same, min_share)
        return a + first + diagonal, a + first, b - a, int(same[a:b].sum())

    def find(self, text: str | None, min_tokens: int, min_share: float) -> list[tuple]:
        """The best overlap with each item: index, document position, item position, length, agreeing."""
        codes = np.array([self.code.get(w, 0) for w in tokens(text)], np.int64)
        best: dict[int, tuple] = {}
        for item, diagonal in sorted(self.hits(codes)):
            got = self.overlap(codes, item, diagonal, min_share)
            if got[2] >= min(min_tokens, len(self.items[item])) and got[3] >= min_share * got[2]:
                if item not in best or got[3] > best[item][3]:
                    best[item] = got
        return [(i, *x) for i, x in best.items()]


def _blocks(benchmark: DataFrame, masks: tuple[str, ...]):
    """The benchmark's items as broadcasts of at most BLOCK items and BLOCK_BYTES each (a longer text alone)."""
    spark, held, size = benchmark.sparkSession, [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        own = len((r["text"] or "").encode("utf-8", "surrogatepass"))
        if held and (len(held) == BLOCK or size + own > BLOCK_BYTES):
            yield spark.sparkContext.broadcast(Block(held, masks))
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += own
    if held:
        yield spark.sparkContext.broadcast(Block(held, masks))


def overlaps(docs: DataFrame, benchmark: DataFrame, min_tokens: int = 10, min_share: float = 0.75,
             masks: tuple[str, ...] = MASKS) -> DataFrame:
    """doc_id, item_id, doc_pos, item_pos, n_tokens, n_agree: the best overlap of each pair that has one."""
    begin(docs.sparkSession)
    item_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)
    id_type, item_type = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {id_type}, item_id {item_type}, doc_pos long, item_pos long, n_tokens long, n_agree long"
    names = ["doc_pos", "item_pos", "n_tokens", "n_agree"]
    docs = docs.select("doc_id", "text")

    def scan(block):
        def run(batch: pa.RecordBatch):
            b = block.value
            found = [(k, *x) for k, t in enumerate(batch.column(1).to_pylist()) for x in b.find(t, min_tokens, min_share)]
            rows = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array([b.ids[x[1]] for x in found], item_arrow),
                 *(pa.array([x[i + 2] for x in found], pa.int64()) for i in range(4))], ["doc_id", "item_id", *names])
        return map_arrow(docs, run, schema)

    parts = [scan(b) for b in _blocks(benchmark, masks)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_tokens: int = 10, min_share: float = 0.75,
                  masks: tuple[str, ...] = MASKS) -> DataFrame:
    """The rows of docs, all columns, without overlap with any item; nothing is shuffled."""
    begin(docs.sparkSession)

    def clean(docs: DataFrame, block) -> DataFrame:
        at = docs.columns.index("text")

        def run(batch: pa.RecordBatch):
            keep = [not block.value.find(t, min_tokens, min_share) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
        return map_arrow(docs, run, docs.schema)

    return reduce(clean, _blocks(benchmark, masks), docs)
