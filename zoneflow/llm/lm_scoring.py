"""Cross-entropy difference: documents scored by two bigram models over one vocabulary.

The target model is learned from the documents that ``target`` names, the background model from
all documents, over all their tokens; order, vocabulary and smoothing are the same. Every word of
the corpus is in the vocabulary and every bigram in the counts, so both grow with the corpus:

  p(w | v) = (c(v, w) + mu p(w)) / (c(v) + mu),   p(w) = (c(w) + 0.5) / (N + 0.5 V)

with V the words, a start mark and an unknown word. A document's score is the mean over its tokens
of target loss minus background loss, in nats: the lower, the closer to the target.

Work. Documents are read once into slices of ``slice_tokens`` tokens, each the sorted hashes of its
words and the tokens as numbers into them, written to the shared folder. A slice sends every word and
every bigram it has once, with its own counts, to the bucket of the hash (``bucket_keys`` bounds about
what a bucket is sent); there the counts of all slices are added up and go back in the order in
which the slice asked. Keys travel as sorted differences and counts as small numbers, both
compressed, so no row leaves a document and a frequent word is sent once a slice, not once an
occurrence. Losses are then summed where the slice's documents lie. Words and bigrams are told apart by
64-bit hashes: two of 10^8 words share one with a chance of 3 in 10,000, of 10^10 bigrams three pairs do.

Bounded models: with a ``word_share`` or ``gram_share`` above 0, words below that share of all tokens
are one unknown token, and bigrams below that share of a model's tokens give their mass to the unigram
estimate, p(w | v) = (c(v, w) if kept, else 0, + (r(v) + mu) p(w)) / (c(v) + mu) with r(v) the
pruned count after v. Such models are broadcast whole.

Tokens are runs without ASCII white space, A-Z lower-cased; the first follows a start mark. Null or
empty texts count nothing and have n_tokens 0 and null scores. A doc_id that is null or not in
``target`` is background only; repeated ids in ``target`` count once, repeated rows of docs each
count. Without a target document the target model is the uniform one.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, map_arrow, settle, words

UNKNOWN, START = 0, 1
_BITS = np.int64(32)
#: A task adds up about so many different words (eight times as many bigrams) before it hands them on.
HELD = 500_000


def word_counts(docs: DataFrame) -> DataFrame:
    """w, n: every word of every text."""
    def count(batches):
        found: Counter = Counter()
        for batch in chain(batches, [None]):
            if found and (batch is None or len(found) > HELD):
                yield pa.RecordBatch.from_pydict({"w": pa.array(found.keys(), pa.binary()), "n": pa.array(found.values(), pa.int64())})
                found.clear()
            for text in batch.column(0).to_pylist() if batch else ():
                found.update(words(text))

    rows = docs.select("text").mapInArrow(count, "w binary, n long")
    return settle(rows.groupBy("w").agg(F.sum("n").alias("n")), "word-counts")


def _top(counts: DataFrame, word_share: float) -> dict[bytes, int]:
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.where(F.col("n") >= word_share * total).orderBy(F.desc("n"), "w").collect()
    return {bytes(r["w"]): i + 2 for i, r in enumerate(top)}


def vocabulary(docs: DataFrame, word_share: float) -> dict[bytes, int]:
    """word -> code (2 and up), by falling count; counted over every text."""
    return _top(word_counts(docs), word_share)


def _codes(w: list[bytes], vocab: dict[bytes, int]) -> np.ndarray:
    return np.fromiter((vocab.get(x, UNKNOWN) for x in w), np.int64, len(w))


def _bigrams(codes: np.ndarray) -> np.ndarray:
    return (np.concatenate([[START], codes[:-1]]) << _BITS) | codes if len(codes) else codes


def flagged(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, text, is_target for each row of docs."""
    wanted = target.select(F.col("doc_id").alias("wanted")).where("wanted is not null").distinct()
    # merged at every size, so that disk use grows in proportion and not by a change of plan
    wanted = wanted.hint("merge")
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted"), "left")
    return rows.select("doc_id", "text", F.col("wanted").isNotNull().alias("is_target"))


def bigram_counts(docs: DataFrame, target: DataFrame, vocab) -> DataFrame:
    """gram, n (all documents), t (target documents)."""
    return _count(flagged(docs, target), vocab)


def _count(rows: DataFrame, vocab) -> DataFrame:

    def counted(every: list[np.ndarray], wanted: list[np.ndarray]) -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(every), return_counts=True)
        own, m = np.unique(np.concatenate([np.empty(0, np.int64), *wanted]), return_counts=True)
        t = np.zeros(len(codes), np.int64)
        t[np.searchsorted(codes, own)] = m
        return pa.RecordBatch.from_pydict({"gram": pa.array(codes), "n": pa.array(n), "t": pa.array(t)})

    def count(batches):
        every, wanted, held = [], [], 0
        for batch in chain(batches, [None]):
            if held and (batch is None or held > 8 * HELD):
                yield counted(every, wanted)
                every, wanted, held = [], [], 0
            for text, flag in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True) if batch else ():
                grams = _bigrams(_codes(words(text), vocab.value))
                every.append(grams)
                held += len(grams)
                if flag:
                    wanted.append(grams)

    grams = rows.select("text", "is_target").mapInArrow(count, "gram long, n long, t long")
    return grams.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


class Model:
    """Losses of a bigram model: kept bigrams in order of their codes, back-off for the others."""

    def __init__(self, size: int, firsts: dict[int, int], lasts: dict[int, int], kept: tuple[np.ndarray, np.ndarray], mu: float):
        c1, self.cv = np.zeros(size), np.zeros(size)
        c1[list(lasts)], self.cv[list(firsts)] = list(lasts.values()), list(firsts.values())
        self.p1 = (c1 + 0.5) / (c1.sum() + 0.5 * size)
        self.grams, n = kept
        v, w = self.grams >> _BITS, self.grams & np.int64(0xFFFFFFFF)
        self.rest = self.cv - np.bincount(v, n, minlength=size) + mu
        self.cv += mu
        self.loss = -np.log((n + self.rest[v] * self.p1[w]) / self.cv[v])

    def losses(self, grams: np.ndarray) -> np.ndarray:
        v, w = grams >> _BITS, grams & np.int64(0xFFFFFFFF)
        out = -np.log(self.rest[v] * self.p1[w] / self.cv[v])
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            out = np.where(self.grams[at] == grams, self.loss[at], out)
        return out


def learn(counts: DataFrame, size: int, column: str, gram_share: float, mu: float) -> Model:
    """The model of one count column; what is collected is bounded by the two shares."""
    counts = counts.select("gram", F.col(column).alias("n")).where("n > 0")
    side = lambda e: {r["k"]: r["n"] for r in counts.groupBy(F.expr(e).alias("k")).agg(F.sum("n").alias("n")).collect()}
    firsts, lasts = side(f"shiftright(gram, {_BITS})"), side("gram & 4294967295")
    kept = counts.where(F.col("n") >= gram_share * sum(firsts.values())).orderBy("gram").collect()
    return Model(size, firsts, lasts, (np.array([r["gram"] for r in kept], np.int64), np.array([r["n"] for r in kept], np.int64)), mu)


def _bounded(docs: DataFrame, target: DataFrame, word_share: float, gram_share: float, mu: float) -> DataFrame:
    """Scores by models that are cut to shares of the corpus and broadcast."""
    spark = begin(docs.sparkSession)
    words_known = vocabulary(docs, word_share)
    vocab = spark.sparkContext.broadcast(words_known)
    counts = settle(bigram_counts(docs, target, vocab), "bigrams")
    models = spark.sparkContext.broadcast([learn(counts, len(words_known) + 2, c, gram_share, mu) for c in ("t", "n")])

    def run(batch: pa.RecordBatch):
        grams = [_bigrams(_codes(words(t), vocab.value)) for t in batch.column(1).to_pylist()]
        n = np.array([len(g) for g in grams])
        every, of = np.concatenate([np.empty(0, np.int64), *grams]), np.repeat(np.arange(len(grams)), n)
        means = [np.bincount(of, m.losses(every), minlength=len(grams)) / np.maximum(n, 1) for m in models.value]
        none = n == 0
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "target_loss": pa.array(means[0], mask=none),
            "background_loss": pa.array(means[1], mask=none), "score": pa.array(means[0] - means[1], mask=none)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {id_type}, n_tokens long, target_loss double, background_loss double, score double")


def _pack(*columns: np.ndarray) -> bytes:
    """Equally long columns, their first bytes together, then their second ones and so on, compressed."""
    return pa.compress(b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns), "zstd", asbytes=True)


def _unpack(data: bytes, size: int, *types) -> list[np.ndarray]:
    wide = [np.dtype(t).itemsize for t in types]
    raw, at, out = np.frombuffer(pa.decompress(data, size * sum(wide), "zstd", asbytes=True), np.uint8), 0, []
    for t, n in zip(types, wide, strict=True):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(n, size).T).view(t).reshape(size))
        at += n * size
    return out


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit hash for two, by the finalizer of splitmix64."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Slice:
    """Some documents as numbers into the sorted hashes of their words."""

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, lens: np.ndarray, own: np.ndarray):
        self.hashes, self.tokens, self.lens, self.own = hashes, tokens, lens, own
        ends = np.cumsum(lens)
        self.starts, self.ends = (ends - lens)[lens > 0], (ends - 1)[lens > 0]
        self.of = np.repeat(np.arange(len(lens)), lens)
        right = hashes[tokens]
        left = np.concatenate([right[:1], right[:-1]])
        left[self.starts] = xxhash.xxh64_intdigest(b"\n")
        self.grams, self.gram = np.unique(_mixed(left, right), return_inverse=True)

    def counts(self) -> dict[str, tuple[np.ndarray, list[np.ndarray]]]:
        """kind -> sorted keys and their counts: in all documents and in the target's; of words also as a last one."""
        mine = self.own[self.of]
        n = lambda at, size: np.bincount(at, minlength=size).astype(np.int64)
        last, size = self.tokens[self.ends], len(self.hashes)
        words = [self.tokens, self.tokens[mine], last, last[mine[self.ends]]]
        return {"word": (self.hashes, [n(x, size) for x in words]),
                "gram": (self.grams, [n(x, len(self.grams)) for x in (self.gram, self.gram[mine])])}


_COUNTS = {"word": 4, "gram": 2}
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _settle(df: DataFrame, what: str) -> DataFrame:
    """``settle``, with the job's shuffle files deleted when the table is written, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN, "false")
    conf.set(_CLEAN, "true")
    try:
        return settle(df, what)
    finally:
        conf.set(_CLEAN, before)


def _slices(rows: DataFrame, slice_tokens: int) -> DataFrame:
    """Documents in slices of about ``slice_tokens`` tokens (a longer document is one), read once."""
    names = ["slice", "ids", "lens", "own", "n_words", "n_grams", "hashes", "tokens", "n", "t", "n_docs", "t_docs"]

    def run(batches):
        first, ids, own, coded, numbers, done, held = TaskContext.get().partitionId() << 32, [], [], [], _Numbers(), 0, 0
        for batch in chain(batches, [None]):
            for i in range(batch.num_rows if batch else 1):
                if ids and (batch is None or held >= slice_tokens):
                    digests = np.array([xxhash.xxh64_intdigest(w) for w in numbers], np.uint64)
                    hashes, place = np.unique(digests, return_inverse=True)
                    tokens = place.astype(np.int32)[np.concatenate(coded)]
                    lens, flags = np.array([len(c) for c in coded], np.int64), np.array(own, bool)
                    part = _Slice(hashes, tokens, lens, flags)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([first + done], pa.int64()), pa.array([ids], pa.list_(id_arrow)), pa.array([lens.tolist()], pa.list_(pa.int64())),
                        pa.array([own], pa.list_(pa.bool_())), *[pa.array([len(x)], pa.int64()) for x in (hashes, part.grams)],
                        pa.array([_pack(hashes)], pa.binary()), pa.array([_pack(tokens)], pa.binary()),
                        *[pa.array([int(x)], pa.int64()) for x in (lens.sum(), lens[flags].sum(), (lens > 0).sum(), (lens[flags] > 0).sum())]], names)
                    ids, own, coded, numbers, held = [], [], [], _Numbers(), 0
                    done += 1
                if batch is not None:
                    id_arrow = batch.schema.field(0).type
                    found = words(batch.column(1)[i].as_py())
                    coded.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                    ids.append(batch.column(0)[i].as_py())
                    own.append(batch.column(2)[i].as_py())
                    held += len(found) + 1

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"slice long, ids array<{id_type}>, lens array<bigint>, own array<boolean>, n_words long, n_grams long, "
                                "hashes binary, tokens binary, n long, t long, n_docs long, t_docs long")


def _slice_of(row: dict) -> _Slice:
    lens = np.array(row["lens"], np.int64)
    hashes, = _unpack(row["hashes"], row["n_words"], np.uint64)
    tokens, = _unpack(row["tokens"], int(lens.sum()), np.int32)
    return _Slice(hashes, tokens, lens, np.array(row["own"], bool))


_MESSAGE = "kind string, bucket long, slice long, size long, data binary"


def _asked(slices: DataFrame, buckets: dict[str, int]) -> DataFrame:
    """For each slice, kind and bucket of hashes that it has any of: the keys and the slice's own counts."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out = []
                for kind, (keys, counts) in _slice_of(row).counts().items():
                    if not len(keys):
                        continue
                    at = (keys >> np.uint64(32)) * np.uint64(buckets[kind]) >> np.uint64(32)
                    cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                    for a, z in zip(cuts, [*cuts[1:], len(at)], strict=True):
                        steps = np.diff(keys[a:z], prepend=np.uint64(0))
                        out.append((kind, int(at[a]), row["slice"], int(z - a), _pack(steps, *[c[a:z] for c in counts])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                        ["kind", "bucket", "slice", "size", "data"])

    return slices.select("slice", "lens", "own", "n_words", "hashes", "tokens").mapInArrow(run, _MESSAGE)


def _answered(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One bucket: each slice's keys get the counts of all slices; ``kinds`` has the bucket's number of keys once."""
    wide, sizes = _COUNTS[key[0].as_py()], table.column("size").to_pylist()
    parts = [_unpack(d.as_py(), n, np.uint64, *[np.int64] * wide) for d, n in zip(table.column("data"), sizes, strict=True)]
    keys, at = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
    sums = []
    for c in range(1, wide + 1):
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate([p[c] for p in parts]))
        sums.append(total)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    data = [_pack(*[s[at[a:z]] for s in sums]) for a, z in zip(cuts, cuts[1:], strict=False)]
    out = table.set_column(table.schema.get_field_index("data"), "data", pa.array(data, pa.binary()))
    return out.append_column("kinds", pa.array([len(keys)] + [0] * (len(data) - 1), pa.int64()))


def _whole(docs: DataFrame, target: DataFrame, mu: float, slice_tokens: int, bucket_keys: int) -> DataFrame:
    """Scores by models of all words and all bigrams."""
    begin(docs.sparkSession)
    slices = _settle(_slices(flagged(docs, target), slice_tokens), "slices")
    sums = slices.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "t", "n_docs", "t_docs", "n_words", "n_grams")]).first()
    buckets = {k: -(-sums[c] // bucket_keys) or 1 for k, c in (("word", "n_words"), ("gram", "n_grams"))}
    answers = _asked(slices, buckets).groupBy("kind", "bucket").applyInArrow(_answered, f"{_MESSAGE}, kinds long")
    answers = _settle(answers, "answers")
    kinds = (answers.where("kind = 'word'").agg(F.sum("kinds")).first()[0] or 0) + 2
    totals, nonempty = (sums["t"], sums["n"]), (sums["t_docs"], sums["n_docs"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        part, found = _slice_of(row), {"word": [], "gram": []}
        for r in sorted(right.select(["kind", "bucket", "size", "data"]).to_pylist(), key=lambda r: r["bucket"]):
            found[r["kind"]].append(_unpack(r["data"], r["size"], *[np.int64] * _COUNTS[r["kind"]]))
        none = [np.empty(0, np.int64)]
        n_word, t_word, n_last, t_last = (np.concatenate(none + [f[i] for f in found["word"]]) for i in range(4))
        n_gram, t_gram = (np.concatenate(none + [f[i] for f in found["gram"]]) for i in range(2))
        n = part.lens
        means = []
        for word, last, gram, total, docs_there in zip((t_word, n_word), (t_last, n_last), (t_gram, n_gram), totals, nonempty, strict=True):
            p = (word + 0.5) / (total + 0.5 * kinds)
            first = (word - last)[part.tokens]
            first = np.concatenate([first[:1], first[:-1]])
            first[part.starts] = docs_there
            loss = np.log(first + mu) - np.log(gram[part.gram] + mu * p[part.tokens])
            means.append(np.bincount(part.of, loss, minlength=len(n)) / np.maximum(n, 1))
        empty = n == 0
        return pa.table({
            "doc_id": left.column("ids").combine_chunks().flatten(), "n_tokens": pa.array(n, pa.int64()),
            "target_loss": pa.array(means[0], mask=empty), "background_loss": pa.array(means[1], mask=empty),
            "score": pa.array(means[0] - means[1], mask=empty)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    given = slices.select("slice", "ids", "lens", "own", "n_words", "hashes", "tokens").groupBy("slice")
    return given.cogroup(answers.groupBy("slice")).applyInArrow(
        score, f"doc_id {id_type}, n_tokens long, target_loss double, background_loss double, score double")


def score(docs: DataFrame, target: DataFrame, word_share: float = 0.0, gram_share: float = 0.0, mu: float = 10.0,
          slice_tokens: int = 500_000, bucket_keys: int = 2_000_000) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score for each row of docs."""
    if word_share > 0 or gram_share > 0:
        return _bounded(docs, target, word_share, gram_share, mu)
    return _whole(docs, target, mu, slice_tokens, bucket_keys)
