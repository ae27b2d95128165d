"""How far the sources of a language lie apart, by their terms: for each pair of sources and each source's own terms.

Terms are runs of letters A-Z and a-z and of characters above ASCII, A-Z lower-cased. A language keeps the
V terms found in at least ``min_docs`` of its documents; each row is a document. A group is a (language,
source) that occurs, with N occurrences of kept terms. With SCALE = 10^9

  p(term) = 1 + floor(SCALE * (count + 1) / (N + V)),   f(p, q) = floor((p - q)^2 / q)

for groups and, with the counts of all its groups, for the language. All of it is integer arithmetic: counts
are multiplied as decimals, f stays below 10^18 and so does its sum over terms as long as V is below 8 * 10^9.

Pairs. The term-major index holds for each term the groups it occurs in. It is dealt in slices of about
``slice_postings`` postings by a hash of the term, so a language that holds most of them lies in many tasks.
In its slice each group goes through its own terms and scatters them through the index into one
accumulator per peer, which is as long as the language has groups. A term that one or neither of two
groups holds is worth f at a baseline p0 = 1 + floor(SCALE / (N + V)): accumulators start from the value
that all of the group's terms and all of each peer's have against the other's baseline, plus the baselines'
own for all other terms of the slice, and the scatter corrects this where both hold a term. No pair of postings
leaves a task, only sums, one for each pair of groups and slice; pairs are the result itself.

Terms. p and f against the language are columns of the postings; the ``top`` of each group are cut
before the shuffle (row_number limit), so a large group does not arrive whole in one task.

Null text, language and source are read as ''. Ties in value are in order of the item's UTF-8 bytes. Equal
rows count repeatedly. A language without kept terms has pairs of value 0 and no terms; a language of one source
has no pairs; an empty table gives an empty result. Very long texts are counted one by one in bounded
batches. Columns other than text, lang and source are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import begin, settle

SCALE = 1_000_000_000
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: A task adds up about so many different (group, term) before it hands them on.
HELD = 400_000


def postings(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents, added up per task. A group occurs with the
    term null once a task, whatever its texts hold."""
    def count(batches):
        n: Counter = Counter()
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in chain(batches, [None]):
            for text, *group in zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch else ():
                if sum(n.values()) > HELD:
                    yield from handed_on(held)
                    held, n = {}, Counter()
                terms, seen = held.setdefault(tuple(group), (Counter(), Counter()))
                found = TERM.findall(text.encode().lower())
                terms.update(found)
                seen.update(set(found))
                n[tuple(group)] = len(seen)
        yield from handed_on(held)

    begin(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def handed_on(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (terms, seen) in held.items():
        names = [None, *(t.decode() for t in terms)]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(names)), pa.array([source] * len(names)), pa.array(names, pa.string()),
            pa.array([0, *terms.values()], pa.int64()), pa.array([0, *(seen[t] for t in terms)], pa.int64())],
            ["lang", "source", "term", "n", "docs"])


def kept_terms(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(postings of kept terms: lang, source, term, n, lang_n; groups: lang, source, total (N), size (V),
    lang_total, no: the number in the language from 0)."""
    # dealt by (lang, term), which serves both sums
    counts = postings(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = counts.withColumns({"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term),
                                 "at": F.row_number().over(of_term.orderBy("source"))})
    held = settle(counts.where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)).drop("docs", "lang_docs"), "postings")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(F.col("term").isNotNull() & (F.col("at") == 1)).alias("size"))
    of_lang = Window.partitionBy("lang")
    groups = sums.withColumns({"size": F.sum("size").over(of_lang), "lang_total": F.sum("total").over(of_lang),
                               "no": F.row_number().over(of_lang.orderBy("source")) - 1})
    return held.where("term is not null").drop("at"), settle(groups, "groups")


def p_of(count: str, total: str, size: str = "size") -> str:
    """p as SQL; decimals, so that no product overflows. Nothing is divided where a language keeps no term."""
    return f"1 + cast({SCALE} as decimal(18,0)) * cast({count} + 1 as decimal(18,0)) div cast(greatest({total} + {size}, 1) as decimal(19,0))"


def f_of(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def divergences(no: np.ndarray, term: np.ndarray, p: np.ndarray, p0: np.ndarray, n_terms: int) -> np.ndarray:
    """Row by row the sums of f(p of the row's group, p of the peer) over the ``n_terms`` terms of a slice.

    (no, term, p) are the postings, terms numbered from 0; ``p0`` are the baselines of all groups.
    """
    size = len(p0)
    order = np.lexsort((no, term))
    peers, peer_p = no[order], p[order]
    first = np.searchsorted(term[order], np.arange(n_terms + 1))
    order = np.lexsort((term, no))
    row_first = np.searchsorted(no[order], np.arange(size + 1))
    # of each group, what its terms are worth as a peer's, by how many share a p
    kinds = [np.unique(p[order[a:b]], return_counts=True) for a, b in zip(row_first[:-1], row_first[1:], strict=True)]
    out = np.empty((size, size), np.int64)
    for a in range(size):
        acc = _f(p0[a], p0) * (n_terms - np.array([c.sum() for _, c in kinds]) - kinds[a][1].sum())
        for value, times in zip(*kinds[a], strict=True):
            acc += times * _f(value, p0)
        for b, (values, times) in enumerate(kinds):
            acc[b] += (times * _f(p0[a], values)).sum()
        own = order[row_first[a]:row_first[a + 1]]
        n = first[term[own] + 1] - first[term[own]]
        at = np.repeat(first[term[own]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        b, q, mine = peers[at], peer_p[at], np.repeat(p[own], n)
        np.add.at(acc, b, _f(mine, q) - _f(mine, p0[b]) - _f(p0[a], q) + _f(p0[a], p0[b]))
        out[a] = acc
    return out


def pair_sums(held: DataFrame, groups: DataFrame, slice_postings: int) -> DataFrame:
    """lang, a, b, value: the sums over all kept terms, by the groups' numbers."""
    slices = max(1, -(-held.count() // slice_postings))
    here = held.join(groups, ["lang", "source"]).select(
        "lang", F.expr(f"pmod(xxhash64(term), {slices})").alias("slice"), "no", F.xxhash64("term").alias("term"), F.expr(p_of("n", "total")).alias("p"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))
    peers = groups.select(F.col("lang").alias("its_lang"), every.alias("its_slice"), F.col("no").alias("peer"), F.expr(p_of("0L", "total")).alias("p0"))

    def run(key, mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        p0 = np.zeros(len(known), np.int64)
        p0[known["peer"].to_numpy()] = known["p0"].to_numpy()
        kept, term = np.unique(mine["term"].to_numpy(), return_inverse=True)
        sums = divergences(mine["no"].to_numpy(), term, mine["p"].to_numpy(), p0, len(kept))
        a, b = np.nonzero(~np.eye(len(p0), dtype=bool))
        return pd.DataFrame({"lang": key[0], "a": a.astype(np.int32), "b": b.astype(np.int32), "value": sums[a, b]})

    parts = here.groupBy("lang", "slice").cogroup(peers.groupBy("its_lang", "its_slice")).applyInPandas(run, "lang string, a int, b int, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, slice_postings: int = 500_000) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank for each group of docs."""
    held, groups = kept_terms(docs, min_docs)
    names = groups.select("lang", "source", "no")
    pairs = (pair_sums(held, groups, slice_postings)
             .join(names.select("lang", "source", F.col("no").alias("a")), ["lang", "a"])
             .join(names.select("lang", F.col("source").alias("item"), F.col("no").alias("b")), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    ps = held.join(groups, ["lang", "source"]).select("lang", "source", "term", F.expr(p_of("n", "total")).alias("p"), F.expr(p_of("lang_n", "lang_total")).alias("q"))
    terms = ps.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(f_of("p", "q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= top))
