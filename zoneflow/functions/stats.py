"""Exact percentiles of whole columns without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor, inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "column string, prob double, value double"
#: Steps of the grid by which one scan narrows a bracket.
GRID = 512


def _interpolate(low: float, high: float, t: float) -> float:
    step = high - low
    return high - step * (1 - t) if t >= 0.5 else low + step * t


class _Wanted:
    """One percentile: the ranks it lies between, and the bracket of values [low, high] that holds them."""

    def __init__(self, column: str, prob: float, n: int):
        self.column, self.prob, self.n, self.at = column, prob, n, (n - 1) * prob
        self.rank = min(int(floor(self.at)), n - 1)
        self.last, self.below, self.inside = min(self.rank + 1, n - 1), 0, n
        self.low, self.high, self.slack = -inf, inf, 2.0

    def cell(self) -> Column:
        """The column's value where it lies in the bracket."""
        return F.when(F.col(self.column).between(self.low, self.high), F.col(self.column))

    def narrow(self, grid: list[float], accuracy: int) -> None:
        """Bracket the ranks between two points of the grid, the sketch's rank error and more aside."""
        steps = len(grid) - 1
        first = floor(((self.rank - self.below) / self.inside - self.slack / accuracy) * steps)
        final = ceil(((self.last - self.below + 1) / self.inside + self.slack / accuracy) * steps)
        low, high = self.low if first <= 0 else grid[first], self.high if final >= steps else grid[final]
        share = (min(final, steps) - max(first, 0)) / steps + 2 * self.slack / accuracy
        self.low, self.high, self.expected = low, high, share * self.inside

    def widen(self) -> None:
        """After a miss: start again from the whole column, with more slack."""
        self.low, self.high, self.below, self.inside, self.slack = -inf, inf, 0, self.n, self.slack * 8


def exact_percentiles(
    df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 20_000, bound: int = 20_000,
    also: Sequence[Column] = (),
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated percentiles ``{column: {prob: value}}``; nulls and NaN are left out.

    A scan counts a column and sketches it at ``GRID`` points; of these, the two around a wanted rank
    (with the sketch's rank error of 1/accuracy to either side) bracket it. While a bracket is
    expected to hold more than ``bound`` values, a further scan counts and sketches what is inside.
    The last scan counts the values inside all brackets, and what lies below each; only these
    are ordered, at most about ``bound`` different ones for each percentile. A bracket that missed its
    rank is widened and done again. ``also`` are aggregates of the columns, evaluated in the first
    scan and returned under None.
    """
    if not columns:
        return {}
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    typed = typed.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in columns])
    points = [i / GRID for i in range(GRID + 1)]
    first = typed.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, points, accuracy).alias(f"q{i}") for i, c in enumerate(columns)],
        *also,
    ).first()
    out: dict = {c: dict.fromkeys(probs) for c in columns}
    if also:
        out[None] = first
    open_ = []
    for i, c in enumerate(columns):
        for p in probs if first[f"n{i}"] else ():
            open_.append(_Wanted(c, p, first[f"n{i}"]))
            if first[f"n{i}"] > bound:
                open_[-1].narrow(first[f"q{i}"], accuracy)
    while open_:
        _narrow(typed, [w for w in open_ if w.inside > bound and w.low < w.high], points, accuracy, bound)
        missed = []
        for w, values in zip(open_, _inside(typed, open_), strict=True):
            found = [next((v for v, start, upto in values if start <= r < upto), None) for r in (w.rank, w.last)]
            if None in found:
                w.widen()
                missed.append(w)
            else:
                out[w.column][w.prob] = _interpolate(*found, w.at - w.rank)
        open_ = missed
    return out


def _narrow(typed: DataFrame, wide: list[_Wanted], points: list[float], accuracy: int, bound: int) -> None:
    """Scan by scan, until every bracket is expected to hold ``bound`` values at most."""
    wide = [w for w in wide if w.low == -inf and w.high == inf or w.expected > bound]
    while wide:
        row = typed.agg(*[f for i, w in enumerate(wide) for f in (
            F.count_if(F.col(w.column) < w.low).alias(f"b{i}"), F.count(w.cell()).alias(f"n{i}"),
            F.percentile_approx(w.cell(), points, accuracy).alias(f"q{i}"))]).first()
        for i, w in enumerate(wide):
            before = w.inside
            w.below, w.inside = row[f"b{i}"], row[f"n{i}"]
            if not w.below <= w.rank <= w.last < w.below + w.inside:
                w.widen()
                continue
            w.narrow(row[f"q{i}"], accuracy)
            if w.inside >= before:  # a few values hold it all
                w.expected = 0
        wide = [w for w in wide if w.low < w.high and w.expected > bound]


def _inside(typed: DataFrame, wanted: list[_Wanted]) -> list[list[tuple[float, int, int]]]:
    """For each bracket, of the values in it that hold its ranks: the value, and the ranks from and to which it stands."""
    cells = [F.when(F.col(w.column) <= w.high, F.struct(
        F.lit(i).alias("id"), F.when(F.col(w.column) >= w.low, F.col(w.column)).alias("v"))) for i, w in enumerate(wanted)]
    counted = (
        # Outer, so that Spark does not build the array again to filter on its size. Values below are one
        # group without a value, first in order.
        typed.select(F.inline_outer(F.array_compact(F.array(*cells))))
        .where(F.col("id").isNotNull()).groupBy("id", "v").agg(F.count("*").alias("cnt"))
    )
    goals = typed.sparkSession.createDataFrame([(i, w.rank, w.last) for i, w in enumerate(wanted)], "id int, rank long, last long")
    upto = F.sum("cnt").over(Window.partitionBy("id").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    picked = (
        counted.join(F.broadcast(goals), "id").withColumn("upto", upto)
        .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("cnt") <= F.col("last")) & F.col("v").isNotNull())
        .select("id", "v", (F.col("upto") - F.col("cnt")).alias("start"), "upto").collect()
    )
    out: list[list] = [[] for _ in wanted]
    for r in picked:
        out[r["id"]].append((r["v"], r["start"], r["upto"]))
    return out


def percentile_frame(df: DataFrame, columns: list[str], probs: list[float], **kw) -> DataFrame:
    found = exact_percentiles(df, columns, probs, **kw)
    rows = [(c, p, found[c][p]) for c in columns for p in probs]
    return df.sparkSession.createDataFrame(rows, SCHEMA)
