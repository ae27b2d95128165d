"""Multinomial logistic regression whose coefficients lie in tables, for features of any number.

The driver and a task hold blocks only. Rows are numbered in blocks of ``row_block`` and features in blocks of
``feature_block``; a cell holds the entries of a row block in a feature block as three packed arrays. Margins
add up per row block, gradients per feature block. L-BFGS needs sums of products of its vectors only, so the
driver sees a small matrix an iteration, and a step is searched along margins without reading features again.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.operators.sampling import ranked
from zoneflow.session import shared_path, tidied, written

# Functions travel whole, so that workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pairs of steps and gradient differences that L-BFGS keeps, and step sizes that one search tries.
CORRECTIONS, STEPS = 10, [*(2.0 ** (-k / 4) for k in range(-8, 13)), *(2.0 ** -k for k in range(4, 22))]
_VECTORS = "fb int, name string, vec binary"


def _array(packed, kind=np.float64) -> np.ndarray:
    return np.frombuffer(packed, dtype=kind)


def _total(parts) -> np.ndarray:
    return reduce(np.add, (_array(p) for p in parts))


def _sizer(total: int, block: int):
    """Length of each block: the last one is shorter."""
    return lambda b: max(0, min(block, total - b * block))


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Blocks:
    """Numbered rows and the cells of their features, written once. The intercept is the last feature."""

    def __init__(self, rows: DataFrame, n_rows: int, features: str, n_features: int, row_block: int, feature_block: int):
        self.rows_in, self.features_in = _sizer(n_rows, row_block), _sizer(n_features + 1, feature_block)
        v = F.unwrap_udt(features)
        at = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
        entries = F.concat(F.arrays_zip(at.alias("i"), v["values"].alias("x")),
                           F.array(F.struct(F.lit(n_features).alias("i"), F.lit(1.0).alias("x"))))
        each = rows.select("_rb", "_pos", F.inline(entries)).where("x <> 0").select(
            F.col("_rb").alias("rb"), F.floor(F.col("i") / feature_block).cast("int").alias("fb"),
            "_pos", (F.col("i") % feature_block).alias("i"), "x")

        def pack(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([(*key, cell["_pos"].to_numpy(np.int32).tobytes(), cell["i"].to_numpy(np.int32).tobytes(),
                                  cell["x"].to_numpy(np.float64).tobytes())], columns=["rb", "fb", "pos", "idx", "x"])

        self.cells = written(each.groupBy("rb", "fb").applyInPandas(
            pack, "rb int, fb int, pos binary, idx binary, x binary"), "cells")
        self.keys = self.cells.select(F.col("rb").alias("_to_rb"), F.col("fb").alias("_to_fb"))

    def margins(self, vectors: DataFrame, k: int) -> DataFrame:
        """(rb, part) of each cell: its share of the rows' margins. ``vectors``: (fb, vec)."""
        rows_in = self.rows_in

        def forward(key: tuple, cells: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
            size = rows_in(key[0])
            out = np.zeros((size, k))
            if len(cells) and len(vectors):
                w = _array(vectors["vec"][0]).reshape(-1, k)
                pos, idx, x = _array(cells["pos"][0], np.int32), _array(cells["idx"][0], np.int32), _array(cells["x"][0])
                for c in range(k):
                    out[:, c] = np.bincount(pos, x * w[idx, c], size)
            return pd.DataFrame([(key[0], out.tobytes())], columns=["rb", "part"])

        placed = self.keys.join(vectors, F.col("_to_fb") == F.col("fb")).select("_to_rb", "_to_fb", "vec")
        return self.cells.groupBy("rb", "fb").cogroup(placed.groupBy("_to_rb", "_to_fb")).applyInPandas(forward, "rb int, part binary")

    def sums(self, weights: DataFrame, k: int, square: bool = False) -> DataFrame:
        """(fb, part) of each cell: its features' sums of value times the row's weights. ``weights``: (rb, vec)."""
        features_in = self.features_in

        def backward(key: tuple, cells: pd.DataFrame, weights: pd.DataFrame) -> pd.DataFrame:
            size = features_in(key[1])
            out = np.zeros((size, k))
            if len(cells) and len(weights):
                r = _array(weights["vec"][0]).reshape(-1, k)
                pos, idx, x = _array(cells["pos"][0], np.int32), _array(cells["idx"][0], np.int32), _array(cells["x"][0])
                for c in range(k):
                    out[:, c] = np.bincount(idx, (x * x if square else x) * r[pos, c], size)
            return pd.DataFrame([(key[1], out.tobytes())], columns=["fb", "part"])

        placed = self.keys.join(weights, F.col("_to_rb") == F.col("rb")).select("_to_rb", "_to_fb", "vec")
        return self.cells.groupBy("rb", "fb").cogroup(placed.groupBy("_to_rb", "_to_fb")).applyInPandas(backward, "fb int, part binary")


def _numbered(rows: DataFrame, key: list[str], row_block: int) -> DataFrame:
    """Rows with their block and place in it. Written, so that numbers of equal keys stay."""
    return written(ranked(rows, [], 0, key).select(
        *rows.columns, F.floor(F.col("rank") / row_block).cast("int").alias("_rb"),
        (F.col("rank") % row_block).cast("int").alias("_pos")), "numbered")


class WideLogistic(Estimator):
    """As Spark's multinomial fit: L2 penalty on coefficients of features scaled to unit deviation, free
    intercepts that start from the class counts, L-BFGS until ``max_iter`` or an improvement below ``tol``. ``key`` names columns
    that place rows; equal keys only share a bucket. Labels are 0 to classes - 1, and a null one fails the job."""

    def __init__(self, key: list[str], label: str = "label", features: str = "features", max_iter: int = 100,
                 reg: float = 0.0, tol: float = 1e-6, row_block: int = 1 << 18, feature_block: int = 1 << 17):
        super().__init__()
        self.key, self.label, self.features, self.max_iter, self.reg, self.tol = key, label, features, max_iter, reg, tol
        self.row_block, self.feature_block = row_block, feature_block

    def _fit(self, dataset: DataFrame) -> WideLogisticModel:
        with tidied(dataset.sparkSession):  # each pass shuffles cells
            return self._fitted(dataset)

    def _fitted(self, dataset: DataFrame) -> WideLogisticModel:
        label = F.col(self.label).cast("double")
        wrong = F.raise_error(F.lit("a label is missing or no class number")).cast("int")
        given = dataset.select(*dict.fromkeys(self.key), F.col(self.features).alias("_features"), F.when(
            label.isNull() | (label < 0) | (label != F.floor(label)) | F.isnan(label), wrong).otherwise(label.cast("int")).alias("_label"))
        rows = _numbered(given, self.key, self.row_block)
        counts = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
        if not counts:
            raise ValueError("no rows to fit")
        n, k = sum(counts.values()), max(counts) + 1
        n_features = rows.select(F.unwrap_udt("_features").alias("v")).select(
            F.coalesce(F.col("v.size"), F.size("v.values"))).first()[0]
        block, reg, last = self.feature_block, self.reg, n_features
        blocks = _Blocks(rows, n, "_features", n_features, self.row_block, block)
        rows_in, features_in, base = blocks.rows_in, blocks.features_in, shared_path(rows.sparkSession, "wide-logistic")

        def stored(vectors: DataFrame, name: str) -> str:
            vectors.write.parquet(f"{base}/{name}")
            return f"{base}/{name}"

        def read(paths: list[str]) -> DataFrame:
            return rows.sparkSession.read.schema(_VECTORS).parquet(*paths)

        def labels_of(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            y = np.full(rows_in(key[0]), -1, np.int32)
            y[part["_pos"]] = part["_label"]
            return pd.DataFrame([(key[0], y.tobytes())], columns=["rb", "y"])

        labels = written(rows.select(F.col("_rb").alias("rb"), "_pos", "_label").groupBy("rb").applyInPandas(
            labels_of, "rb int, y binary"), "labels")

        def ones(parts):
            for part in parts:
                yield pd.DataFrame([(rb, np.ones(len(y) // 4).tobytes()) for rb, y in zip(part["rb"], part["y"])], columns=["rb", "vec"])

        one = labels.mapInPandas(ones, "rb int, vec binary")
        moments = blocks.sums(one, 1).withColumn("power", F.lit(1)).unionByName(
            blocks.sums(one, 1, square=True).withColumn("power", F.lit(2)))

        start = np.log1p([counts.get(c, 0) for c in range(k)])
        start -= start.mean()

        def scales(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            s, q = (_total(part["part"][part["power"] == p]) for p in (1, 2))
            size = len(s)
            deviation = np.sqrt(np.maximum((q - s * s / n) / max(n - 1, 1), 0.0))
            inv = np.divide(1.0, deviation, out=np.zeros(size), where=deviation > 0)
            w = np.zeros((size, k))
            if key[0] == last // block:
                inv[last % block], w[last % block] = 1.0, start
            return pd.DataFrame([(key[0], "inv", inv.tobytes()), (key[0], "w", w.tobytes())], columns=["fb", "name", "vec"])

        state = written(moments.groupBy("fb").applyInPandas(scales, _VECTORS), "scales")
        inverse = state.where("name = 'inv'")
        weights, gradients = [stored(state.where("name = 'w'").withColumn("name", F.lit("w0000")), "w0000")], []

        def scaled(vectors: DataFrame) -> DataFrame:
            """Vectors over scaled features as those over the features as given."""
            def times(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
                by = dict(zip(part["name"], part["vec"]))
                inv = _array(by.pop("inv"))
                return pd.DataFrame([(key[0], (_array(v).reshape(-1, k) * inv[:, None]).tobytes()) for v in by.values()], columns=["fb", "vec"])
            return vectors.unionByName(inverse).groupBy("fb").applyInPandas(times, "fb int, vec binary")

        def free(fb: int) -> np.ndarray:
            """What the penalty counts: everything but the intercepts."""
            mask = np.ones((features_in(fb), 1))
            if fb == last // block:
                mask[last % block] = 0.0
            return mask

        def gradient(line: DataFrame, step: float, at: str, name: str) -> str:
            def residuals(parts):
                for part in parts:
                    for r in part.itertuples():
                        y = _array(r.y, np.int32)
                        p = _softmax((_array(r.here) + step * _array(r.along)).reshape(-1, k))
                        real = np.flatnonzero(y >= 0)
                        p[real, y[real]] -= 1.0
                        p[y < 0] = 0.0
                        yield pd.DataFrame([(r.rb, p.tobytes())], columns=["rb", "vec"])

            parts = blocks.sums(line.mapInPandas(residuals, "rb int, vec binary"), k).select("fb", F.lit("part").alias("name"), F.col("part").alias("vec"))

            def whole(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
                named = {name: part["vec"][part["name"] == name] for name in ("part", "inv", "w")}
                g = _total(named["part"]).reshape(-1, k) * _array(named["inv"].iloc[0])[:, None] / n
                g += reg * free(key[0]) * _array(named["w"].iloc[0]).reshape(-1, k)
                return pd.DataFrame([(key[0], name, g.tobytes())], columns=["fb", "name", "vec"])

            w = read([at]).withColumn("name", F.lit("w"))
            return stored(parts.unionByName(inverse).unionByName(w).groupBy("fb").applyInPandas(whole, _VECTORS), name)

        def line_along(vectors: DataFrame, before: DataFrame | None, step: float) -> DataFrame:
            """(rb, y, here, along): labels, margins so far, margins of a direction."""
            parts = blocks.margins(scaled(vectors), k).select("rb", F.lit("along").alias("name"), F.col("part").alias("vec"))
            parts = parts.unionByName(labels.select("rb", F.lit("y").alias("name"), F.col("y").alias("vec")))
            fresh = before is None
            if not fresh:
                parts = parts.unionByName(before.select("rb", F.lit("here").alias("name"), F.col("here").alias("vec")))
                parts = parts.unionByName(before.select("rb", F.lit("last").alias("name"), F.col("along").alias("vec")))

            def total(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
                of = {name: part["vec"][part["name"] == name] for name in ("along", "y", "here", "last")}
                here = np.zeros(rows_in(key[0]) * k) if fresh else _array(of["here"].iloc[0]) + step * _array(of["last"].iloc[0])
                return pd.DataFrame([(key[0], of["y"].iloc[0], here.tobytes(), _total(of["along"]).tobytes())], columns=["rb", "y", "here", "along"])

            return written(parts.groupBy("rb").applyInPandas(total, "rb int, y binary, here binary, along binary"), "line")

        def losses(line: DataFrame, steps: list[float]) -> list[float]:
            def loss(parts):
                for part in parts:
                    for r in part.itertuples():
                        y = _array(r.y, np.int32)
                        real = np.flatnonzero(y >= 0)
                        here, along = (_array(m).reshape(-1, k)[real] for m in (r.here, r.along))
                        out = []
                        for t in steps:
                            m = here + t * along
                            top = m.max(axis=1)
                            out.append(float((np.log(np.exp(m - top[:, None]).sum(axis=1)) + top - m[np.arange(len(real)), y[real]]).sum()))
                        yield pd.DataFrame({"i": np.arange(len(steps)), "loss": out})

            found = line.mapInPandas(loss, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
            return [r["loss"] / n for r in sorted(found)]

        def products(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
            """Products of all vectors with each other, in order of name, and those that the penalty counts."""
            def gram(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
                every = np.stack([_array(v) for v in part.sort_values("name")["vec"]])
                inside = every * np.broadcast_to(free(key[0]), (features_in(key[0]), k)).reshape(1, -1)
                return pd.DataFrame([((every @ every.T).tobytes(), (inside @ inside.T).tobytes())], columns=["every", "inside"])

            parts = vectors.groupBy("fb").applyInPandas(gram, "every binary, inside binary").toLocalIterator()
            every = inside = 0.0
            for r in parts:
                every, inside = every + _array(r["every"]), inside + _array(r["inside"])
            m = int(np.sqrt(len(every)))
            return every.reshape(m, m), inside.reshape(m, m)

        def combined(vectors: DataFrame, share: np.ndarray, name: str) -> DataFrame:
            def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
                total = sum(c * _array(v) for c, v in zip(share, part.sort_values("name")["vec"]) if c)
                return pd.DataFrame([(key[0], name, np.asarray(total).tobytes())], columns=["fb", "name", "vec"])
            return vectors.groupBy("fb").applyInPandas(add, _VECTORS)

        line = line_along(read(weights), None, 0.0)
        taken = 1.0  # the first line leads from zero to the start
        gradients.append(gradient(line, taken, weights[0], "g0000"))
        for i in range(1, self.max_iter + 1):
            vectors = read(gradients + weights)
            every, inside = products(vectors)
            share = direction(every)
            m = len(weights)
            at = np.eye(2 * m)[2 * m - 1]
            slope = share @ every @ np.eye(2 * m)[m - 1]
            if not slope < 0:
                break
            line = line_along(combined(vectors, share, "d"), line, taken)
            # a first step of unit length, as the scale is not known yet
            first = min(1.0, 1.0 / np.sqrt(every[m - 1, m - 1])) if m == 1 else 1.0
            steps = [0.0, *[first * s for s in STEPS]]
            penalty = [0.5 * reg * (at + t * share) @ inside @ (at + t * share) for t in steps]
            values = np.array(losses(line, steps)) + penalty
            lower = [i for i in range(1, len(steps)) if values[i] <= values[0] + 1e-4 * steps[i] * slope]
            if not lower:
                break
            best = min(lower, key=lambda i: values[i])
            taken = steps[best]
            weights.append(stored(combined(vectors, at + taken * share, f"w{i:04}"), f"w{i:04}"))
            if values[0] - values[best] <= self.tol * max(abs(values[0]), abs(values[best]), 1e-6):
                break
            gradients.append(gradient(line, taken, weights[-1], f"g{i:04}"))
            weights, gradients = weights[-CORRECTIONS - 1:], gradients[-CORRECTIONS - 1:]
        return WideLogisticModel(written(scaled(read(weights[-1:])), "coefficients"), k, n_features, self)


def direction(products: np.ndarray) -> np.ndarray:
    """The L-BFGS direction as shares of vectors whose products are given: gradients of the last points,
    oldest first, then the points."""
    m = len(products) // 2
    unit = np.eye(2 * m)
    steps = [(unit[m + i + 1] - unit[m + i], unit[i + 1] - unit[i]) for i in range(m - 1)]
    steps = [(s, y, s @ products @ y) for s, y in steps]
    steps = [(s, y, sy) for s, y, sy in steps if sy > 0]
    q, alphas = unit[m - 1].copy(), []
    for s, y, sy in reversed(steps):
        alphas.append(s @ products @ q / sy)
        q = q - alphas[-1] * y
    if steps:
        s, y, sy = steps[-1]
        q = q * (sy / (y @ products @ y))
    for (s, y, sy), a in zip(steps, reversed(alphas), strict=True):
        q = q + (a - y @ products @ q / sy) * s
    return -q


class WideLogisticModel(Model):
    """Coefficients as a table of packed blocks (fb, vec) in the shared folder."""

    def __init__(self, coefficients: DataFrame, classes: int, n_features: int, fitted: WideLogistic):
        super().__init__()
        self.coefficients, self.classes, self.n_features = coefficients, classes, n_features
        self.key, self.features, self.row_block, self.feature_block = fitted.key, fitted.features, fitted.row_block, fitted.feature_block

    def _transform(self, dataset: DataFrame) -> DataFrame:
        k, rows = self.classes, _numbered(dataset, self.key, self.row_block)
        blocks = _Blocks(rows, rows.count(), self.features, self.n_features, self.row_block, self.feature_block)

        def spread(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            m = _total(part["part"]).reshape(-1, k)
            p = _softmax(m)
            return pd.DataFrame({"_rb": key[0], "_pos": np.arange(len(m), dtype=np.int32), "_raw": list(m), "_p": list(p)})

        found = blocks.margins(self.coefficients, k).groupBy("rb").applyInPandas(
            spread, "_rb int, _pos int, _raw array<double>, _p array<double>")
        return rows.join(found, ["_rb", "_pos"], "left").select(
            *dataset.columns, array_to_vector("_raw").alias("rawPrediction"), array_to_vector("_p").alias("probability"),
            (F.array_position("_raw", F.array_max("_raw")) - 1).cast("double").alias("prediction"))
