import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from zoneflow.operators import models
from zoneflow.operators.wide_logistic import WideLogistic, direction


def sparse_rows(spark, n=160, classes=3):
    rng = np.random.default_rng(1)
    data = []
    for i in range(n):
        x = {int(j): float(rng.integers(1, 4)) for j in rng.choice(20, 4, replace=False)}
        x[i % classes * 3] = x.get(i % classes * 3, 0.0) + 1.0
        v = Vectors.sparse(23, x)
        data.append((i // 2 if i > 3 else None, float(i % classes), v if i % 2 else Vectors.dense(v.toArray())))
    return spark.createDataFrame(data, ["id", "label", "features"])


def test_coefficients_in_blocks_give_the_probabilities_of_sparks_fit(spark):
    """Rows and features in several blocks, keys that repeat or are null, dense and sparse vectors."""
    rows = sparse_rows(spark)
    model = WideLogistic(["id"], max_iter=25, reg=0.05, row_block=64, feature_block=8).fit(rows)
    assert model.coefficients.count() == 3 and model.coefficients.columns == ["fb", "vec"]
    whole = models.logistic(maxIter=50, regParam=0.05).fit(rows)
    def listed(df):
        return sorted((str(r["id"]), r["label"], str(r["features"].toArray()), *r["probability"], r["prediction"]) for r in df.collect())
    mine, theirs = listed(model.transform(rows)), listed(whole.transform(rows))
    assert len(mine) == 160 and [r[:3] for r in mine] == [r[:3] for r in theirs]
    assert np.abs(np.array([r[3:6] for r in mine]) - np.array([r[3:6] for r in theirs])).max() < 5e-3
    assert [r[6] for r in mine] == [r[6] for r in theirs]


def test_missing_label_fails(spark):
    rows = sparse_rows(spark, 8).selectExpr("id", "CASE WHEN label < 2 THEN label END AS label", "features")
    with pytest.raises(Exception, match="label is missing"):
        WideLogistic(["id"], max_iter=1).fit(rows)


def test_direction_solves_a_quadratic():
    """Along the exact minima of a quadratic in two variables the second direction ends at the minimum."""
    a = np.diag([1.0, 10.0])
    points = [np.array([10.0, 1.0])]
    for _ in range(3):
        every = np.stack([*(a @ p for p in points), *points])
        d = direction(every @ every.T) @ every
        points.append(points[-1] - (d @ a @ points[-1]) / (d @ a @ d) * d)
        if np.abs(points[-1]).max() < 1e-9:
            break
    assert np.abs(points[-1]).max() < 1e-6
