"""Sigmoids of many models: optimal, finite, used in evaluation and final predictions."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tagwright.operators.calibration import calibrate_all, model_probabilities


def targets(y):
    n1, n0 = y.sum(), (~y).sum()
    return np.where(y, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(2)
    rows = []
    for name, shift, scale in (("a", 0.0, 1.0), ("b", 50.0, 1e-3), ("far", -3.0, 400.0)):
        d = rng.standard_normal(300)
        y = rng.random(300) < 1 / (1 + np.exp(-2 * d))
        rows += [(name, float(shift + scale * v), int(t)) for v, t in zip(d, y)]
    rows += [("separable", float(i), int(i > 4)) for i in range(10)]
    rows += [("one side", float(i), 0) for i in range(10)] + [("constant", 1.0, i % 2) for i in range(11)]
    rows += [("a", 1.0, None), ("a", None, 1)]
    return rows, spark.createDataFrame(rows, "model_id string, decision double, y int")


def test_gradient_vanishes(scores):
    rows, table = scores
    found = {r.model_id: (r.a, r.b) for r in calibrate_all(table).collect()}
    assert set(found) == {"a", "b", "far", "separable", "one side", "constant"}
    for name, (a, b) in found.items():
        own = [(d, t) for n, d, t in rows if n == name and d is not None and t is not None]
        d, y = np.array([o[0] for o in own]), np.array([o[1] > 0 for o in own])
        p = 1 / (1 + np.exp(-(a * d + b)))
        spread = d.std() or 1.0
        assert abs(((p - targets(y)) * (d - d.mean()) / spread).sum()) < 1e-6 * len(d)
        assert p.mean() == pytest.approx(targets(y).mean(), abs=1e-8)
    assert found["a"][0] == pytest.approx(2, rel=0.4) and found["separable"][0] > 0


def test_probabilities(spark, scores):
    params = calibrate_all(scores[1])
    asked = spark.createDataFrame([(1, "a", 0.3), (1, "b", 50.0), (2, "a", None)], "id long, model_id string, decision double")
    got = model_probabilities(asked, params)
    assert got.columns == ["id", "model_id", "decision", "p_0", "p_1"]
    for r in got.where("decision is not null").collect():
        assert r.p_0 + r.p_1 == pytest.approx(1) and 0 < r.p_1 < 1
    with pytest.raises(PySparkException, match="probability estimates"):
        model_probabilities(asked.withColumn("model_id", F.lit("unknown")), params).collect()
    assert calibrate_all(scores[1].where("false")).count() == 0
