"""Probabilities from decision values, for any number of models at once.

Each model gets a sigmoid of its own (Platt 1999): its two parameters minimise the cross entropy
against smoothed targets.  All models take Newton steps together, each step one grouped sum of
losses, gradients and curvatures; the driver holds two numbers per model.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import materialize
from .lookup import fits_broadcast

PARAMS = "model_id string, a double, b double"


def _with_params(rows: DataFrame, params: DataFrame, n_models: int, how: str = "inner") -> DataFrame:
    """``rows`` with their model's parameters; two numbers and a name per model are sent."""
    return rows.join(F.broadcast(params) if fits_broadcast(n_models, 64) else params, "model_id", how)


def _sums(x: Column, t: Column) -> list[Column]:
    """Cross entropy of a sigmoid at ``a z + b``, its gradient and its curvature."""
    p = 1 / (1 + F.exp(-x))
    w, z = p * (1 - p), F.col("z")
    loss = F.log1p(F.exp(-F.abs(x))) + F.greatest(x, F.lit(0.0)) - t * x
    cells = {"loss": loss, "ga": (p - t) * z, "gb": p - t, "aa": w * z * z, "ab": w * z, "bb": w}
    return [F.sum(c).alias(name) for name, c in cells.items()]


def calibrate_all(scores: DataFrame, tolerance: float = 1e-10, max_steps: int = 100) -> DataFrame:
    """``(model_id, a, b)``: the probability of the positive side is a sigmoid of ``a * decision + b``.

    ``scores`` is ``(model_id, decision, y)``, best from held-out rows.  Targets are (n1 + 1) / (n1 + 2)
    for the n1 positive rows and 1 / (n0 + 2) for the n0 others, so rows that a threshold separates,
    or a model with one side only, still have finite parameters."""
    spark = scores.sparkSession
    known = scores.where(F.col("y").isNotNull() & F.col("decision").isNotNull())
    known = known.select(F.col("model_id").cast("string").alias("model_id"), F.col("decision").cast("double"), (F.col("y") > 0).alias("y"))
    rows = materialize(known, "calibration")
    shape = rows.groupBy("model_id").agg(
        F.avg("decision").alias("mean"), F.coalesce(F.stddev_pop("decision"), F.lit(0.0)).alias("spread"),
        F.count_if("y").alias("n1"), F.count_if(~F.col("y")).alias("n0"),
    )
    shapes = sorted(shape.collect(), key=lambda r: r["model_id"])  # a row a model
    if not shapes:
        return spark.createDataFrame([], PARAMS)
    names, n_models = [r["model_id"] for r in shapes], len(shapes)
    place = {name: i for i, name in enumerate(names)}
    fixed = spark.createDataFrame(
        [(r["model_id"], r["mean"], r["spread"] or 1.0, (r["n1"] + 1) / (r["n1"] + 2), 1 / (r["n0"] + 2)) for r in shapes],
        "model_id string, mean double, spread double, t1 double, t0 double",
    )
    z = (F.col("decision") - F.col("mean")) / F.col("spread")
    target = F.when(F.col("y"), F.col("t1")).otherwise(F.col("t0"))
    rows = materialize(_with_params(rows, fixed, n_models).select("model_id", z.alias("z"), target.alias("t")), "calibration")
    now, step, length = np.zeros((n_models, 2)), np.zeros((n_models, 2)), np.ones(n_models)
    value, moving = np.full(n_models, np.inf), np.ones(n_models, bool)
    for _ in range(max_steps):
        trial = now + length[:, None] * step
        at = spark.createDataFrame([(names[i], float(trial[i, 0]), float(trial[i, 1])) for i in np.flatnonzero(moving)], PARAMS)
        found = _with_params(rows, at, n_models).groupBy("model_id").agg(*_sums(F.col("a") * F.col("z") + F.col("b"), F.col("t")))
        for r in found.collect():
            i = place[r["model_id"]]
            if r["loss"] > value[i] + 1e-12 * abs(value[i]):
                length[i] /= 2
                moving[i] = length[i] > 1e-9
                continue
            now[i], value[i], length[i] = trial[i], r["loss"], 1.0
            gradient = np.array([r["ga"], r["gb"]])
            curvature = np.array([[r["aa"], r["ab"]], [r["ab"], r["bb"]]])
            step[i] = -np.linalg.lstsq(curvature, gradient, rcond=1e-14)[0]
            moving[i] = np.abs(gradient).max() > tolerance * (shapes[i]["n1"] + shapes[i]["n0"])
        if not moving.any():
            break
    else:
        raise RuntimeError(f"{int(moving.sum())} of {n_models} sigmoids not fitted after {max_steps} steps")
    out = []
    for r, (a, b) in zip(shapes, now, strict=True):
        spread = r["spread"] or 1.0
        out.append((r["model_id"], float(a / spread), float(b - a * r["mean"] / spread)))
    return spark.createDataFrame(out, PARAMS)


def model_probabilities(scores: DataFrame, calibration: DataFrame) -> DataFrame:
    """``scores`` with ``p_0`` and ``p_1``; a score of a model that was not calibrated is an error."""
    own = calibration.withColumnsRenamed({"a": "_a", "b": "_b"})
    keyed = scores.withColumn("model_id", F.col("model_id").cast("string"))
    joined = _with_params(keyed, own, calibration.count(), "left")
    missing = F.raise_error(F.lit("the model does not support probability estimates")).cast("double")
    p = F.when(F.col("_a").isNull(), missing).otherwise(1 / (1 + F.exp(-(F.col("_a") * F.col("decision") + F.col("_b")))))
    return joined.withColumn("p_1", p).withColumn("p_0", 1 - F.col("p_1")).select(*scores.columns, "p_0", "p_1")
