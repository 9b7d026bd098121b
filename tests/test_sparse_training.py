"""Sparse large-margin fits: equal to dense ones, equal on both ways of passing, optimal."""

import os
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright.operators import margin as mg, sparse_training as sp, training as tr
from tagwright.sources.scratch import materialize, scratch_root

N, D = 160, 30


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = np.where(rng.random((N, D)) < 0.2, rng.standard_normal((N, D)), 0.0)
    x[5] = 0.0  # a row without entries
    label = (x @ rng.standard_normal(D) + 0.3 * rng.standard_normal(N) > 0).astype(int) + 2 * (x[:, 0] > 0.5)
    cells = [(i, f"f{j:02d}", float(x[i, j])) for i in range(N) for j in range(D) if x[i, j]]
    features = materialize(spark.createDataFrame(cells + [(9_999, "other", 1.0)], "id long, feature string, value double"), "cells")
    labels = spark.createDataFrame([(i, int(label[i])) for i in range(N)] + [(9_998, None)], "id long, classLabel int")
    return x, label, features, materialize(labels, "labels")


def table(fit, names):
    """weights by model, features and then the bias"""
    got = {(r.model_id, r.feature): r.weight for r in fit.weights.collect()}
    order = [f"f{j:02d}" for j in range(D)] + [mg.BIAS]
    return np.array([[got[m, f] for f in order] for m in names])


SPECS = [sp.SparseSpec("two", 1.0, 2), sp.SparseSpec("any", 0.25), sp.SparseSpec("heavy", 4.0, 1, (3.0, 0.5))]


@pytest.fixture(scope="module")
def fitted(data):
    return sp.fit_sparse(sp.sparse_training_rows(data[2], data[3]), SPECS, tolerance=1e-4)


def test_equals_the_dense_fit(spark, data, fitted):
    x, label, _, labels = data
    vectors = spark.createDataFrame([(i, x[i].tolist()) for i in range(N)], "id long, vec array<double>")
    ours = table(fitted, [s.model_id for s in SPECS])
    for s, row in zip(SPECS, ours, strict=True):
        params = tr.MarginParams(s.C, 1.0, "linear", {1: s.weights[0], 0: s.weights[1]}, tolerance=1e-4)
        model = tr.fit_specs(tr.training_table(vectors, labels), [tr.Spec("m", s.C, 1.0, s.positive)], params)
        assert row == pytest.approx(model.weights[0], abs=0.02)
        assert {r.model_id: r.loss for r in fitted.report.collect()}[s.model_id] == pytest.approx(model.losses[0], rel=1e-4)


def test_weights_are_optimal(data, fitted):
    """The gradient of the objective at the stored weights, worked out anew."""
    x, label, _, _ = data
    for s, w in zip(SPECS, table(fitted, [s.model_id for s in SPECS]), strict=True):
        positive = label > 0 if s.positive is None else label == s.positive
        y, use = np.where(positive, 1.0, -1.0), np.where(positive, *s.weights)
        slope = lambda w: np.clip((1 - y * (x @ w[:-1] + w[-1])) / 0.1, 0, 1) * -y * use  # noqa: B023, E731
        grad = lambda w: np.append(w[:-1] + s.C * x.T @ slope(w), s.C * slope(w).sum())  # noqa: B023, E731
        assert np.linalg.norm(grad(w)) <= 2e-4 * np.linalg.norm(grad(np.zeros(D + 1)))
    assert all(r.gradient <= 1e-4 and r.passes > 1 for r in fitted.report.collect())


def test_sharded_pass_equals_the_broadcast_one(data, fitted):
    """Four features to a shard, few entries to a chunk, and nothing may be broadcast."""
    rows = sp.sparse_training_rows(data[2], data[3], chunk_entries=100, shard_features=4)
    assert rows.n_shards > 5 and rows.chunks.count() > 5 and rows.n_rows == N and rows.n_features == D + 1
    again = sp.fit_sparse(rows, SPECS[:1], tolerance=0.3)
    for limits in ({"broadcast_limit": 0}, {"driver_limit": 0}):
        loose = sp.fit_sparse(rows, SPECS[:1], tolerance=0.3, **limits)
        assert table(loose, ["two"]) == pytest.approx(table(again, ["two"]), abs=1e-9)
        assert loose.report.first().passes == again.report.first().passes
    whole = sp.fit_sparse(rows, SPECS[:1], tolerance=1e-4)
    assert table(whole, ["two"]) == pytest.approx(table(fitted, ["two"]), abs=0.02)


def test_scores_and_edges(spark, data, fitted):
    x, label, features, labels = data
    ids = labels.select("id").where("id < 9000")
    scores = mg.decision_values(features.where("id < 9000"), fitted.weights, ids)
    found = {(r.id, r.model_id): r.decision for r in scores.collect()}
    want = table(fitted, ["any"])[0]
    for i in range(N):
        assert found[i, "any"] == pytest.approx(x[i] @ want[:-1] + want[-1])
    with pytest.raises(ValueError):
        sp.sparse_training_rows(features, labels.where("false"))
    with pytest.raises(RuntimeError):
        sp.fit_sparse(sp.sparse_training_rows(features, labels), SPECS, tolerance=1e-9, max_passes=2)
    one = labels.where("id = 3")  # one row: a bias and its entries
    only = sp.fit_sparse(sp.sparse_training_rows(features, one), [sp.SparseSpec("m", 1.0, int(label[3]))])
    assert only.weights.where(F.col("feature") == mg.BIAS).count() == 1


def test_history_of_a_usual_vocabulary_stays_on_the_driver(data, monkeypatch):
    """Passes of half a million features need no tables; models that are fitted take no part in them."""
    rows = sp.sparse_training_rows(data[2], data[3])
    wide = replace(rows, n_features=500_000)
    seen = []
    whole = sp._whole_pass
    monkeypatch.setattr(sp, "_whole_pass", lambda chunks, weights, specs, smooth: seen.append(len(specs)) or whole(chunks, weights, specs, smooth))
    monkeypatch.setattr(sp, "_InTables", None)
    fit = sp.fit_sparse(wide, SPECS, tolerance=1e-2)
    assert seen[0] == 3 and seen[-1] < 3
    assert sum(seen) == sum(r.passes for r in fit.report.collect())


def scratch_tables(spark):
    """Tables by the kind of what they hold, in the scratch folder."""
    names = os.listdir(scratch_root(spark).removeprefix("file://"))
    return Counter(re.sub(r"-[0-9a-f]{32}$", "", n) for n in names if n.startswith("tagwright-sparse-"))


@pytest.mark.parametrize("entries, limits", [(20, {}), (100, {"driver_limit": 0}), (100, {"broadcast_limit": 0})])
def test_passes_leave_no_tables_behind(spark, data, entries, limits):
    """However many passes there are, only the rows, their vocabulary and the fitted weights stay."""
    rows = sp.sparse_training_rows(data[2], data[3], chunk_entries=entries, shard_features=16)
    before = scratch_tables(spark)
    fit = sp.fit_sparse(rows, SPECS[:1], tolerance=0.3, **limits)
    assert fit.report.first().passes > 1
    assert scratch_tables(spark) - before == Counter({"tagwright-sparse-weights": 1})
    assert not {"tagwright-sparse-entries", "tagwright-sparse-labels", "tagwright-sparse-placed"} & set(before)


def test_descent_over_rows_equals_the_one_over_weights(spark, data, fitted, monkeypatch):
    """With several chunks for a core nothing as long as the vocabulary is moved in a pass."""
    cores = spark.sparkContext.defaultParallelism
    rows = sp.sparse_training_rows(data[2], data[3], chunk_entries=20, shard_features=4)
    assert rows.n_chunks > 4 * cores
    whole = sp.fit_sparse(replace(rows, n_chunks=1), SPECS, tolerance=0.1)
    monkeypatch.setattr(sp, "_whole_pass", None)
    for few in (True, False):
        if not few:
            monkeypatch.setattr(sp, "DRIVER_BYTES", 0)
        fit = sp.fit_sparse(rows, SPECS, tolerance=0.1)
        names = [s.model_id for s in SPECS]
        assert table(fit, names) == pytest.approx(table(whole, names), abs=1e-6)
        passes = {r.model_id: r.passes for r in whole.report.collect()}
        assert {r.model_id: r.passes for r in fit.report.collect()} == passes
    close = sp.fit_sparse(rows, SPECS, tolerance=1e-4)
    assert table(close, names) == pytest.approx(table(fitted, names), abs=0.02)
