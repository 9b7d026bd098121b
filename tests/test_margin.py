import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagwright.operators import evaluate as ev, margin as mg, training as tr
from tagwright.plans import multiclass

SMALL = tr.MarginParams(n_components=64)


@pytest.fixture(scope="module")
def model(spark):
    rows = [("m", "a", 2.0), ("m", "b", -1.0), ("m", mg.BIAS, 0.5), ("zero", "a", 0.0), ("zero", "b", 0.0)]
    return spark.createDataFrame(rows, "model_id string, feature string, weight double")


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "b", 3.0), (2, "x", 9.0)], "id long, feature string, value double")


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_decisions_distance_and_labels(spark, features, model, limit):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    scores = mg.decision_values(features, model, ids, broadcast_limit=limit)
    got = {(r["id"], r["model_id"]): r["decision"] for r in scores.collect()}
    assert got == {(1, "m"): 1.5, (2, "m"): -2.5, (3, "m"): 0.5, (1, "zero"): 0.0, (2, "zero"): 0.0, (3, "zero"): 0.0}
    far = mg.hyperplane_distance(scores, mg.squared_norms(model))
    got = {(r["id"], r["model_id"]): r["distance"] for r in far.collect()}
    assert got[(2, "m")] == 0.5 and got[(1, "zero")] == 0.0
    signed = mg.hyperplane_distance(scores, mg.squared_norms(model), signed=True, scale="norm")
    assert {r["distance"] for r in signed.where("id = 2 AND model_id = 'm'").collect()} == {-2.5 / np.sqrt(5)}
    labels = {(r["id"], r["model_id"]): r["pred"] for r in mg.predict_sign(scores).collect()}
    assert labels[(1, "m")] == 1 and labels[(2, "m")] == 0 and labels[(1, "zero")] == 0
    cautious = {r["id"]: r["pred"] for r in mg.cautious_predict(mg.predict_sign(scores)).collect()}
    assert cautious == {1: 1, 2: 0, 3: 1}
    with pytest.raises(ValueError):
        mg.cautious_predict(mg.predict_sign(scores).limit(0))


def test_export_and_pairwise_table(spark, model):
    rows = mg.export_model(model).where("model_id = 'm'").collect()
    assert {(r["feature"], r["coef"], r["rho"]) for r in rows} == {("a", 2.0, -0.5), ("b", -1.0, -0.5)}
    scores = spark.createDataFrame([(1, 0, 2, 0.7)], "id long, i int, j int, decision double")
    assert {tuple(r) for r in mg.ovo_table(scores).collect()} == {(1, 0, 2, 0.7), (1, 2, 0, -0.7)}


def blobs(spark, n=120, classes=2, gap=4.0, d=3, seed=0):
    rng = np.random.default_rng(seed)
    centers = gap * np.eye(max(classes, d))[:classes, :d]
    rows = [(i, [float(v) for v in centers[i % classes] + rng.standard_normal(d) * 0.5], i % classes) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, classLabel int")
    return df.select("id", "vec"), df.select("id", "classLabel")


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_separable_rows_are_all_right(spark, kernel):
    x, y = blobs(spark)
    params = tr.MarginParams(kernel=kernel, n_components=128, C=4.0)
    fitted = tr.fit_margin(x, y, params)
    predicted = mg.predict_sign(tr.margin_decisions(x, fitted)).join(y, "id")
    assert ev.multiclass_accuracy(predicted).first()["accuracy"] == 100.0
    again = tr.fit_margin(x.repartition(3), y, params)
    np.testing.assert_allclose(fitted.weights, again.weights, atol=1e-6)


def test_partial_sums_add_up_either_way(spark, monkeypatch):
    x, y = blobs(spark, gap=1.0)
    monkeypatch.setattr(tr, "BATCH_ROWS", 16)
    direct = tr.fit_margin(x, y, SMALL)
    monkeypatch.setattr(tr, "DRIVER_BYTES", 0)
    np.testing.assert_allclose(direct.weights, tr.fit_margin(x, y, SMALL).weights, atol=1e-6)


def test_linear_fit_reaches_the_optimum(spark):
    """The objective is convex: no random step from the result may lower it."""
    x, y = blobs(spark, n=60, gap=1.0)
    fitted = tr.fit_margin(x, y, tr.MarginParams(kernel="linear", C=1.0, tolerance=1e-7))
    rows = x.join(y, "id").collect()
    matrix = np.array([r["vec"] + [1.0] for r in rows])
    sign = np.array([1.0 if r["classLabel"] else -1.0 for r in rows])

    def objective(w):
        return 0.5 * (w[:-1] ** 2).sum() + tr._rounded_hinge(sign * (matrix @ w), 0.1)[0].sum()

    best, rng = objective(fitted.weights[0]), np.random.default_rng(1)
    assert best == pytest.approx(fitted.losses[0])
    assert best < objective(np.zeros(4))
    for size in (1e-1, 1e-2, 1e-3):
        for _ in range(50):
            assert objective(fitted.weights[0] + size * rng.standard_normal(4)) > best - 1e-7


def test_random_features_approach_the_kernel():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((30, 5))
    exact = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(-1))
    errors = []
    for n in (64, 4096):
        z = tr._mapper("rbf", 5, n, 7)(x, 0.2, {})[:, :-1]
        errors.append(np.abs(z @ z.T - exact).max())
    assert errors[1] < 0.1 and errors[1] < errors[0]


def test_class_weights_move_the_boundary(spark):
    x, y = blobs(spark, gap=0.3)
    plain = tr.fit_margin(x, y, tr.MarginParams(kernel="linear"))
    heavy = tr.fit_margin(x, y, tr.MarginParams(kernel="linear", weights={1: 20.0}))
    count = lambda m: mg.predict_sign(tr.margin_decisions(x, m)).where("pred = 1").count()
    assert count(heavy) > count(plain)


def test_cross_validation_scores_every_row_once(spark):
    x, y = blobs(spark)
    points = [(0.25, 0.1), (4.0, 0.1), (4.0, 1.0)]
    predicted = tr.cv_predictions(x, y, points, 4, SMALL)
    counts = predicted.groupBy("C", "gamma").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert len(counts) == 3 and all(r["n"] == 120 and r["d"] == 120 for r in counts)
    best = tr.grid_search(x, y, 3, (-2, 3, 2), (-3, 2, 2), params=SMALL)
    c, gamma = best.C, best.gamma
    assert (c, gamma) in {(c, g) for c in ev.power_list(-2, 3, 2) for g in ev.power_list(-3, 2, 2)}
    assert tr.grid_search(x, y, 3, (-2, 3, 2), linear=True, params=SMALL).kernel == "linear"


def test_probabilities(spark):
    x, y = blobs(spark, gap=1.0)
    held_out = tr.cv_decisions(x, y, [(1.0, 0.3)], 3, SMALL).select("id", "decision")
    calibration = tr.calibrate(held_out, y)
    rows = tr.probabilities(held_out, calibration).orderBy("decision").collect()
    assert all(r["p_0"] + r["p_1"] == pytest.approx(1.0) for r in rows)
    assert [r["p_1"] for r in rows] == sorted(r["p_1"] for r in rows)
    with pytest.raises(TypeError):
        tr.probabilities(held_out, None)


def test_one_learner_per_class(spark):
    x, y = blobs(spark, n=150, classes=3)
    classes = multiclass.class_list(y)
    fitted = multiclass.train_per_class(x, y, classes, SMALL)
    assert classes == [0, 1, 2] and [s.model_id for s in fitted.specs] == ["0", "1", "2"]
    assert multiclass.test_accuracy(x, y, fitted).first()["accuracy"] == 100.0
    assert multiclass.class_tasks(y).count() == 450
    pool = x.withColumn("origText", F.lit("t"))
    final = multiclass.predict_pool(x, fitted, y.where("id < 100"), pool, {0: "a", 1: "b", 2: "c"})
    rows = final.collect()
    assert len(rows) == 50 and all(r["name"] == "abc"[r["id"] % 3] for r in rows)


def predictions(spark, rows):
    return spark.createDataFrame(rows, "C double, gamma double, classLabel int, pred int")


def test_confusion_and_metrics(spark):
    rows = [(1.0, 1.0, 1, 1)] * 3 + [(1.0, 1.0, 0, 1)] * 2 + [(1.0, 1.0, 0, 0)] * 4 + [(1.0, 1.0, 1, 0)]
    df = predictions(spark, rows)
    assert tuple(ev.confusion(df).first()) == (3, 2, 4, 1)
    row = ev.learner_metrics(df).first()
    assert row["accuracy"] == 0.7 and row["sensitivity"] == 0.75 and row["npos"] == 0
    labeled = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id long, classLabel int")
    row = ev.learner_metrics(df, labeled).first()
    assert (row["npos"], row["tp"], row["tn"]) == (1, 4, 6)
    assert ev.learner_metrics(df.limit(0)).first() is None
    assert ev.learner_metrics(predictions(spark, [(1.0, 1.0, 1, 0)])).first()["sensitivity"] == 0.0


def test_grid_choice(spark):
    rows = [(2.0, 1.0, 0, 0), (2.0, 1.0, 1, 0), (1.0, 4.0, 0, 0), (1.0, 4.0, 1, 0), (1.0, 2.0, 1, 1)]
    metrics = ev.grid_metrics(predictions(spark, rows))
    got = {(r["C"], r["gamma"]): r["metric"] for r in metrics.collect()}
    assert got[(2.0, 1.0)] == 11.0 and got[(1.0, 4.0)] == 11.0  # no true positive counts as 1
    assert got[(1.0, 2.0)] is None  # no negatives
    best = ev.grid_best(metrics).first()
    assert (best["C"], best["gamma"]) == (1.0, 4.0)
    assert ev.power_list(-4, 10, 2) == [2.0**d for d in (-4, -2, 0, 2, 4, 6, 8)]
    points = ev.grid_points(spark.range(2), linear=True)
    assert points.count() == 14 and {r["gamma"] for r in points.collect()} == {1.0}
    assert ev.grid_points(spark.range(1)).count() == 49


def test_a_fit_that_does_not_converge_is_an_error(spark):
    x, y = blobs(spark, n=40, gap=1.0)
    with pytest.raises(RuntimeError, match="not fitted after 3 passes"):
        tr.fit_margin(x, y, tr.MarginParams(kernel="linear", tolerance=1e-9, max_passes=3))


def test_rows_are_mapped_in_bounded_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000))], names=["id"])
    pieces = list(tr._pieces([batch]))
    assert max(p.num_rows for p in pieces) <= 1_024
    assert [x for p in pieces for x in p.column(0).to_pylist()] == list(range(10_000))
