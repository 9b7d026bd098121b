import math

import numpy as np
import pytest

from tagwright.operators import bayes as nb

RNG = np.random.default_rng(5)
N, D = 60, 6
X = RNG.integers(0, 3, (N, D)).astype(float) * (RNG.random((N, D)) < 0.6)
X[:, 5] = 1.0  # constant: never usable
X[1, 0] = 900.0  # far enough to underflow in the test rows
Y = RNG.integers(0, 3, N)
TEST = np.arange(N) % 4 == 1
X[5] = 0.0  # a test row without any stored value


@pytest.fixture(scope="module")
def data(spark):
    cells = [(i, f"f{j}", float(X[i, j])) for i in range(N) for j in range(D) if X[i, j] != 0]
    features = spark.createDataFrame(cells, "id long, feature string, value double")
    rows = spark.createDataFrame([(i, int(Y[i]), bool(TEST[i])) for i in range(N)], "id long, classLabel int, test boolean")
    return features, rows.where("NOT test").drop("test"), rows.where("test").drop("test")


def dense_scores(density, log_terms=False):
    xs, ys, out = X[~TEST], Y[~TEST], []
    classes = sorted(set(ys))
    std = np.array([xs[ys == c].std(axis=0, ddof=1) for c in classes])
    mean = np.array([xs[ys == c].mean(axis=0) for c in classes])
    usable = (std > 0).all(axis=0)
    for x in X[TEST]:
        row = []
        for k, c in enumerate(classes):
            total = math.log((ys == c).mean())
            for j in np.flatnonzero(usable):
                if density == "gaussian":
                    p = math.exp(-((x[j] - mean[k, j]) ** 2) / (2 * std[k, j] ** 2)) / (math.sqrt(2 * math.pi) * std[k, j])
                    total += math.log(p) if p > 0 else 0.0
                    continue
                if density == "bernoulli":
                    p = mean[k, j] if x[j] else 1 - mean[k, j]
                else:
                    p = (xs[ys == c][:, j] == x[j]).mean()
                    if p == 0:
                        continue
                total += (math.log(p) if p > 0 else 0.0) if log_terms else p
            row.append(total)
        out.append(row)
    return np.array(out)


@pytest.mark.parametrize("density,log_terms", [
    ("gaussian", False), ("bernoulli", False), ("bernoulli", True), ("multinoulli", False), ("multinoulli", True)
])
def test_sparse_scores_equal_dense(data, density, log_terms):
    features, train, test = data
    model = nb.fit_bayes(features, train, density, log_terms)
    got = nb.log_posterior(features, test, model).orderBy("id").collect()
    expected = dense_scores(density, log_terms)
    np.testing.assert_allclose([r["scores"] for r in got], expected, atol=1e-9)
    for r in got:
        assert sum(math.exp(p) for p in r["posterior"]) == pytest.approx(1.0)


def test_spread_join_gives_the_same_scores(data, monkeypatch):
    features, train, test = data
    model = nb.fit_bayes(features, train)
    small = nb.log_posterior(features, test, model).orderBy("id").collect()
    from tagwright.operators import lookup
    monkeypatch.setattr(lookup, "HOT_MIN_ROWS", 1)
    spread = nb.log_posterior(features, test, model, broadcast_limit=0).orderBy("id").collect()
    np.testing.assert_allclose([r["scores"] for r in small], [r["scores"] for r in spread])


def test_moments_include_zeros_nulls_and_single_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1)], "id long, classLabel int")
    cells = [(1, "a", 2.0), (2, "a", None), (4, "a", 5.0), (1, "b", 1.0)]
    features = spark.createDataFrame(cells, "id long, feature string, value double")
    got = {(r["feature"], r["classLabel"]): (r["mean"], r["std"]) for r in nb.class_moments(features, labels).collect()}
    assert got[("a", 0)] == pytest.approx((1.0, math.sqrt(2.0)))  # values 2 and 0, the null left out
    assert got[("a", 1)] == (5.0, None) and got[("b", 1)] == (0.0, None)
    assert nb.usable_features(nb.class_moments(features, labels)).count() == 0


def test_predict_ties_and_accuracy(spark):
    scored = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.1, 0.9])], "id long, posterior array<double>")
    predicted = nb.predict(scored, [3, 8])
    assert {r["id"]: r["pred"] for r in predicted.collect()} == {1: 3, 2: 8}
    truth = spark.createDataFrame([(1, 3), (2, 3), (9, 3)], "id long, classLabel int")
    assert nb.accuracy(predicted, truth).first()["accuracy"] == pytest.approx(100 / 3)


def test_informative_features(spark):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "id long, classLabel int")
    cells = [(1, "both", 7.0), (3, "both", 1.0), (4, "both", 2.0), (1, "first", 1.0)]
    features = spark.createDataFrame(cells, "id long, feature string, value double")
    rows = {r["feature"]: r for r in nb.informative_features(features, labels).collect()}
    assert rows["both"]["ratio_0"] == 0.5 and rows["both"]["ratio_1"] == 2.0 and rows["both"]["likelier"] == 1
    assert rows["first"]["ratio_0"] == 0.0 and rows["first"]["ratio_1"] == 0.0
    top = nb.informative_features(features, labels, k=1, ignore_inf=False).first()
    assert top["feature"] == "first" and top["best"] == 9999.0


def test_unknown_density(data):
    with pytest.raises(ValueError):
        nb.fit_bayes(data[0], data[1], "poisson")
