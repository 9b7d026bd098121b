import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tagwright.catalog import QUERIES, SQL
from tagwright.operators import blocks, knn, margin as mg
from tagwright.sources.scratch import scratch_root

RNG = np.random.default_rng(3)


def brute_force(test, train, k):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    sims = np.round(unit(test) @ unit(train).T, 10)
    return {(i, j) for i in range(len(test)) for j in range(len(train)) if (sims[i] >= sims[i, j]).sum() <= k}


def vectors(spark, matrix, labels=None):
    rows = [(i, [float(v) for v in row], 0 if labels is None else labels[i]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, vec array<double>, classLabel int")


def pairs(df):
    return {(r["test_id"], r["train_id"]) for r in df.collect()}


@pytest.mark.parametrize("block_rows", [8192, 7])
def test_dense_neighbours_with_ties(spark, block_rows):
    train = RNG.integers(0, 2, (40, 3)).astype(float)  # few distinct rows: many ties, zero rows
    test = RNG.integers(0, 3, (15, 3)).astype(float)
    for k in (1, 4, 12):
        got = blocks.cosine_neighbours(vectors(spark, test), vectors(spark, train), k, block_rows=block_rows)
        assert pairs(got) == brute_force(test, train, k)


@pytest.mark.parametrize("block_rows", [8192, 9])
def test_sparse_neighbours(spark, block_rows):
    matrix = RNG.integers(-1, 4, (50, 12)) * (RNG.random((50, 12)) < 0.3)
    matrix = matrix.astype(float)
    matrix[[0, 45]] = 0.0
    cells = [(i, f"t{j}", float(matrix[i, j])) for i in range(50) for j in range(12) if matrix[i, j]]
    features = spark.createDataFrame(cells, "id long, feature string, value double")
    ids = spark.range(50).selectExpr("id", "cast(id % 2 as int) as classLabel")
    rows = blocks.sparse_rows(features, ids).join(ids, "id")
    got = blocks.cosine_neighbours(rows.where("id < 20"), rows.where("id >= 20"), 3, block_rows=block_rows)
    expected = {(i, j + 20) for i, j in brute_force(matrix[:20], matrix[20:], 3)}
    assert pairs(got) == expected
    asked = spark.createDataFrame([(0, 21), (1, 22), (2, 2)], "a long, b long")
    sims = {(r["a"], r["b"]): r["similarity"] for r in knn.pair_cosines_sparse(asked, features).collect()}
    assert sims[(0, 21)] == 0.0


def test_fewer_training_rows_than_k(spark):
    train = np.array([[1.0, 0.0], [0.0, 1.0]])
    got = blocks.cosine_neighbours(vectors(spark, np.array([[1.0, 0.5]])), vectors(spark, train), 5)
    assert pairs(got) == {(0, 0), (0, 1)}


def test_votes_prediction_and_missing_neighbours(spark):
    rows = [(1, 10, 2, 0.9), (1, 11, 0, 0.8), (1, 12, 0, 0.7), (2, 10, 1, 0.9), (2, 13, 0, 0.8)]
    found = spark.createDataFrame(rows, "test_id long, train_id long, classLabel int, similarity double")
    shares = knn.votes(found)
    got = {(r["test_id"], r["classLabel"]): r["share"] for r in shares.collect()}
    assert got[(1, 0)] == pytest.approx(2 / 3) and got[(2, 1)] == 0.5
    predicted = knn.predict(shares)
    assert {r["id"]: r["pred"] for r in predicted.collect()} == {1: 0, 2: 0}
    truth = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "id long, classLabel int")
    assert knn.knn_accuracy(predicted, truth).first()["accuracy"] == pytest.approx(100 / 3)


@pytest.mark.parametrize("kind", ["linear", "poly", "rbf", "sigmoid"])
@pytest.mark.parametrize("cosine", [False, True])
def test_kernel_sums(spark, kind, cosine):
    a, b = RNG.standard_normal((20, 4)), RNG.standard_normal((30, 4))
    b[3] = 0.0
    coef = RNG.standard_normal(30)

    def k(x, y):
        if kind == "rbf":
            return np.exp(-0.3 * ((x - y) ** 2).sum())
        if kind == "linear":
            return x @ y
        if kind == "poly":
            return (0.3 * (x @ y)) ** 2
        return np.tanh(0.3 * (x @ y))

    def value(x, y):
        if not cosine:
            return k(x, y)
        return 0.0 if k(x, x) * k(y, y) == 0 else abs(k(x, y)) / np.sqrt(k(x, x) * k(y, y))

    rows = [(i, "m" if i % 2 else "n", float(coef[i]), [float(v) for v in b[i]]) for i in range(30)]
    anchors = spark.createDataFrame(rows, "id long, model_id string, coef double, vec array<double>")
    got = blocks.kernel_sum(
        vectors(spark, a), anchors, kind, 0.3, 0.0, 2, cosine=cosine, block_rows=8
    ).collect()
    assert len(got) == 40
    for r in got:
        own = [i for i in range(30) if ("m" if i % 2 else "n") == r["model_id"]]
        assert r["total"] == pytest.approx(sum(coef[i] * value(a[r["id"]], b[i]) for i in own), abs=1e-9)


def test_pair_kernels(spark):
    rows = vectors(spark, np.array([[1.0, 2.0], [3.0, 0.0], [0.0, 0.0]]))
    asked = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    linear = mg.kernel_pairs(asked, rows, rows, "linear")
    cosines = {(r["a"], r["b"]): r["cosine"] for r in mg.pair_kernel_cosine(linear).collect()}
    assert cosines[(0, 1)] == pytest.approx(3 / np.sqrt(45)) and cosines[(0, 2)] == 0.0
    plus = {(r["a"], r["b"]): r["distance"] for r in mg.pair_kernel_distance(linear).collect()}
    assert plus[(0, 1)] == pytest.approx(np.sqrt(5 + 9 + 6))
    minus = {(r["a"], r["b"]): r["distance"] for r in mg.pair_kernel_distance(linear, metric=True).collect()}
    assert minus[(0, 1)] == pytest.approx(np.sqrt(8))
    with pytest.raises(ValueError):
        mg.kernel_pairs(asked, rows, rows, "cubic")


def test_a_block_pair_is_worked_out_in_bounded_slices():
    """Similarities held at once don't grow with the rows of the right block."""
    n_left, n_right = 1_000, 8_192
    side = lambda n: pa.table({"vec": pa.array(np.random.default_rng(n).standard_normal((n, 4)).tolist())})
    slices = list(blocks._dense_cosines(side(n_left), side(n_right)))
    assert sum(len(s) for s in slices) == n_left and max(s.size for s in slices) <= 1 << 20
    sparse = lambda n: pa.table({"terms": [["a"]] * n, "vals": [[2.0]] * n})
    slices = list(blocks._sparse_cosines(sparse(n_left), sparse(n_right)))
    assert sum(len(s) for s in slices) == n_left and max(s.size for s in slices) <= 1 << 20
    assert all((s == 1.0).all() for s in slices)


def test_largest_values_with_ties_and_nan():
    values = RNG.integers(0, 50, (30, 700)).astype(float)
    values[3] = 0.0
    values[4, 5] = values[5, 699] = np.nan
    row, column = blocks._largest(values, 6)
    for i in range(30):
        got = np.sort(values[i, column[row == i]])
        assert len(set(column[row == i])) == 6
        np.testing.assert_array_equal(got, np.sort(values[i])[-6:])


@pytest.mark.parametrize("share", [0.0, 0.01, 2.0])
def test_frequent_terms_as_columns_or_postings(share, monkeypatch):
    """The same cosines whichever terms are columns, for a row that holds a term twice as well."""
    monkeypatch.setattr(blocks, "DENSE_SHARE", share)
    monkeypatch.setattr(blocks, "DENSE_TERMS", 20)
    matrix = RNG.random((60, 40)) * (RNG.random((60, 40)) < np.linspace(0.9, 0.02, 40))
    matrix[[2, 50]] = 0.0

    def table(rows):
        terms = [[7] * int(matrix[i, 7] > 0) + [j for j in range(40) if matrix[i, j]] for i in rows]
        vals = [[1.5] * int(matrix[i, 7] > 0) + [matrix[i, j] for j in range(40) if matrix[i, j]] for i in rows]
        return pa.table({"terms": pa.array(terms, pa.list_(pa.int64())), "vals": pa.array(vals, pa.list_(pa.float64()))})

    sums = matrix.copy()
    sums[:, 7] += 1.5 * (matrix[:, 7] > 0)
    norms = np.sqrt((matrix * matrix).sum(1) + 2.25 * (matrix[:, 7] > 0))
    unit = np.divide(sums, norms[:, None], out=np.zeros_like(sums), where=norms[:, None] > 0)
    got = np.concatenate(list(blocks._sparse_cosines(table(range(20)), table(range(20, 60)))))
    np.testing.assert_allclose(got, unit[:20] @ unit[20:].T, atol=1e-12)


@pytest.mark.parametrize("merged", [16, 2])
def test_rows_are_not_repeated_for_each_block(spark, merged, monkeypatch):
    """Rows of both sides are stored once however many blocks there are, and only neighbours stay."""
    stored = []
    whole = blocks.materialize
    monkeypatch.setattr(blocks, "materialize", lambda df, name, *by: stored.append((name, df.count())) or whole(df, name, *by))
    monkeypatch.setattr(blocks, "MERGED_ROUNDS", merged)
    folder = scratch_root(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    train, test = RNG.standard_normal((60, 3)), RNG.standard_normal((25, 3))
    train[20:30] = train[10:20]
    got = blocks.cosine_neighbours(vectors(spark, test), vectors(spark, train), 4, block_rows=8)
    assert pairs(got) == brute_force(test, train, 4)
    assert sorted(x for x in stored if x[0] != "neighbours") == [("test-rows", 25), ("train-rows", 60)]
    assert max(n for _, n in stored) <= 5 * 25 * max(merged, 1)
    left = set(os.listdir(folder)) - before
    assert all(x.startswith("tagwright-neighbours-") for x in left) and len(left) < (merged if merged == 2 else 9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan


def test_neighbours_of_nothing_and_of_rows_without_an_id(spark):
    rows = "id long, vec array<double>, classLabel int"
    train = spark.createDataFrame([(None, [1.0, 0.0], 1), (7, [1.0, 0.0], 2), (7, [0.0, 1.0], 3)], rows)
    test = spark.createDataFrame([(None, [1.0, 0.1], 0), (3, [0.0, 2.0], 0), (3, [0.1, 2.0], 0)], rows)
    got = blocks.cosine_neighbours(test, train, 2, block_rows=1)
    found = sorted((str(r.test_id), str(r.train_id), r.classLabel, round(r.similarity, 3)) for r in got.collect())
    assert found == [("3", "7", 3, 0.999), ("3", "7", 3, 1.0), ("None", "7", 2, 0.995), ("None", "None", 1, 0.995)]
    assert blocks.cosine_neighbours(test, train.where("false"), 2).count() == 0
    assert blocks.cosine_neighbours(test.where("false"), train, 2).count() == 0


def test_accuracy_of_texts_leaves_no_rows_stored(spark, tmp_path):
    """In several blocks the same as the SQL; what was compared is deleted, texts without a label are not stored."""
    rng = random.Random(5)
    words = [a + b for a in "bcdfgklm" for b in ("ar", "en", "ol", "ut")]
    docs = [(i, " ".join(rng.choices(words, k=12)) if i % 9 else None) for i in range(90)]
    labels = [(i, rng.randrange(3)) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    folder = scratch_root(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    got = [tuple(r) for r in QUERIES["knn_accuracy_text"](spark, str(tmp_path)).collect()]
    assert all(x.startswith("tagwright-neighbours-") for x in set(os.listdir(folder)) - before)
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert got == con.execute(SQL["knn_accuracy_text"]).fetchall()
