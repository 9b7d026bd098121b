"""Texts to learners end to end: held-out accuracy, scores and rows to ask for."""

import random

import pytest
from pyspark.sql import functions as F

from tagwright.operators.sparse_training import SparseSpec
from tagwright.plans import text_learner as tl

GOOD = "excellent wonderful charming brilliant moving superb".split()
BAD = "dull terrible boring awful clumsy dreadful".split()
OTHER = "film actor scene story music camera plot people evening".split()
SPECS = (SparseSpec("one", 1.0), SparseSpec("other side", 1.0, 0))


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        label = i % 2
        words = rng.choices(GOOD if label else BAD, k=4) + rng.choices(OTHER, k=12) + [f"word{chr(97 + rng.randrange(26))}"]
        rng.shuffle(words)
        rows.append((i, " ".join(words), label))
    rows += [(1000, None, 1), (1001, "", 0), (1002, "12 34", 1)]  # no terms at all
    docs = spark.createDataFrame(rows, "doc_id long, text string, classLabel int")
    features = tl.text_features(docs.select("doc_id", "text"), ["the"])
    labels = docs.select(F.col("doc_id").alias("id"), "classLabel")
    train = labels.where("id < 200 or id = 1000")
    return features, labels, tl.fit_texts(features, train, SPECS, tolerance=1e-2)


def test_held_out_accuracy(learned):
    features, labels, fit = learned
    test = labels.where("id >= 200 and id <> 1000")
    scores = tl.score_texts(features, fit, test)
    assert scores.count() == 2 * 102
    for r in tl.text_metrics(scores, test, SPECS).collect():
        assert r.tp + r.tn >= 95 and r.tp + r.fp + r.tn + r.fn == 102
    by = {(r.id, r.model_id): r.decision for r in scores.collect()}
    bias = {r.model_id: r.weight for r in fit.weights.where("feature = '__bias__'").collect()}
    assert by[1001, "one"] == pytest.approx(bias["one"])  # a text without terms is scored by the bias
    assert by[202, "one"] == pytest.approx(-by[202, "other side"], abs=0.1)


def test_rows_to_ask_for(learned):
    features, labels, fit = learned
    scores = tl.score_texts(features, fit, labels)
    asked = tl.ask_texts(scores, fit, 5).collect()
    assert len(asked) == 10
    near = {m: sorted((abs(r.decision), r.id) for r in scores.where(F.col("model_id") == m).collect())[:5] for m in ("one", "other side")}
    for m, rows in near.items():
        assert {r.id for r in asked if r.model_id == m} == {i for _, i in rows}
