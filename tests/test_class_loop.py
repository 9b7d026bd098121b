"""The loop over all classes against plain loops, its saves, its answers, its other fitter."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright.operators import training as tr
from tagwright.plans import class_loop as cl
from tagwright.sources.scratch import materialize

CLASSES = (0, 1, 2)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    data = [(i, (rng.standard_normal(4) + 1.5 * np.eye(4)[i % 3]).tolist(), i % 3) for i in range(150)]
    return materialize(spark.createDataFrame(data, "id long, vec array<double>, classLabel int"), "rows")


def begin(rows, **more):
    return cl.start(rows.select("id", "vec"), rows.where("id < 20").select("id", "classLabel"), CLASSES, **more)


def feed_of(rows):
    return rows.select("id", F.col("classLabel").alias("label"))


def key(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i


def plain_model(x, y, labeled, c, seed):
    sides = [[i for i in labeled if (y[i] == c) == s] for s in (False, True)]
    less = min(map(len, sides))
    if less:
        sides = [sorted(s, key=lambda i: key(seed, i))[:less] for s in sides]
    else:
        return np.zeros(4), 0.0
    neg, pos = (np.mean([x[i] for i in s], axis=0) for s in sides)
    return pos - neg, (neg @ neg - pos @ pos) / 2


def plain_rounds(x, y, first, rounds, k, seed=7):
    labeled = {c: list(first) for c in CLASSES}
    asked = []
    for r in range(rounds):
        new = {}
        for c in CLASSES:
            w, b = plain_model(x, y, labeled[c], c, seed + r)
            far = {i: round(abs(x[i] @ w + b) / (w @ w), 10) if w @ w else 0.0 for i in x if i not in first and i not in labeled[c]}
            new[c] = sorted(far, key=lambda i: (far[i], i))[:k]
        for c in CLASSES:
            labeled[c] += new[c]
            asked += [(str(c), i, y[i], r + 1) for i in new[c]]
    return asked, {c: plain_model(x, y, labeled[c], c, seed + rounds) for c in CLASSES}


@pytest.fixture(scope="module")
def plain(rows):
    got = rows.collect()
    return {r.id: np.array(r.vec) for r in got}, {r.id: r.classLabel for r in got}


def test_rounds_save_and_resume(rows, plain, tmp_path):
    x, y = plain
    state = cl.learn(begin(rows), feed_of(rows), 1, 5)
    cl.save(state, str(tmp_path))
    back = cl.resume(rows.select("id", "vec"), str(tmp_path))
    assert back.round == 1 and back.classes == CLASSES and (back.model.weights == state.model.weights).all()
    assert cl.resume(rows.select("id", "vec"), str(tmp_path), "other") is None
    state = cl.learn(back, feed_of(rows), 1, 5)
    want, models = plain_rounds(x, y, range(20), 2, 5)
    got = [tuple(r) for r in state.labeled.where("model_id is not null").select("model_id", "id", "label", "round").collect()]
    assert sorted(got) == sorted(want)
    for c, row in zip(CLASSES, state.model.weights, strict=True):
        assert row == pytest.approx(np.append(*models[c]), abs=1e-9)
    assert state.labeled.where("model_id is null").count() == 20 and state.pool.count() == 130
    found = cl.accuracy(state, rows.select("id", "vec"), rows.select("id", "classLabel")).first()
    scores = {i: max(CLASSES, key=lambda c: (x[i] @ models[c][0] + models[c][1], -c)) for i in x}
    assert found.accuracy == pytest.approx(100 * np.mean([scores[i] == y[i] for i in x])) and found.n_test == 150
    texts = rows.select("id", F.lit("t").alias("origText"))
    rest = cl.predict_rest(state, texts, {0: "a", 1: "b", 2: "c"}).collect()
    assert {(r.id, r.pred) for r in rest} == {(i, scores[i]) for i in x if i >= 20 and i not in {w[1] for w in want}}


def test_answers(spark, rows):
    state = cl.refit(begin(rows, balanced=False))
    asked = cl.ask(state, 4)
    assert asked.groupBy("model_id").count().where("count <> 4").count() == 0
    ids = sorted({r.id for r in asked.collect()})
    feed = spark.createDataFrame([(ids[0], 1), (ids[0], 1), (ids[1], 0), (ids[1], 2), (ids[2], None), (3, 1)], "id long, label int")
    told = cl.tell(state, asked, feed)
    assert {r.id for r in told.labeled.where("round = 1").collect()} == {ids[0]} and told.round == 1
    assert ids[1] in {r.id for r in cl.ask(cl.refit(told), 150).collect()}  # still open
    with pytest.raises(ValueError):
        cl.ask(begin(rows), 3)


def test_class_without_rows_and_small_pool(rows):
    only = cl.start(rows.select("id", "vec"), rows.where("id < 20 and classLabel < 2").select("id", "classLabel"), CLASSES)
    state = cl.refit(only)
    assert not state.model.weights[2].any() and state.model.weights[0].any()
    assert sorted(r.id for r in cl.ask(state, 3).where("model_id = '2'").collect()) == [2, 5, 8]  # distance 0, by id
    everything = cl.learn(state, feed_of(rows), 1, 1000)
    assert cl.ask(everything, 5).count() == 0


def test_margin_fitter(rows):
    fitter = cl.margin_fitter(tr.MarginParams(kernel="linear", tolerance=1e-2))
    state = cl.learn(begin(rows), feed_of(rows), 1, 5, fitter)
    assert (state.model.weights != 0).any(axis=1).all() and state.labeled.where("round = 1").count() == 15
    found = cl.accuracy(state, rows.select("id", "vec"), rows.select("id", "classLabel")).first()
    assert found.accuracy > 60
    # a learner's fit is the one over its own rows alone
    members = cl.class_members(state).where(F.array_contains("learners", 1)).withColumn("fold", F.lit(-1))
    alone = tr.fit_specs(materialize(members.select("id", "vec", "label", "fold"), "alone"), [tr.Spec("1", 1.0, 1.0, 1)], tr.MarginParams(kernel="linear", tolerance=1e-2))
    assert state.model.weights[1] == pytest.approx(alone.weights[0], abs=0.05)
