from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright.operators import queries as qs, training as tr
from tagwright.plans import active, multiclass
from tagwright.sources.scratch import materialize, scratch_root

PARAMS = tr.MarginParams(n_components=64, tolerance=1e-2)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(v) for v in rng.standard_normal(3) + (i % 2) * 2], i % 2) for i in range(120)]
    return materialize(spark.createDataFrame(data, "id long, vec array<double>, classLabel int"), "rows")


def first_state(rows, **config):
    labels = rows.select("id", "classLabel")
    pool, test = labels.where("id < 90"), labels.where("id >= 90")
    return active.LearnerState(
        active.LearnerConfig("demo", PARAMS, **config), rows.select("id", "vec"), pool, pool.limit(0), test
    )


def ids(df):
    return {r["id"] for r in df.collect()}


@pytest.mark.parametrize("naive_bayes", [False, True])
def test_loop_keeps_rows_apart_and_complete(rows, naive_bayes, tmp_path):
    state = active.seed_training(first_state(rows, naive_bayes=naive_bayes), 12)
    everything = ids(state.labeled) | ids(state.pool)
    labels = rows.select("id", F.col("classLabel").alias("label"))
    state = active.active_learn(state, labels, 15, batch=10)
    assert len(ids(state.labeled)) == 32  # the second batch overshoots 15
    assert not ids(state.labeled) & ids(state.pool)
    assert ids(state.labeled) | ids(state.pool) == everything
    m = state.metrics
    assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == 30 and m["accuracy"] > 0.8
    active.save_state(state, str(tmp_path))
    fresh = first_state(rows)
    restored = active.load_state(replace(fresh, pool=state.pool), str(tmp_path))
    assert restored.metrics == state.metrics and restored.config.naive_bayes == naive_bayes
    assert ids(restored.pool) == everything
    untouched = active.load_state(fresh, str(tmp_path / "elsewhere"))
    assert untouched is fresh


def test_random_strategy_and_single_rebuild(rows):
    state = active.seed_training(first_state(rows, grid={"folds": 2, "c_range": (0, 3, 2), "g_range": (-2, 1, 2)}), 12)
    assert state.config.params.gamma is not None
    labels = rows.select("id", F.col("classLabel").alias("label"))
    state = active.active_learn(
        replace(state, config=replace(state.config, grid=None)), labels, 10, active.query_random, 5,
        rebuild_each=False, balance_first=True,
    )
    assert len(ids(state.labeled)) == 22 and state.metrics


def test_no_test_labels_no_metrics(rows):
    assert active.evaluate(replace(first_state(rows), test=None)) == ({}, None)


@pytest.mark.parametrize("mode", ["naive_bayes", "probability", "margin"])
def test_scores_are_kept(rows, mode):
    state = active.seed_training(first_state(rows, **({mode: True} if mode != "margin" else {})), 40)
    got = state.scores.collect()
    assert state.scores.columns == ["id", "score_0", "score_1", "pred"] and len(got) == 30
    right = 0
    truth = {r["id"]: r["classLabel"] for r in rows.collect()}
    for r in got:
        assert r["pred"] == int(r["score_1"] > r["score_0"])
        right += r["pred"] == truth[r["id"]]
        if mode == "probability":
            assert r["score_0"] + r["score_1"] == pytest.approx(1)
        if mode == "margin":
            assert r["score_0"] == -r["score_1"]
    assert state.metrics["tp"] + state.metrics["tn"] == right > 24


def test_final_predictions_of_mixed_learners(rows):
    """One learner of each kind; the class with the largest score wins, labeled rows are left out."""
    states = {}
    for c, config in ((0, {"naive_bayes": True}), (1, {"probability": True}), (2, {})):
        own = rows.select("id", "vec", (F.col("classLabel") == c % 2).cast("int").alias("classLabel"))
        states[c] = active.seed_training(first_state(own, **config), 40)
    pool = rows.where("id >= 60").select("id", "vec", F.concat(F.lit("row "), "id").alias("origText"))
    found = multiclass.predict_with_learners(states, pool.select("id", "vec"), pool.select("id", "origText"), {0: "a", 1: "b", 2: "c"})
    taken = set().union(*(ids(s.labeled) for s in states.values()))
    got = {r["id"]: r["pred"] for r in found.collect()}
    assert set(got) == {i for i in range(60, 120) if i not in taken}
    scores = {c: {r["id"]: r["score_1"] for r in active.score_rows(s, pool.select("id", "vec")).collect()} for c, s in states.items()}
    assert all(p == max(scores, key=lambda c: (scores[c][i], -c)) for i, p in got.items())


def test_uncertainty_and_random_queries(spark):
    far = spark.createDataFrame([(1, 0.5), (2, 0.1), (3, 0.1), (4, 0.9)], "id long, distance double")
    assert [r["id"] for r in qs.uncertainty_query(far, 2).collect()] == [2, 3]
    assert qs.uncertainty_query(far, 9).count() == 4
    assert len(ids(qs.random_query(far, 3, seed=1))) == 3
    assert ids(qs.random_query(far, 2, seed=1)) == ids(qs.random_query(far.repartition(3), 2, seed=1))


@pytest.mark.parametrize("prefer", ["similar", "dissimilar"])
@pytest.mark.parametrize("steps_per_table", [16, 2])
def test_diversity_equals_brute_force(rows, prefer, steps_per_table, monkeypatch):
    monkeypatch.setattr(qs, "STEPS_PER_TABLE", steps_per_table)
    x = {r["id"]: np.array(r["vec"]) for r in rows.collect()}
    labeled, pool = [i for i in x if i < 8], [i for i in x if 8 <= i < 60]
    k = lambda a, b: np.exp(-0.3 * ((x[a] - x[b]) ** 2).sum())
    vectors = rows.select("id", "vec")
    got = qs.diversity_query(
        vectors.where("id >= 8 AND id < 60"), vectors.where("id < 8"), 6, "rbf", 0.3, prefer=prefer, seed=2
    ).orderBy("step").collect()
    picks = [got[0]["id"]]
    for _ in range(5):
        score = {i: round(sum(k(i, j) for j in labeled + picks), 10) for i in pool if i not in picks}
        sign = -1 if prefer == "similar" else 1
        picks.append(min(score, key=lambda i: (sign * score[i], i)))
    assert [r["id"] for r in got] == picks


@pytest.mark.parametrize("prefer", ["similar", "dissimilar"])
def test_diversity_with_few_leaders(rows, prefer, monkeypatch):
    """Fifty picks with eight rows at hand: bounds decide when the pool is read again."""
    vectors = rows.select("id", "vec")
    want = qs.diversity_query(vectors, vectors.limit(0), 50, "rbf", 0.3, prefer=prefer).orderBy("step").collect()
    passes, lead = [], qs._current_leaders
    monkeypatch.setattr(qs, "LEADERS", 8)
    monkeypatch.setattr(qs, "_current_leaders", lambda *a: passes.append(1) or lead(*a))
    got = qs.diversity_query(vectors, vectors.limit(0), 50, "rbf", 0.3, prefer=prefer).orderBy("step").collect()
    assert got == want and 1 <= len(passes) <= 49


def test_diversity_as_a_strategy(rows):
    state = active.seed_training(first_state(rows), 12)
    labels = rows.select("id", F.col("classLabel").alias("label"))
    state = active.active_learn(state, labels, 5, active.query_diverse, 5, rebuild_each=False)
    assert len(ids(state.labeled)) == 17 and state.metrics


def test_diversity_without_anything_labeled(rows):
    vectors = rows.select("id", "vec").where("id < 20")
    got = qs.diversity_query(vectors, vectors.limit(0), 3, start_random=False).collect()
    assert [r["step"] for r in got] == [1, 2] and got[0]["id"] == 0


def test_apply_labels(spark):
    pool = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, None, "c")], "id long, classLabel int, origText string")
    feed = spark.createDataFrame([(1, 1), (2, 7), (9, 0)], "id long, label int")
    labeled, rest, rejected = qs.apply_labels(pool, feed, (0, 1))
    assert [tuple(r) for r in labeled.collect()] == [(1, 1, "a")] and ids(rest) == {2, 3}
    assert {(r["id"], r["reason"]) for r in rejected.collect()} == {(2, "unknown label"), (9, "not in the pool")}


def test_combination_of_class_scores(spark):
    scores = spark.createDataFrame(
        [(1, "0", 0.4), (1, "10", 0.4), (1, "2", 0.4), (2, "0", -3.0), (2, "2", -1.0)],
        "id long, model_id string, decision double",
    )
    assert {r["id"]: r["pred"] for r in qs.ovr_argmax(scores).collect()} == {1: 0, 2: 2}
    two = spark.createDataFrame([(1, 0.2, -0.2), (2, -0.1, 0.1), (3, 0.0, 0.0)], "id long, score_0 double, score_1 double")
    assert {r["id"]: r["pred"] for r in qs.single_class_argmax(two).collect()} == {1: 0, 2: 1, 3: 0}


def test_tables_lie_in_the_checkpoint_folder(spark):
    table = materialize(spark.range(3), "three")
    assert scratch_root(spark).removeprefix("file:").lstrip("/") in table.inputFiles()[0]
    assert table.count() == 3


def test_the_session_names_the_folder():
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs://shared/checkpoints/"}
        sparkContext = None

    assert scratch_root(Session) == "hdfs://shared/checkpoints"


def test_a_cluster_never_gets_a_local_folder():
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = {}, Context

    with pytest.raises(RuntimeError):
        scratch_root(Session)
