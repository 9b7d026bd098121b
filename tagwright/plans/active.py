"""The labeling loop: seed, fit, measure, query, label, refit.

A learner's state is immutable.  Feature vectors are never copied or moved: labeled ids and
labels are a small stored table, and the pool is whatever is not in it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from ..operators import bayes, training as tr
from ..operators.calibration import calibrate_all, model_probabilities
from ..operators.evaluate import learner_metrics
from ..operators.pool import balance, move_random
from ..operators.queries import apply_labels, diversity_query, exclude_labeled, random_query, uncertainty_query
from ..sources.learners import load_learner, prepend_saved, save_learner
from ..sources.scratch import materialize
from ..sources.tables import vector_features

Query = Callable[["LearnerState", int], DataFrame]


@dataclass(frozen=True)
class LearnerConfig:
    """``naive_bayes`` evaluates with Gaussian naive Bayes; queries use the margin model
    either way.  ``probability`` evaluates with probabilities, calibrated on held-out decisions of
    the labeled rows.  ``grid`` is the keyword arguments of the grid search, None to skip it."""

    class_name: str = "Class"
    params: tr.MarginParams = tr.MarginParams()
    grid: dict | None = None
    naive_bayes: bool = False
    probability: bool = False
    allowed: tuple[int, ...] = (0, 1)
    seed: int = 7


@dataclass(frozen=True)
class LearnerState:
    """``vectors`` is ``(id, vec)`` for every row; ``pool`` and ``labeled`` are
    ``(id, classLabel)``; ``test`` holds the true labels.  ``scores`` are those of the test rows at the
    last evaluation: ``(id, score_0, score_1, pred)``."""

    config: LearnerConfig
    vectors: DataFrame
    pool: DataFrame
    labeled: DataFrame
    test: DataFrame | None = None
    model: tr.MarginModel | None = None
    metrics: dict | None = None
    round: int = 0
    calibration: DataFrame | None = None
    scores: DataFrame | None = None


def labeled_vectors(state: LearnerState) -> DataFrame:
    return state.vectors.join(state.labeled.select("id"), "id", "left_semi")


def pool_vectors(state: LearnerState) -> DataFrame:
    return state.vectors.join(state.pool.select("id"), "id", "left_semi")


def score_rows(state: LearnerState, rows: DataFrame) -> DataFrame:
    """``(id, score_0, score_1, pred)`` of ``rows`` ``(id, vec)``: log posteriors of naive Bayes, calibrated
    probabilities, or minus and plus the decision value, as the learner is configured."""
    if state.config.naive_bayes:
        known = state.labeled.select("id", "classLabel")
        model = bayes.fit_bayes(vector_features(labeled_vectors(state), "id", "vec"), known)
        found = bayes.log_posterior(vector_features(rows, "id", "vec"), rows.select("id"), model)
        at = {c: i for i, c in enumerate(model.classes)}
        of = lambda c: F.col("posterior")[at[c]] if c in at else F.lit(float("-inf"))
        best = F.element_at(
            F.array(*[F.lit(c) for c in model.classes]), F.array_position("posterior", F.array_max("posterior")).cast("int")
        )
        return found.select("id", of(0).alias("score_0"), of(1).alias("score_1"), best.alias("pred"))
    decisions = tr.margin_decisions(rows, state.model)
    pred = F.when(F.col("decision") > 0, 1).otherwise(0)
    if not state.config.probability:
        return decisions.select("id", (-F.col("decision")).alias("score_0"), F.col("decision").alias("score_1"), pred.alias("pred"))
    if state.calibration is None:
        raise TypeError("the model does not support probability estimates")
    found = model_probabilities(decisions, state.calibration)
    likely = F.when(F.col("p_1") > F.col("p_0"), 1).otherwise(0)
    return found.select("id", F.col("p_0").alias("score_0"), F.col("p_1").alias("score_1"), likely.alias("pred"))


def evaluate(state: LearnerState, labeled: DataFrame | None = None) -> tuple[dict, DataFrame | None]:
    """(metrics over the test rows, their scores); empty without test labels."""
    if state.test is None:
        return {}, None
    truth = state.test.select("id", "classLabel")
    rows = state.vectors.join(truth.select("id"), "id", "left_semi")
    scores = materialize(score_rows(state, rows), "scores")
    row = learner_metrics(truth.join(scores.select("id", "pred"), "id"), labeled).first()
    return (row.asDict() if row else {}), scores


def calibrated(state: LearnerState, known: DataFrame, params: tr.MarginParams, folds: int = 5) -> DataFrame | None:
    """The sigmoid of the learner, from decisions on rows that their models have not seen."""
    if not state.config.probability:
        return None
    n_features = state.vectors.select(F.max(F.size("vec"))).first()[0] or 1
    gamma = tr.resolve(params, n_features).gamma
    held_out = tr.cv_decisions(state.vectors, known, [(params.C, gamma)], folds, params)
    return calibrate_all(held_out.select(F.lit("model").alias("model_id"), "decision", F.col("label").alias("y")))


def rebuild(state: LearnerState, balance_first: bool = False) -> LearnerState:
    """Refit on the labeled rows: optional balancing, grid search, fit, evaluation."""
    config = state.config
    known = state.labeled
    if balance_first:
        known = balance(known, config.seed + state.round)
    params = config.params
    if config.grid is not None:
        params = tr.grid_search(state.vectors, known, params=params, **config.grid)
    model = tr.fit_margin(state.vectors, known, params)
    fitted = replace(
        state, model=model, config=replace(config, params=params), calibration=calibrated(state, known, params)
    )
    metrics, scores = evaluate(fitted)
    return replace(fitted, metrics=metrics, scores=scores)


def seed_training(state: LearnerState, k: int, build: bool = True) -> LearnerState:
    """Move k random pool rows with the labels they carry, then fit."""
    pool, labeled = move_random(state.pool, state.labeled, k, state.config.seed)
    moved = replace(state, pool=pool, labeled=materialize(labeled, "labeled"))
    return rebuild(moved) if build else moved


def pool_distances(state: LearnerState) -> DataFrame:
    """Distance of every pool row to the current hyperplane; 0 for a zero model."""
    w2 = state.model.squared_norms()["model"]
    distance = F.try_divide(F.abs("decision"), F.lit(w2))
    return tr.margin_decisions(pool_vectors(state), state.model).select(
        "id", F.coalesce(distance, F.lit(0.0)).alias("distance")
    )


def query_uncertain(state: LearnerState, k: int) -> DataFrame:
    return uncertainty_query(pool_distances(state), k)


def query_random(state: LearnerState, k: int) -> DataFrame:
    return random_query(state.pool, k, state.config.seed + state.round)


def query_diverse(state: LearnerState, k: int, prefer: str = "similar") -> DataFrame:
    """The greedy choice by summed kernel cosine to the labeled rows, with the learner's kernel; like
    the other strategies it names k rows, a random one first."""
    params = tr.resolve(state.config.params, state.model.n_features if state.model else 1)
    return diversity_query(
        pool_vectors(state), labeled_vectors(state), k, params.kernel, params.gamma, prefer=prefer,
        seed=state.config.seed + state.round,
    )


def active_learn(
    state: LearnerState, labels: DataFrame, n: int, query: Query = query_uncertain, batch: int = 10,
    rebuild_each: bool = True, balance_first: bool = False, build_last: bool = True,
) -> LearnerState:
    """Query and label in batches until ``n`` requested labels are reached.

    ``labels`` is an ``(id, label)`` table that answers the queries.  The count goes up by
    the nominal batch size, so the last round may overshoot.  Only the labeled table is
    written each round; the pool is the anti-join of its first state with it."""
    first_pool = state.pool
    counted = 0
    while counted < n:
        asked = materialize(query(state, batch).select("id"), "asked")
        answers = labels.join(asked, "id", "left_semi").select("id", "label")
        newly, _, _ = apply_labels(state.pool, answers, state.config.allowed)
        labeled = materialize(state.labeled.unionByName(newly.select(*state.labeled.columns)), "labeled")
        state = replace(
            state, labeled=labeled, pool=exclude_labeled(first_pool, labeled), round=state.round + 1
        )
        if rebuild_each:
            state = rebuild(state, balance_first)
        counted += batch
    return state if rebuild_each or not build_last else rebuild(state, balance_first)


def save_state(state: LearnerState, path: str) -> None:
    save_learner(
        path, state.config.class_name, state.labeled, state.model.table(state.labeled.sparkSession),
        state.metrics or {}, state.config.naive_bayes, round=state.round,
    )


def load_state(state: LearnerState, path: str) -> LearnerState:
    """Restore model, flags and metrics of a saved learner; saved rows the pool does not hold
    come back into the pool.  A learner that was never saved leaves the state as it is."""
    spark = state.pool.sparkSession
    saved = load_learner(spark, path, state.config.class_name)
    if saved is None:
        return state
    rows = saved["labeled"].select(*state.pool.columns)
    config = replace(state.config, naive_bayes=saved["naive_bayes"])
    return replace(
        state, config=config, metrics=saved["metrics"], model=tr.MarginModel.from_table(saved["model"]),
        round=saved.get("round", 0), pool=prepend_saved(rows, state.pool),
    )
