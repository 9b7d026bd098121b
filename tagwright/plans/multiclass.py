"""One binary learner per class over the same rows, combined by the largest score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators import training as tr
from ..operators.evaluate import multiclass_accuracy
from ..operators.labels import one_hot
from ..operators.queries import final_predictions, ovr_argmax
from .active import LearnerState, score_rows


def class_tasks(labeled: DataFrame, label_col: str = "classLabel") -> DataFrame:
    """``(class, id, y)``: every labeled row relabeled for every class."""
    return one_hot(labeled, label_col, keep=("id",))


def train_per_class(
    vectors: DataFrame, labeled: DataFrame, classes: Sequence[int], params: tr.MarginParams
) -> tr.MarginModel:
    """All class learners fitted together, sharing each pass over the rows."""
    return tr.fit_margin(vectors, labeled, params, classes=classes)


def predict_classes(vectors: DataFrame, model: tr.MarginModel) -> DataFrame:
    return ovr_argmax(tr.margin_decisions(vectors, model))


def test_accuracy(vectors: DataFrame, truth: DataFrame, model: tr.MarginModel) -> DataFrame:
    rows = vectors.join(truth.select("id"), "id", "left_semi")
    predicted = predict_classes(rows, model)
    return multiclass_accuracy(truth.select("id", "classLabel").join(predicted, "id", "left"))


def predict_pool(
    vectors: DataFrame, model: tr.MarginModel, labeled: DataFrame, pool: DataFrame, names
) -> DataFrame:
    scores = tr.margin_decisions(vectors.join(pool.select("id"), "id", "left_semi"), model)
    return final_predictions(scores, labeled, pool, names)


def predict_with_learners(
    states: Mapping[int, LearnerState], vectors: DataFrame, texts: DataFrame, names
) -> DataFrame:
    """``(id, pred, name, origText)`` of the rows no learner has labeled: the class whose learner gives the
    largest score to its positive side.  A learner scores as it is configured: log posteriors of
    naive Bayes, probabilities or decision values."""
    scores = labeled = None
    for c, state in states.items():
        own = score_rows(state, vectors).select("id", F.lit(str(c)).alias("model_id"), F.col("score_1").alias("decision"))
        scores = own if scores is None else scores.unionByName(own)
        known = state.labeled.select("id")
        labeled = known if labeled is None else labeled.unionByName(known)
    if scores is None:
        raise ValueError("no models have been initialized")
    return final_predictions(scores, labeled.distinct(), texts, names)


def class_list(labeled: DataFrame, label_col: str = "classLabel") -> list[int]:
    """The distinct classes in order; their number is the number of models to fit."""
    rows = labeled.where(F.col(label_col).isNotNull()).select(label_col).distinct().orderBy(label_col)
    return [r[0] for r in rows.collect()]
