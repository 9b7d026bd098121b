"""From raw documents and labels to linear learners over weighted terms, their scores and metrics.

Texts are cleaned, stemmed and weighted once.  The term rows stay sparse through training, scoring
and choosing rows to label, so the vocabulary may have any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators import margin as mg, sparse_training as sp
from ..operators.evaluate import confusion
from ..operators.lookup import rows_of
from ..operators.topk import top_k_per_key
from ..sources.scratch import discard, materialize, shuffles_freed
from .features import weighted_terms


def text_features(
    docs: DataFrame, stopwords: Sequence[str], stems: bool = True, rank_threshold: float = 0.0,
    id_col: str = "doc_id", text_col: str = "text", ids: DataFrame | None = None,
) -> DataFrame:
    """Stored ``(id, feature, value)``: unit rows of weighted terms.  All documents are weighted together;
    with ``ids`` only the rows of those are stored."""
    with shuffles_freed(docs.sparkSession):
        weights = weighted_terms(docs, stopwords, stems=stems, rank_threshold=rank_threshold, id_col=id_col, text_col=text_col)
        if ids is not None:
            weights = rows_of(weights, ids.select(F.col("id").alias(id_col)), id_col)
        return _stored(weights, id_col)


def _stored(weights: DataFrame, id_col: str) -> DataFrame:
    rows = weights.select(F.col(id_col).alias("id"), F.col("term").alias("feature"), F.col("weight").alias("value"))
    return materialize(rows, "text-features")


def fit_texts(features: DataFrame, labels: DataFrame, specs: Sequence[sp.SparseSpec], **settings) -> sp.SparseFit:
    """All ``specs`` fitted on the labeled rows ``(id, classLabel)`` of the features."""
    rows = sp.sparse_training_rows(features, labels)
    fit = sp.fit_sparse(rows, specs, **settings)
    discard(rows.chunks, rows.vocabulary)
    return fit


def score_texts(features: DataFrame, fit: sp.SparseFit, ids: DataFrame) -> DataFrame:
    """``(id, model_id, decision)`` of the rows named by ``ids``, those without terms included."""
    wanted = ids.select("id").distinct()
    return mg.decision_values(features.join(wanted, "id", "left_semi"), fit.weights, wanted)


def text_metrics(scores: DataFrame, truth: DataFrame, specs: Sequence[sp.SparseSpec]) -> DataFrame:
    """tp, fp, tn, fn of every model over test rows ``(id, classLabel)``."""
    positive = F.lit(False)
    for s in specs:
        own = F.col("classLabel") > 0 if s.positive is None else F.col("classLabel") == s.positive
        positive = F.when(F.col("model_id") == s.model_id, own).otherwise(positive)
    known = scores.join(truth.where("classLabel is not null").select("id", "classLabel"), "id")
    judged = known.select(
        "model_id", positive.cast("int").alias("classLabel"), F.when(F.col("decision") > 0, 1).otherwise(0).alias("pred")
    )
    return confusion(judged, ["model_id"])


def ask_texts(scores: DataFrame, fit: sp.SparseFit, k: int) -> DataFrame:
    """For every model the k scored rows nearest its hyperplane: ``(model_id, id, distance)``."""
    far = mg.hyperplane_distance(scores, mg.squared_norms(fit.weights)).select("model_id", "id", "distance")
    return top_k_per_key(far, "model_id", k, "distance")
