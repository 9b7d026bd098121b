"""Registered query of large-margin training on stemmed text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import margin as mg, sparse_training as sp
from ..operators.lookup import lookup_join, rows_of
from ..plans import text_learner
from ..sources.scratch import materialize, shuffles_freed
from .corpus import EXPLODED, PORTER, STOPWORDS, documents
from .registry import query, sql_list, table

SPECS = (sp.SparseSpec("loose", 0.25), sp.SparseSpec("strict", 2.0), sp.SparseSpec("weighted", 1.0, 0, (4.0, 1.0)))
TOLERANCE, SMOOTH = 1e-2, 0.1
FIRST = "first "  # before the names of models without weights

SPARSE_FIT = f"""WITH {EXPLODED}, words AS (SELECT DISTINCT term AS token FROM ex), {PORTER},
  bag AS (SELECT doc_id, stem AS term FROM ex JOIN stems ON term = token WHERE stem NOT IN ({sql_list(STOPWORDS)}) GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM bag GROUP BY term),
  used AS (SELECT term FROM df WHERE ln((SELECT count(*) FROM documents)::DOUBLE / (1 + df)) <> 0),
  y AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL),
  n AS (SELECT count(DISTINCT term) + 1 AS n_features FROM bag JOIN y USING (doc_id) JOIN used USING (term))
  SELECT m AS model_id, (SELECT count(*) FROM y) AS n_rows, (SELECT n_features FROM n) AS n_features,
    true AS fitted, true AS better_than_zero, true AS gradient_vanishes
  FROM (VALUES ('loose'), ('strict'), ('weighted')) v(m)"""


def _gradient_norms(features: DataFrame, labels: DataFrame, weights: DataFrame, specs: dict[str, sp.SparseSpec], smooth: float) -> DataFrame:
    """``(model_id, norm)`` of the objective's gradient at ``weights``, by joins and sums alone.  ``specs``
    names the objective of each model; all of them share the joins."""
    ids = labels.select("id")
    own = rows_of(features, ids, "id")
    scores = mg.decision_values(own, weights, ids).join(labels, "id")
    slopes = []
    for m, s in specs.items():
        positive = F.col("classLabel") > 0 if s.positive is None else F.col("classLabel") == s.positive
        y, use = F.when(positive, 1.0).otherwise(-1.0), F.when(positive, s.weights[0]).otherwise(s.weights[1])
        slope = F.greatest(F.least((1 - y * F.col("decision")) / smooth, F.lit(1.0)), F.lit(0.0)) * -y * use * s.C
        slopes.append(F.sum(F.when(F.col("model_id") == m, slope)).alias(f"s{len(slopes)}"))
    terms = materialize(scores.groupBy("id").agg(*slopes), "slopes")
    cells = own.unionByName(ids.select("id", F.lit(mg.BIAS).alias("feature"), F.lit(1.0).alias("value")))
    at = range(len(slopes))
    joined = lookup_join(cells, terms, "id", "feature", row_bytes=64 + 16 * len(at))
    data = joined.groupBy("feature").agg(*[F.sum(F.col("value") * F.col(f"s{i}")).alias(f"g{i}") for i in at])
    penalty = F.when(F.col("feature") == mg.BIAS, 0.0).otherwise(F.col("weight"))
    whole = weights.withColumn("weight", penalty).join(data, "feature", "left")
    found = F.coalesce(*[F.when(F.col("model_id") == m, F.col(f"g{i}")) for i, m in enumerate(specs)], F.lit(0.0))
    g = F.col("weight") + found
    return whole.groupBy("model_id").agg(F.sqrt(F.sum(g * g)).alias("norm"))


@query("sparse_fit_optimality", SPARSE_FIT)
def sparse_fit_optimality(spark, sf_dir):
    """Three learners of document quality on stemmed tf-idf: fitted to the tolerance, better than no
    weights, and with a gradient that vanishes when it is worked out anew from the weight table."""
    labels = table(spark, sf_dir, "labels").where("quality is not null").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("classLabel")
    )
    features = text_learner.text_features(documents(spark, sf_dir), STOPWORDS, ids=labels)
    fit = text_learner.fit_texts(features, labels, SPECS, tolerance=TOLERANCE, smooth=SMOOTH)
    zero = fit.weights.select(F.concat(F.lit(FIRST), "model_id").alias("model_id"), "feature", F.lit(0.0).alias("weight"))
    models = {s.model_id: s for s in SPECS} | {FIRST + s.model_id: s for s in SPECS}
    with shuffles_freed(spark):
        norms = materialize(_gradient_norms(features, labels, fit.weights.unionByName(zero), models, SMOOTH), "norms")
    now = norms.where(~F.col("model_id").startswith(FIRST))
    first = norms.where(F.col("model_id").startswith(FIRST)).select(
        F.expr(f"substr(model_id, {len(FIRST) + 1})").alias("model_id"), F.col("norm").alias("first")
    )
    counts = fit.weights.groupBy("model_id").agg(F.count(F.lit(1)).alias("n_features"))
    n_rows = labels.count()
    loss_at_zero = {}
    for s in SPECS:
        positive = F.col("classLabel") > 0 if s.positive is None else F.col("classLabel") == s.positive
        use = F.sum(F.when(positive, s.weights[0]).otherwise(s.weights[1]))
        loss_at_zero[s.model_id] = s.C * (1 - SMOOTH / 2) * labels.agg(use).first()[0]
    at_zero = F.element_at(F.create_map(*[F.lit(x) for kv in loss_at_zero.items() for x in kv]), F.col("model_id"))
    both = now.join(first, "model_id").join(counts, "model_id").join(fit.report, "model_id")
    return both.select(
        "model_id", F.lit(n_rows).cast("long").alias("n_rows"), "n_features", (F.col("gradient") <= TOLERANCE).alias("fitted"),
        (F.col("loss") < at_zero).alias("better_than_zero"),
        (F.col("norm") <= 1.001 * TOLERANCE * F.col("first")).alias("gradient_vanishes"),
    )
