"""Registered queries of the loop over all classes and of the nearest rows per class."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import margin as mg
from ..operators.sampling import random_cut
from ..operators.topk import top_k_per_key
from ..plans import class_loop, multiclass
from ..sources.scratch import scratch_root
from .bayes_queries import VECTOR_SPLIT, vector_split
from .margin_queries import DECISIONS, _decisions
from .registry import query, rounded, vectors

START_ROWS, ROUNDS, ASKED, SEED = 80, 3, 6, 7


@query(
    "nearest_per_class",
    f"""WITH {DECISIONS}, q AS (SELECT d.model_id, id, abs(decision) / w2 AS distance FROM d JOIN b ON b.m = d.model_id)
    SELECT model_id::VARCHAR AS model_id, id, round(distance, 6) + 0.0 AS distance FROM q
    QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY q.distance, id) <= 10""",
)
def nearest_per_class(spark, sf_dir):
    """The ten rows nearest the hyperplane of every class."""
    scores, model, _, _ = _decisions(spark, sf_dir)
    far = mg.hyperplane_distance(scores, mg.squared_norms(model))
    best = top_k_per_key(far.select("model_id", "id", "distance"), "model_id", 10, "distance")
    return best.select(F.col("model_id").cast("string").alias("model_id"), "id", rounded("distance").alias("distance"))


def _round_sql(r: int) -> str:
    """Balanced rows, means, weights, distances and picks of one round; ``lab{r}`` is what is labeled."""
    return f"""bal{r} AS (SELECT m, id, label FROM (SELECT *,
      row_number() OVER (PARTITION BY m, label = m ORDER BY md5('{SEED + r}:' || id), id) AS k,
      least(count(*) FILTER (label = m) OVER (PARTITION BY m), count(*) FILTER (label <> m) OVER (PARTITION BY m)) AS less
      FROM lab{r}) WHERE less = 0 OR k <= less),
  mean{r} AS (SELECT m, feature, avg(value) FILTER (label = m) AS pos, avg(value) FILTER (label <> m) AS neg
    FROM bal{r} JOIN f ON f.id = bal{r}.id GROUP BY m, feature),
  w{r} AS (SELECT m, feature, pos, neg, coalesce(pos - neg, 0) AS weight FROM mean{r}),
  b{r} AS (SELECT m, CASE WHEN count(pos) > 0 AND count(neg) > 0 THEN (sum(neg * neg) - sum(pos * pos)) / 2 ELSE 0 END AS bias,
    sum(weight * weight) AS w2 FROM w{r} GROUP BY m),
  d{r} AS (SELECT w{r}.m, f.id, train, sum(value * weight) + any_value(bias) AS decision, any_value(w2) AS w2
    FROM f JOIN w{r} ON w{r}.feature = f.feature JOIN b{r} ON b{r}.m = w{r}.m GROUP BY w{r}.m, f.id, train),
  q{r} AS (SELECT m, id FROM d{r} WHERE train AND id NOT IN (SELECT id FROM first)
      AND NOT EXISTS (FROM lab{r} l WHERE l.m = d{r}.m AND l.id = d{r}.id)
    QUALIFY row_number() OVER (PARTITION BY m ORDER BY CASE WHEN w2 = 0 THEN 0 ELSE round(abs(decision) / w2, 10) END, id) <= {ASKED}),
  lab{r + 1} AS (SELECT * FROM lab{r} UNION ALL SELECT m, q{r}.id, classLabel, {r + 1} FROM q{r} JOIN sp ON sp.id = q{r}.id)"""


def loop_sql(rounds: int) -> str:
    return f"""{VECTOR_SPLIT},
  first AS (SELECT id, classLabel AS label FROM sp WHERE train ORDER BY md5('5:' || id), id LIMIT {START_ROWS}),
  lab0 AS (SELECT c.m, id, label, 0 AS round FROM first, (SELECT DISTINCT label AS m FROM embeddings) c),
  {", ".join(_round_sql(r) for r in range(rounds + 1))},
  best AS (SELECT id, train, m AS pred FROM d{rounds} QUALIFY row_number() OVER (PARTITION BY id ORDER BY decision DESC, m) = 1)"""


def _sets(spark, sf_dir):
    """(state before the first round, answers, test rows)"""
    training, testing = vector_split(spark, sf_dir)
    first = training.where(random_cut(training, START_ROWS, 5)).select("id", "classLabel")
    classes = multiclass.class_list(vectors(spark, sf_dir))
    state = class_loop.start(training.select("id", "vec"), first, classes, seed=SEED)
    return state, training.select("id", F.col("classLabel").alias("label")), testing


@query(
    "class_rounds",
    f"""WITH {loop_sql(ROUNDS)} SELECT NULL::VARCHAR AS model_id, id, label, 0 AS round FROM first
    UNION ALL SELECT m::VARCHAR, id, label, round FROM lab{ROUNDS} WHERE round > 0""",
)
def class_rounds(spark, sf_dir):
    """Which learner asked for which row in which of three rounds; the loop is saved after the first
    and goes on from the save."""
    state, feed, _ = _sets(spark, sf_dir)
    path = f"{scratch_root(spark)}/tagwright-loop-{uuid.uuid4().hex}"
    class_loop.save(class_loop.learn(state, feed, 1, ASKED), path)
    rows = state.pool.unionByName(state.labeled.select("id", "vec"))
    state = class_loop.learn(class_loop.resume(rows, path), feed, ROUNDS - 1, ASKED)
    return state.labeled.select("model_id", "id", "label", "round")


@query(
    "class_loop_accuracy",
    f"""WITH {loop_sql(1)} SELECT round(100.0 * avg((pred = classLabel)::INTEGER), 6) AS accuracy, count(*) AS n_test
    FROM best JOIN sp ON sp.id = best.id WHERE NOT best.train""",
)
def class_loop_accuracy(spark, sf_dir):
    state, feed, testing = _sets(spark, sf_dir)
    state = class_loop.learn(state, feed, 1, ASKED)
    found = class_loop.accuracy(state, testing.select("id", "vec"), testing.select("id", "classLabel"))
    return found.withColumn("accuracy", rounded("accuracy"))


@query(
    "class_loop_predictions",
    f"""WITH {loop_sql(1)} SELECT id, pred, 'class ' || pred AS name, 'row ' || id AS origText FROM best
    WHERE train AND id NOT IN (SELECT id FROM lab1)""",
)
def class_loop_predictions(spark, sf_dir):
    """Classes of the rows that no learner has a label for."""
    state, feed, _ = _sets(spark, sf_dir)
    state = class_loop.learn(state, feed, 1, ASKED)
    texts = vectors(spark, sf_dir).select("id", F.concat(F.lit("row "), "id").alias("origText"))
    return class_loop.predict_rest(state, texts, {c: f"class {c}" for c in state.classes})
