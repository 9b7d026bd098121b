"""Registered queries for margin models, kernels, evaluation and row selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.kernels import default_gamma, kernel_distance as kernel_distance_of
from ..operators import calibration as cal, evaluate as ev, margin as mg, queries as qs, training as tr
from ..plans import active, multiclass
from ..sources.scratch import materialize
from ..sources.tables import vector_features
from .bayes_queries import VECTOR_SPLIT, vector_split
from .neighbour_queries import DOT, following_pairs
from .registry import query, rounded, table, vectors

GAMMA = default_gamma(64)
DEGREE, COEF0 = 3, 1.0

# One model per class: halfway between the class mean and the mean of all other rows.
MODEL = f"""{VECTOR_SPLIT}, c AS (SELECT classLabel AS m, feature, sum(value) AS s, count(*)::DOUBLE AS n FROM f WHERE train GROUP BY ALL),
  a AS (SELECT feature, sum(s) AS s, sum(n) AS n FROM c GROUP BY feature),
  w AS (SELECT m, c.feature, c.s / c.n AS pos, (a.s - c.s) / (a.n - c.n) AS neg, pos - neg AS weight FROM c JOIN a ON a.feature = c.feature),
  b AS (SELECT m, -(sum(pos * pos) - sum(neg * neg)) / 2 AS bias, sum(weight * weight) AS w2 FROM w GROUP BY m)"""
DECISIONS = f"""{MODEL}, d AS (SELECT f.id, w.m AS model_id, sum(value * weight) + any_value(bias) AS decision
    FROM f JOIN w ON w.feature = f.feature JOIN b ON b.m = w.m WHERE NOT train GROUP BY ALL)"""


def _model(spark, sf_dir):
    training, testing = vector_split(spark, sf_dir)
    return mg.class_mean_model(vector_features(training, "id", "vec"), training), training, testing


def _decisions(spark, sf_dir):
    model, training, testing = _model(spark, sf_dir)
    return mg.decision_values(vector_features(testing, "id", "vec"), model, testing), model, training, testing


@query("decision_values", f"WITH {DECISIONS} SELECT id, model_id, round(decision, 6) + 0.0 AS decision FROM d")
def decision_values(spark, sf_dir):
    scores = _decisions(spark, sf_dir)[0]
    return scores.withColumn("decision", rounded("decision"))


@query("predict_sign", f"WITH {DECISIONS} SELECT id, model_id, (decision > 0)::INTEGER AS pred FROM d")
def predict_sign(spark, sf_dir):
    return mg.predict_sign(_decisions(spark, sf_dir)[0]).select("id", "model_id", "pred")


@query(
    "binary_scores",
    f"WITH {DECISIONS} SELECT id, model_id, round(-decision, 6) + 0.0 AS score_0, round(decision, 6) + 0.0 AS score_1 FROM d",
)
def binary_scores(spark, sf_dir):
    scores = mg.binary_scores(_decisions(spark, sf_dir)[0])
    return scores.select(
        "id", "model_id", rounded("score_0").alias("score_0"), rounded("score_1").alias("score_1")
    )


@query("single_class_argmax", f"WITH {DECISIONS} SELECT id, (decision > 0)::INTEGER AS pred FROM d WHERE model_id = 0")
def single_class_argmax(spark, sf_dir):
    scores = _decisions(spark, sf_dir)[0].where("model_id = 0")
    return qs.single_class_argmax(mg.binary_scores(scores))


OVO = f"""{MODEL}, mean AS (SELECT m, feature, pos FROM w), sq AS (SELECT m, sum(pos * pos) AS s FROM mean GROUP BY m),
  p AS (SELECT f.id, x.m AS i, y.m AS j, sum(value * (x.pos - y.pos)) AS dot FROM f JOIN mean x ON x.feature = f.feature
    JOIN mean y ON y.feature = f.feature AND y.m <> x.m WHERE NOT train GROUP BY ALL)"""


@query(
    "ovo_table",
    f"""WITH {OVO} SELECT id, i, j, round(dot - (a.s - b.s) / 2, 6) + 0.0 AS value FROM p
    JOIN sq a ON a.m = i JOIN sq b ON b.m = j""",
)
def ovo_table(spark, sf_dir):
    """Pairwise models from class means: one weight table, scored in one pass."""
    from ..operators.bayes import class_moments

    training, testing = vector_split(spark, sf_dir)
    means = class_moments(vector_features(training, "id", "vec"), training)
    per_feature = means.groupBy("feature").agg(
        F.sort_array(F.collect_list(F.struct("classLabel", "mean"))).alias("m")
    )
    sides = per_feature.select("feature", "m", F.posexplode("m").alias("at", "x")).select(
        "feature", "x", F.explode(F.slice("m", F.col("at") + 2, F.size("m"))).alias("y")
    )
    rows = sides.select(
        F.concat_ws("|", "x.classLabel", "y.classLabel").alias("model_id"),
        F.col("feature").cast("string").alias("feature"), F.col("x.mean").alias("a"), F.col("y.mean").alias("b"),
    )
    weights = rows.select("model_id", "feature", (F.col("a") - F.col("b")).alias("weight"))
    bias = rows.groupBy("model_id").agg((-F.sum(F.col("a") * F.col("a") - F.col("b") * F.col("b")) / 2).alias("weight"))
    model = weights.unionByName(bias.withColumn("feature", F.lit(mg.BIAS)))
    scores = mg.decision_values(vector_features(testing, "id", "vec"), materialize(model, "pairs"), testing)
    ends = F.split("model_id", r"\|")
    pairs = scores.select("id", ends[0].cast("int").alias("i"), ends[1].cast("int").alias("j"), "decision")
    return mg.ovo_table(pairs).withColumn("value", rounded("value"))


DISTANCE = f"""WITH {DECISIONS} SELECT id, model_id, round(abs(decision) / w2, 6) + 0.0 AS distance_w2,
    round(decision / sqrt(w2), 6) + 0.0 AS signed_norm FROM d JOIN b ON b.m = d.model_id"""


@query("hyperplane_distance", DISTANCE)
def hyperplane_distance(spark, sf_dir):
    scores, model, _, _ = _decisions(spark, sf_dir)
    norms = mg.squared_norms(model)
    far = mg.hyperplane_distance(scores, norms).withColumnRenamed("distance", "distance_w2")
    both = mg.hyperplane_distance(far, norms, signed=True, scale="norm")
    return both.select(
        "id", "model_id", rounded("distance_w2").alias("distance_w2"), rounded("distance").alias("signed_norm")
    )


@query("cautious_predict", f"WITH {DECISIONS} SELECT id, max((decision > 0)::INTEGER) AS pred FROM d GROUP BY id")
def cautious_predict(spark, sf_dir):
    return mg.cautious_predict(mg.predict_sign(_decisions(spark, sf_dir)[0]))


@query(
    "model_export",
    f"""WITH {MODEL} SELECT w.m AS model_id, feature::VARCHAR AS feature, round(weight, 6) + 0.0 AS coef,
    round(-bias, 6) + 0.0 AS rho FROM w JOIN b ON b.m = w.m""",
)
def model_export(spark, sf_dir):
    table = mg.export_model(_model(spark, sf_dir)[0])
    return table.select("model_id", "feature", rounded("coef").alias("coef"), rounded("rho").alias("rho"))


GAP = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))"
FOLLOWING = f"""k AS (SELECT x.vec_id AS a, y.vec_id AS b, {DOT.format(a='x.embedding', b='y.embedding')} AS ab,
    {DOT.format(a='x.embedding', b='x.embedding')} AS aa, {DOT.format(a='y.embedding', b='y.embedding')} AS bb,
    {GAP.format(a='x.embedding', b='y.embedding')} AS gap FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1)"""
POLY = f"pow({GAMMA} * {{x}} + {COEF0}, {DEGREE})"


@query(
    "kernel_matrix",
    f"""WITH {FOLLOWING} SELECT a, b, round(ab, 6) + 0.0 AS linear, round({POLY.format(x='ab')}, 6) + 0.0 AS poly,
    round(exp(-{GAMMA} * gap), 6) + 0.0 AS rbf,
    round((exp(2 * ({GAMMA} * ab)) - 1) / (exp(2 * ({GAMMA} * ab)) + 1), 6) + 0.0 AS sigmoid FROM k""",
)
def kernel_matrix(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    kernels = {kind: (kind, GAMMA, COEF0 if kind == "poly" else 0.0, DEGREE) for kind in ("linear", "poly", "rbf", "sigmoid")}
    found = mg.kernel_table(following_pairs(rows), rows, rows, kernels)
    return found.select("a", "b", *[rounded(kind).alias(kind) for kind in kernels])


@query("kernel_cosine", f"WITH {FOLLOWING} SELECT a, b, round(abs({POLY.format(x='ab')}) / sqrt({POLY.format(x='aa')} * {POLY.format(x='bb')}), 6) + 0.0 AS cosine FROM k")
def kernel_cosine(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    found = mg.kernel_pairs(following_pairs(rows), rows, rows, "poly", GAMMA, COEF0, DEGREE)
    return mg.pair_kernel_cosine(found).withColumn("cosine", rounded("cosine"))


@query(
    "kernel_distance",
    f"""WITH {FOLLOWING} SELECT a, b, round(sqrt(2 + 2 * exp(-{GAMMA} * gap)), 6) AS distance,
    round(sqrt(2 - 2 * exp(-{GAMMA} * gap)), 6) AS metric FROM k""",
)
def kernel_distance(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    found = mg.kernel_pairs(following_pairs(rows), rows, rows, "rbf", GAMMA)
    plus, minus = (kernel_distance_of(F.col("k_ab"), F.col("k_aa"), F.col("k_bb"), m) for m in (False, True))
    return found.select("a", "b", rounded(plus).alias("distance"), rounded(minus).alias("metric"))


KERNEL_DECISION = f"""{VECTOR_SPLIT}, sv AS (SELECT m.label AS model_id, sp.id, embedding,
    CASE WHEN classLabel = m.label THEN 1.0::DOUBLE ELSE -0.125::DOUBLE END AS coef
    FROM sp, (SELECT DISTINCT label FROM embeddings) m WHERE train)
  SELECT te.id, model_id::VARCHAR AS model_id, round(sum(coef * exp(-{GAMMA} * {GAP.format(a='te.embedding', b='sv.embedding')}))
    - model_id / 10.0::DOUBLE, 6) + 0.0 AS decision
  FROM sp te, sv WHERE NOT te.train GROUP BY te.id, model_id"""


@query("kernel_decision", f"WITH {KERNEL_DECISION}")
def kernel_decision(spark, sf_dir):
    """Exact kernel scores of a given support table: every training row supports every class."""
    training, testing = vector_split(spark, sf_dir)
    classes = training.select(F.sort_array(F.collect_set("classLabel"))).scalar()
    support = training.select("id", "vec", "classLabel", F.explode(classes).alias("model_id"))
    support = support.withColumn("coef", F.when(F.col("classLabel") == F.col("model_id"), 1.0).otherwise(-0.125))
    rho = training.select(F.col("classLabel").alias("model_id"), (F.col("classLabel") / 10.0).alias("rho")).distinct()
    scores = mg.kernel_decision_values(testing, support, rho, "rbf", GAMMA)
    return scores.withColumn("decision", rounded("decision"))


BINARY = f"{DECISIONS}, pb AS (SELECT d.id, model_id, (classLabel = model_id)::INTEGER AS classLabel, (decision > 0)::INTEGER AS pred FROM d JOIN sp ON sp.id = d.id)"
CELLS = """count(*) FILTER (pred = classLabel AND classLabel > 0) AS tp, count(*) FILTER (pred <> classLabel AND classLabel = 0) AS fp,
    count(*) FILTER (pred = classLabel AND classLabel = 0) AS tn, count(*) FILTER (pred <> classLabel AND classLabel > 0) AS fn"""


def _binary_predictions(spark, sf_dir):
    scores, _, training, testing = _decisions(spark, sf_dir)
    truth = testing.select("id", F.col("classLabel").alias("label"))
    predicted = mg.predict_sign(scores).join(truth, "id").select(
        "id", "model_id", (F.col("label") == F.col("model_id")).cast("int").alias("classLabel"), "pred", "decision"
    )
    return predicted, training


@query("confusion", f"WITH {BINARY} SELECT model_id, {CELLS} FROM pb GROUP BY model_id")
def confusion(spark, sf_dir):
    return ev.confusion(_binary_predictions(spark, sf_dir)[0], ["model_id"])


METRICS = f"""{BINARY}, t AS (SELECT {CELLS} FROM pb WHERE model_id = 3),
  lab AS (SELECT count(*) FILTER (classLabel = 3) AS p, count(*) FILTER (classLabel <> 3) AS q FROM sp WHERE train),
  u AS (SELECT p AS npos, tp + p AS tp, fp, tn + q AS tn, fn FROM t, lab)
  SELECT *, round((tp + tn)::DOUBLE / (tp + fp + tn + fn), 6) AS accuracy,
    round(CASE WHEN tp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS sensitivity FROM u"""


@query("learner_metrics", f"WITH {METRICS}")
def learner_metrics(spark, sf_dir):
    predicted, training = _binary_predictions(spark, sf_dir)
    labeled = training.select("id", (F.col("classLabel") == 3).cast("int").alias("classLabel"))
    found = ev.learner_metrics(predicted.where("model_id = 3"), labeled)
    return found.withColumn("accuracy", rounded("accuracy")).withColumn("sensitivity", rounded("sensitivity"))


GRID = f"""{BINARY}, g AS (SELECT pow(2.0::DOUBLE, c * 2 - 4) AS C, pow(2.0::DOUBLE, q * 2 - 10) AS gamma
    FROM range(7) t(c), range(7) s(q)),
  gp AS (SELECT pb.id, pb.classLabel, g.C, g.gamma, (decision * C > gamma)::INTEGER AS pred
    FROM pb JOIN d ON d.id = pb.id AND d.model_id = pb.model_id, g WHERE pb.model_id = 3),
  gm AS (SELECT C, gamma, {CELLS} FROM gp GROUP BY C, gamma),
  gx AS (SELECT *, tn::DOUBLE / nullif(tn + fp, 0) + 10 * (CASE WHEN tp = 0 THEN 1 ELSE tp::DOUBLE / (tp + fn) END) AS metric FROM gm)"""


def _grid(spark, sf_dir):
    predicted, _ = _binary_predictions(spark, sf_dir)
    points = ev.grid_points(predicted.where("model_id = 3"))
    pred = (F.col("decision") * F.col("C") > F.col("gamma")).cast("int")
    return ev.grid_metrics(points.withColumn("pred", pred))


@query("grid_points", f"WITH {GRID} SELECT id, C, gamma, pred FROM gp")
def grid_points(spark, sf_dir):
    predicted, _ = _binary_predictions(spark, sf_dir)
    pred = (F.col("decision") * F.col("C") > F.col("gamma")).cast("int")
    return ev.grid_points(predicted.where("model_id = 3")).select("id", "C", "gamma", pred.alias("pred"))


@query("grid_metrics", f"WITH {GRID} SELECT C, gamma, tp, fp, tn, fn, round(metric, 6) AS metric FROM gx")
def grid_metrics(spark, sf_dir):
    return _grid(spark, sf_dir).withColumn("metric", rounded("metric"))


@query("grid_best", f"WITH {GRID} SELECT C, gamma, round(metric, 6) AS metric FROM gx ORDER BY gx.metric DESC, C, gamma LIMIT 1")
def grid_best(spark, sf_dir):
    best = ev.grid_best(_grid(spark, sf_dir))
    return best.select("C", "gamma", rounded("metric").alias("metric"))


OVR = f"""{DECISIONS}, best AS (SELECT id, model_id AS pred FROM d
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY decision DESC, model_id) = 1)"""


@query("ovr_argmax", f"WITH {OVR} SELECT id, pred FROM best")
def ovr_argmax(spark, sf_dir):
    return qs.ovr_argmax(_decisions(spark, sf_dir)[0])


@query(
    "multiclass_accuracy",
    f"""WITH {OVR} SELECT round(100.0 * avg((pred = classLabel)::INTEGER), 6) AS accuracy, count(*) AS n_test
    FROM best JOIN sp ON sp.id = best.id""",
)
def multiclass_accuracy(spark, sf_dir):
    scores, _, _, testing = _decisions(spark, sf_dir)
    predicted = testing.select("id", "classLabel").join(qs.ovr_argmax(scores), "id")
    return ev.multiclass_accuracy(predicted).withColumn("accuracy", rounded("accuracy"))


@query(
    "uncertainty_query",
    f"""WITH {DECISIONS}, q AS (SELECT id, abs(decision) / w2 AS distance FROM d JOIN b ON b.m = d.model_id WHERE model_id = 3)
    SELECT id, round(distance, 6) + 0.0 AS distance FROM q ORDER BY q.distance, id LIMIT 10""",
)
def uncertainty_query(spark, sf_dir):
    scores, model, _, _ = _decisions(spark, sf_dir)
    far = mg.hyperplane_distance(scores.where("model_id = 3"), mg.squared_norms(model))
    return qs.uncertainty_query(far, 10).withColumn("distance", rounded("distance"))


@query(
    "random_query",
    f"WITH {VECTOR_SPLIT} SELECT id FROM sp WHERE NOT train ORDER BY md5('17:' || id), id LIMIT 10",
)
def random_query(spark, sf_dir):
    return qs.random_query(vector_split(spark, sf_dir)[1], 10, seed=17)


# Two greedy steps written out: the sums over the labeled rows, then over the pick as well.
DIVERSITY = f"""{VECTOR_SPLIT}, lab AS (SELECT id, embedding FROM sp WHERE train), pool AS (SELECT id, embedding FROM sp WHERE NOT train),
  s0 AS (SELECT id, embedding FROM pool ORDER BY md5('7:' || id), id LIMIT 1),
  l0 AS (SELECT * FROM lab UNION ALL SELECT * FROM s0),
  t1 AS (SELECT pool.id, any_value(pool.embedding) AS embedding, sum(exp(-{GAMMA} * {GAP.format(a='pool.embedding', b='l0.embedding')})) AS total
    FROM pool, l0 WHERE pool.id NOT IN (SELECT id FROM s0) GROUP BY pool.id),
  s1 AS (SELECT id, embedding FROM t1 ORDER BY round(total, 10) DESC, id LIMIT 1),
  t2 AS (SELECT t1.id, total + exp(-{GAMMA} * {GAP.format(a='t1.embedding', b='s1.embedding')}) AS total FROM t1, s1 WHERE t1.id <> s1.id),
  s2 AS (SELECT id FROM t2 ORDER BY round(total, 10) DESC, id LIMIT 1)
  SELECT id, 0 AS step FROM s0 UNION ALL SELECT id, 1 FROM s1 UNION ALL SELECT id, 2 FROM s2"""


@query("diversity_query", f"WITH {DIVERSITY}")
def diversity_query(spark, sf_dir):
    training, testing = vector_split(spark, sf_dir)
    return qs.diversity_query(testing, training, 3, "rbf", GAMMA, seed=7)


APPLY = f"""{VECTOR_SPLIT}, feed AS (SELECT id, CASE WHEN id % 7 = 0 THEN 99 ELSE classLabel END AS label FROM sp)
  SELECT p.id, CASE WHEN label = 99 THEN NULL ELSE label END AS classLabel,
    CASE WHEN label = 99 THEN 'rejected' ELSE 'labeled' END AS part FROM sp p JOIN feed ON feed.id = p.id WHERE NOT train
  UNION ALL SELECT id, CASE WHEN label = 99 THEN NULL ELSE label END, 'rejected' FROM feed WHERE id IN (SELECT id FROM sp WHERE train)
  UNION ALL SELECT id, NULL, 'pool' FROM feed WHERE label = 99 AND id IN (SELECT id FROM sp WHERE NOT train)"""


@query("apply_labels", f"WITH {APPLY}")
def apply_labels(spark, sf_dir):
    """Labels arrive for all rows, some outside the label set, some for rows not in the pool."""
    _, testing = vector_split(spark, sf_dir)
    pool = testing.select("id", F.lit(None).cast("int").alias("classLabel"))
    wrong = F.when(F.col("id") % 7 == 0, 99).otherwise(F.col("classLabel"))
    feed = vectors(spark, sf_dir).select("id", wrong.alias("label"))
    labeled, rest, rejected = qs.apply_labels(pool, feed, range(10))
    shown = F.when(F.col("label") != 99, F.col("label"))
    parts = [
        labeled.select("id", "classLabel", F.lit("labeled").alias("part")),
        rest.select("id", "classLabel", F.lit("pool").alias("part")),
        rejected.select("id", shown.alias("classLabel"), F.lit("rejected").alias("part")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("exclude_labeled", f"WITH {VECTOR_SPLIT} SELECT id FROM sp WHERE NOT train")
def exclude_labeled(spark, sf_dir):
    return qs.exclude_labeled(vectors(spark, sf_dir).select("id"), vector_split(spark, sf_dir)[0])


FINAL = f"""WITH {OVR} SELECT best.id, pred, 'class ' || pred AS name, 'row ' || best.id AS origText FROM best"""


@query("final_predictions", FINAL)
def final_predictions(spark, sf_dir):
    scores, _, training, _ = _decisions(spark, sf_dir)
    pool = vectors(spark, sf_dir).select("id", F.concat(F.lit("row "), "id").alias("origText"))
    names = {c: f"class {c}" for c in range(10)}
    return qs.final_predictions(scores, training, pool, names)


@query(
    "tag_labeled",
    f"""WITH {VECTOR_SPLIT} SELECT id, 'row ' || id AS origText, c.label AS class,
    CASE WHEN classLabel = c.label THEN 'class ' || c.label ELSE '0' END AS classLabel
    FROM sp, (SELECT DISTINCT label FROM embeddings) c WHERE train""",
)
def tag_labeled(spark, sf_dir):
    training, _ = vector_split(spark, sf_dir)
    from ..operators.labels import one_hot

    rows = training.select("id", "classLabel", F.concat(F.lit("row "), "id").alias("origText"))
    tasks = one_hot(rows, keep=("id", "origText"))
    return qs.tag_labeled(tasks, {c: f"class {c}" for c in range(10)})


FIT = tr.MarginParams()  # 1,024 random features, to a thousandth of the first gradient
SEARCH = tr.MarginParams(tolerance=1e-2)  # the 245 fits of a grid search


def _binary_sets(spark, sf_dir):
    training, testing = vector_split(spark, sf_dir)
    y = (F.col("classLabel") == 3).cast("int").alias("classLabel")
    return training.select("id", "vec", y), testing.select("id", "vec", y)


@query("fit_margin")
def fit_margin(spark, sf_dir):
    training, testing = _binary_sets(spark, sf_dir)
    model = tr.fit_margin(training.select("id", "vec"), training.select("id", "classLabel"), FIT)
    return mg.predict_sign(tr.margin_decisions(testing.select("id", "vec"), model))


@query("cv_predictions")
def cv_predictions(spark, sf_dir):
    training, _ = _binary_sets(spark, sf_dir)
    points = [(c, g) for c in ev.power_list(-4, 10, 2) for g in ev.power_list(-10, 3, 2)]
    return tr.cv_predictions(training.select("id", "vec"), training.select("id", "classLabel"), points, 5, SEARCH)


OPTIMALITY = f"""WITH {VECTOR_SPLIT} SELECT DISTINCT label::VARCHAR AS model_id, true AS fitted, true AS better_than_zero,
  true AS restored FROM embeddings"""


@query("fit_optimality", OPTIMALITY)
def fit_optimality(spark, sf_dir):
    """One model per class: fitted to the tolerance, with a smaller objective than no weights at
    all, and unchanged by a round trip through its table."""
    training, _ = vector_split(spark, sf_dir)
    labeled = training.select("id", "classLabel")
    classes = [r[0] for r in table(spark, sf_dir, "embeddings").select("label").distinct().collect()]
    model = multiclass.train_per_class(training.select("id", "vec"), labeled, classes, FIT)
    again = tr.MarginModel.from_table(materialize(model.table(spark), "model"))
    same = bool((again.weights == model.weights).all()) and again.specs == model.specs
    n = labeled.where("classLabel is not null").count()
    zero = F.col("C") * F.lit(n * (1 - FIT.smooth / 2))
    return model.table(spark).select(
        "model_id", (F.col("gradient") <= FIT.tolerance).alias("fitted"), (F.col("loss") < zero).alias("better_than_zero"),
        F.lit(same).alias("restored"),
    )


CV_FOLDS = f"""WITH {VECTOR_SPLIT}, y AS (SELECT id, (classLabel = 3)::INTEGER AS y FROM sp WHERE train AND classLabel IS NOT NULL),
  r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5('7:' || id), id) AS k FROM y)
  SELECT id, y AS label, ((k - 1) % 5)::INTEGER AS fold FROM r"""


@query("cv_folds", CV_FOLDS)
def cv_folds(spark, sf_dir):
    """The fold in which each row is held out."""
    training, _ = _binary_sets(spark, sf_dir)
    rows = tr.training_table(training.select("id", "vec"), training.select("id", "classLabel"), folds=5, seed=FIT.seed)
    return rows.select("id", "label", "fold")


@query("platt_probabilities")
def platt_probabilities(spark, sf_dir):
    training, testing = _binary_sets(spark, sf_dir)
    x, y = training.select("id", "vec"), training.select("id", "classLabel")
    held_out = tr.cv_decisions(x, y, [(FIT.C, GAMMA)], 5, FIT).select("id", "decision")
    calibration = tr.calibrate(held_out, y)
    scores = tr.margin_decisions(testing.select("id", "vec"), tr.fit_margin(x, y, FIT))
    return tr.probabilities(scores, calibration)


PROBABILITY_MEANS = f"""WITH {BINARY}, s AS (SELECT model_id, count(*) FILTER (classLabel = 1) AS p, count(*) FILTER (classLabel = 0) AS q
    FROM pb GROUP BY model_id)
  SELECT model_id::VARCHAR AS model_id, p + q AS n_rows, round((p * (p + 1.0) / (p + 2.0) + q / (q + 2.0)) / (p + q), 6) AS mean_target,
    true AS mean_agrees, true AS odds_follow FROM s"""


@query("probability_means", PROBABILITY_MEANS)
def probability_means(spark, sf_dir):
    """Sigmoids of all class learners fitted together: the mean probability of each is the mean of its
    targets, and log odds are a straight line of the decision."""
    predicted, _ = _binary_predictions(spark, sf_dir)
    rows = materialize(predicted.select("model_id", "decision", F.col("classLabel").alias("y")), "judged")
    found = cal.model_probabilities(rows, materialize(cal.calibrate_all(rows), "sigmoids"))
    n1, n0 = F.count_if(F.col("y") > 0), F.count_if(F.col("y") == 0)
    target = (n1 * (n1 + 1.0) / (n1 + 2.0) + n0 / (n0 + 2.0)) / (n1 + n0)
    means = found.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_rows"), target.alias("mean_target"), F.avg("p_1").alias("mean"),
        F.corr("decision", F.log(F.col("p_1") / F.col("p_0"))).alias("slope"),
    )
    agrees = F.abs(F.col("mean") - F.col("mean_target")) < 1e-7
    return means.select(
        F.col("model_id").cast("string").alias("model_id"), "n_rows", rounded("mean_target").alias("mean_target"),
        agrees.alias("mean_agrees"), (F.abs("slope") > 0.999).alias("odds_follow"),
    )


@query("active_loop")
def active_loop(spark, sf_dir):
    """Two rounds of ten uncertain rows, labels taken from the table, with a balanced grid search
    and fit at every rebuild."""
    training, testing = _binary_sets(spark, sf_dir)
    everything = vectors(spark, sf_dir).select("id", "vec")
    config = active.LearnerConfig("three", SEARCH, grid={"folds": 3, "c_range": (-2, 3, 2), "g_range": (-6, 1, 2)})
    state = active.LearnerState(
        config, everything, training.select("id", "classLabel"), training.select("id", "classLabel").limit(0),
        testing.select("id", "classLabel"),
    )
    state = active.seed_training(state, 40)
    labels = training.select("id", F.col("classLabel").alias("label"))
    state = active.active_learn(state, labels, 20, balance_first=True)
    return state.labeled


RANDOM_ROUNDS = f"""WITH {VECTOR_SPLIT}, y AS (SELECT id, (classLabel = 3)::INTEGER AS y FROM sp WHERE train AND classLabel IS NOT NULL),
  a AS (SELECT id FROM y ORDER BY md5('7:' || id), id LIMIT 40),
  b AS (SELECT id FROM y WHERE id NOT IN (FROM a) ORDER BY md5('7:' || id), id LIMIT 10),
  c AS (SELECT id FROM y WHERE id NOT IN (FROM a) AND id NOT IN (FROM b) ORDER BY md5('8:' || id), id LIMIT 10)
  SELECT id, y AS classLabel, CASE WHEN id IN (FROM a) THEN 0 WHEN id IN (FROM b) THEN 1 ELSE 2 END AS part
  FROM y WHERE id IN (FROM a) OR id IN (FROM b) OR id IN (FROM c)"""


@query("active_random_rounds", RANDOM_ROUNDS)
def active_random_rounds(spark, sf_dir):
    """Seed set and two rounds of the loop with random queries: which rows get their labels when."""
    training, _ = _binary_sets(spark, sf_dir)
    training = training.where("classLabel is not null")
    rows = training.select("id", "classLabel")
    config = active.LearnerConfig("three", FIT)
    state = active.LearnerState(config, training.select("id", "vec"), rows, rows.limit(0))
    parts = [active.seed_training(state, 40, build=False)]
    labels = rows.withColumnRenamed("classLabel", "label")
    for _ in range(2):
        parts.append(active.active_learn(parts[-1], labels, 10, active.query_random, rebuild_each=False, build_last=False))
    out = parts[0].labeled.withColumn("part", F.lit(0))
    for i in (1, 2):
        new = parts[i].labeled.join(parts[i - 1].labeled.select("id"), "id", "left_anti")
        out = out.unionByName(new.withColumn("part", F.lit(i)))
    return out


@query(
    "conflicting_labels",
    f"""WITH {VECTOR_SPLIT} SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE (id % 2)::INTEGER END AS classLabel,
      CASE WHEN id % 3 = 0 THEN 'conflicting labels' END AS reason FROM sp""",
)
def conflicting_labels(spark, sf_dir):
    """A feed that repeats every label and contradicts itself for every third id."""
    pool = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.lit(None).cast("int").alias("classLabel"))
    once = pool.select("id", (F.col("id") % 2).cast("int").alias("label"))
    feed = once.union(once).union(once.where("id % 3 = 0").select("id", 1 - F.col("label")))
    labeled, _, rejected = qs.apply_labels(pool, feed, (0, 1))
    told = rejected.select("id", F.lit(None).cast("int").alias("classLabel"), "reason").distinct()
    return labeled.withColumn("reason", F.lit(None).cast("string")).union(told)


@query("ovr_train")
def ovr_train(spark, sf_dir):
    training, testing = vector_split(spark, sf_dir)
    labeled = training.select("id", "classLabel")
    classes = multiclass.class_list(labeled)
    model = multiclass.train_per_class(training.select("id", "vec"), labeled, classes, FIT)
    return multiclass.predict_classes(testing.select("id", "vec"), model)
