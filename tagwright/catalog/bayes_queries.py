"""Registered queries for naive Bayes, on dense vectors and on sparse term counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bayes as nb, text as tx
from ..operators.sampling import ratio_split
from ..sources.scratch import materialize
from ..sources.tables import vector_features
from .corpus import COUNTS, STOPWORDS, documents
from .registry import query, rounded, table, vectors

VECTOR_SPLIT = """sp AS (SELECT vec_id AS id, label AS classLabel, embedding,
    row_number() OVER (ORDER BY md5('11:' || vec_id), vec_id) <= (SELECT floor(count(*) * 0.8) FROM embeddings) AS train
    FROM embeddings),
  f AS (SELECT id, classLabel, train, generate_subscripts(embedding, 1) - 1 AS feature,
    unnest(embedding)::DOUBLE AS value FROM sp)"""
VECTOR_MOMENTS = f"""{VECTOR_SPLIT}, mo AS (SELECT classLabel, feature, avg(value) AS mean, stddev_samp(value) AS std
    FROM f WHERE train GROUP BY ALL)"""
TEXT_SPLIT = f"""{COUNTS}, sp AS (SELECT doc_id AS id, quality AS classLabel,
    row_number() OVER (ORDER BY md5('13:' || doc_id), doc_id) <= (SELECT floor(count(*) * 0.8) FROM labels) AS train
    FROM labels),
  n AS (SELECT classLabel, count(*)::DOUBLE AS n FROM sp WHERE train GROUP BY 1),
  pr AS (SELECT classLabel, n, ln(n / (SELECT sum(n) FROM n)) AS lp FROM n)"""
# sums of integer counts are exact, so a deviation of 0 is exact as well
TEXT_MOMENTS = f"""{TEXT_SPLIT}, sums AS (SELECT term, classLabel, sum(tf)::DOUBLE AS s, sum(tf * tf)::DOUBLE AS q
    FROM bag JOIN sp ON doc_id = id WHERE train GROUP BY ALL),
  terms AS (SELECT DISTINCT term FROM sums),
  mo AS (SELECT t.term, n.classLabel, n.n, coalesce(s, 0) / n.n AS mean,
    CASE WHEN n.n > 1 THEN sqrt((coalesce(q, 0) - coalesce(s, 0) * coalesce(s, 0) / n.n) / (n.n - 1)) END AS std
    FROM terms t CROSS JOIN n LEFT JOIN sums ON sums.term = t.term AND sums.classLabel = n.classLabel),
  us AS (SELECT term FROM mo GROUP BY term HAVING bool_and(coalesce(std > 0, false)))"""


def vector_split(spark, sf_dir):
    return ratio_split(vectors(spark, sf_dir), 0.8, seed=11)


def text_sets(spark, sf_dir):
    """Stored sparse term counts of the labeled documents, and the labels of the training and
    testing ones.  Documents without a label are left out before their texts are taken apart."""
    known = table(spark, sf_dir, "labels").select("doc_id")
    docs = documents(spark, sf_dir).join(known, "doc_id", "left_semi")
    counts = tx.bag_of_words(tx.remove_stopwords(tx.tokenize(docs), STOPWORDS)).select(
        F.col("doc_id").alias("id"), F.col("term").alias("feature"), F.col("tf").cast("double").alias("value")
    )
    counts = materialize(counts, "counts")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("classLabel")
    )
    return counts, *ratio_split(labels, 0.8, seed=13)


@query(
    "priors",
    f"""WITH {VECTOR_SPLIT} SELECT classLabel, round(count(*)::DOUBLE / (SELECT count(*) FROM sp WHERE train), 6) AS prior
    FROM sp WHERE train GROUP BY 1""",
)
def priors(spark, sf_dir):
    training, _ = vector_split(spark, sf_dir)
    return nb.priors(training).select("classLabel", rounded("prior").alias("prior"))


@query(
    "class_moments",
    f"WITH {VECTOR_MOMENTS} SELECT classLabel, feature::INTEGER AS feature, round(mean, 6) + 0.0 AS mean, round(std, 6) AS std FROM mo",
)
def class_moments(spark, sf_dir):
    training, _ = vector_split(spark, sf_dir)
    moments = nb.class_moments(vector_features(training, "id", "vec"), training)
    return moments.select("classLabel", "feature", rounded("mean").alias("mean"), rounded("std").alias("std"))


@query(
    "class_moments_text",
    f"WITH {TEXT_MOMENTS} SELECT classLabel, term AS feature, round(mean, 6) AS mean, round(std, 6) AS std FROM mo",
)
def class_moments_text(spark, sf_dir):
    counts, training, _ = text_sets(spark, sf_dir)
    moments = nb.class_moments(counts, training)
    return moments.select("classLabel", "feature", rounded("mean").alias("mean"), rounded("std").alias("std"))


@query("usable_features", f"WITH {TEXT_MOMENTS} SELECT term AS feature FROM us")
def usable_features(spark, sf_dir):
    counts, training, _ = text_sets(spark, sf_dir)
    return nb.usable_features(nb.class_moments(counts, training))


def _vector_scores(spark, sf_dir, density="gaussian", log_terms=False):
    training, testing = vector_split(spark, sf_dir)
    model = nb.fit_bayes(vector_features(training, "id", "vec"), training, density, log_terms)
    scored = nb.log_posterior(vector_features(testing, "id", "vec"), testing, model)
    return model, scored, testing


def _text_scores(spark, sf_dir, density="gaussian", log_terms=False):
    counts, training, testing = text_sets(spark, sf_dir)
    model = nb.fit_bayes(counts, training, density, log_terms)
    return model, nb.log_posterior(counts, testing, model), testing


def _score_rows(model, scored, digits):
    rows = nb.class_rows(scored, model.classes)
    return rows.select(
        "id", "classLabel", rounded("score", digits).alias("score"),
        rounded("log_posterior", digits).alias("log_posterior"),
    )


def _posterior_sql(scores: str, digits: int) -> str:
    """From ``sc(id, classLabel, score)`` to normalised rows."""
    return f"""WITH {scores}, b AS (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM sc),
  po AS (SELECT id, classLabel, score, score - (top + ln(sum(exp(score - top)) OVER (PARTITION BY id))) AS lpost FROM b)
  SELECT id, classLabel, round(score, {digits}) + 0.0 AS score, round(lpost, {digits}) + 0.0 AS log_posterior FROM po"""


DENSITY = "exp(-(x - mean) * (x - mean) / (2 * std * std)) / (sqrt(2 * pi()) * std)"
VECTOR_SCORES = f"""{VECTOR_MOMENTS}, pr AS (SELECT classLabel, ln(count(*)::DOUBLE / (SELECT count(*) FROM sp WHERE train)) AS lp
    FROM sp WHERE train GROUP BY 1),
  us AS (SELECT feature FROM mo GROUP BY feature HAVING bool_and(coalesce(std > 0, false))),
  x AS (SELECT id, mo.classLabel, {DENSITY.replace("x -", "value -")} AS density FROM f JOIN us USING (feature)
    JOIN mo ON mo.feature = f.feature WHERE NOT train),
  sc AS (SELECT x.id, x.classLabel, any_value(lp) + coalesce(sum(ln(nullif(density, 0))), 0) AS score
    FROM x JOIN pr ON x.classLabel = pr.classLabel GROUP BY ALL)"""


def _text_scores_sql(term: str) -> str:
    """Dense evaluation: every test document against every usable term, zeros included."""
    return f"""{TEXT_MOMENTS}, um AS (SELECT mo.* FROM mo JOIN us USING (term)),
  x AS (SELECT te.id, um.term, um.classLabel, um.mean, um.std, coalesce(bag.tf, 0)::DOUBLE AS x
    FROM (SELECT id FROM sp WHERE NOT train) te CROSS JOIN um LEFT JOIN bag ON bag.doc_id = te.id AND bag.term = um.term),
  {term}
  sc AS (SELECT te.id, pr.classLabel, lp + coalesce((SELECT sum(t) FROM tm WHERE tm.id = te.id AND tm.classLabel = pr.classLabel), 0) AS score
    FROM (SELECT id FROM sp WHERE NOT train) te CROSS JOIN pr)"""


GAUSS_TERM = f"tm AS (SELECT id, classLabel, ln(nullif({DENSITY}, 0)) AS t FROM x),"
BERNOULLI_TERM = "tm AS (SELECT id, classLabel, CASE WHEN x <> 0 THEN mean ELSE 1 - mean END AS t FROM x),"


def _multinoulli_term(value: str) -> str:
    return f"""stored AS (SELECT term, classLabel, tf::DOUBLE AS v, count(*)::DOUBLE AS c FROM bag JOIN sp ON doc_id = id
    WHERE train AND term IN (SELECT term FROM us) GROUP BY ALL),
  zeros AS (SELECT um.term, um.classLabel, 0.0::DOUBLE AS v, um.n - coalesce(sum(c), 0) AS c
    FROM um LEFT JOIN stored s ON s.term = um.term AND s.classLabel = um.classLabel GROUP BY um.term, um.classLabel, um.n),
  shares AS (SELECT a.term, a.classLabel, v, c / n AS p FROM (SELECT * FROM stored UNION ALL SELECT * FROM zeros WHERE c > 0) a
    JOIN n ON n.classLabel = a.classLabel),
  tm AS (SELECT x.id, x.classLabel, {value} AS t FROM x LEFT JOIN shares s
    ON s.term = x.term AND s.classLabel = x.classLabel AND s.v = x.x),"""


@query("gnb_log_posterior", _posterior_sql(VECTOR_SCORES, 6))
def gnb_log_posterior(spark, sf_dir):
    model, scored, _ = _vector_scores(spark, sf_dir)
    return _score_rows(model, scored, 6)


@query("gnb_text_log_posterior", _posterior_sql(_text_scores_sql(GAUSS_TERM), 4))
def gnb_text_log_posterior(spark, sf_dir):
    model, scored, _ = _text_scores(spark, sf_dir)
    return _score_rows(model, scored, 4)


@query("bernoulli_scores", _posterior_sql(_text_scores_sql(BERNOULLI_TERM), 4))
def bernoulli_scores(spark, sf_dir):
    model, scored, _ = _text_scores(spark, sf_dir, "bernoulli")
    return _score_rows(model, scored, 4)


@query("multinoulli_scores", _posterior_sql(_text_scores_sql(_multinoulli_term("p")), 4))
def multinoulli_scores(spark, sf_dir):
    model, scored, _ = _text_scores(spark, sf_dir, "multinoulli")
    return _score_rows(model, scored, 4)


VECTOR_VALUES = f"""WITH {VECTOR_SPLIT}, n AS (SELECT classLabel, count(*)::DOUBLE AS n FROM sp WHERE train GROUP BY 1),
  rf AS (SELECT id, classLabel, train, feature, round(value, 1) + 0.0 AS value FROM f),
  us AS (SELECT feature FROM (SELECT feature, classLabel, stddev_samp(value) AS sd FROM rf WHERE train GROUP BY ALL)
    GROUP BY feature HAVING bool_and(coalesce(sd > 0, false))),
  sh AS (SELECT feature, classLabel, value, count(*) AS c FROM rf WHERE train GROUP BY ALL),
  sc AS (SELECT t.id, n.classLabel, ln(n.n / (SELECT sum(n) FROM n)) + sum(coalesce(c / n.n, 0)) AS score
    FROM rf t JOIN us ON t.feature = us.feature CROSS JOIN n
    LEFT JOIN sh ON sh.feature = t.feature AND sh.value = t.value AND sh.classLabel = n.classLabel
    WHERE NOT train GROUP BY t.id, n.classLabel, n.n)
  SELECT id, classLabel, round(score, 5) + 0.0 AS score FROM sc"""


@query("multinoulli_vectors", VECTOR_VALUES)
def multinoulli_vectors(spark, sf_dir):
    """Shares of the rounded components of each class, where a feature has many values."""
    training, testing = vector_split(spark, sf_dir)

    def cells(rows):
        return vector_features(rows, "id", "vec").withColumn("value", F.round("value", 1) + F.lit(0.0))

    model = nb.fit_bayes(cells(training), training, "multinoulli")
    scored = nb.log_posterior(cells(testing), testing, model)
    return nb.class_rows(scored, model.classes).select("id", "classLabel", rounded("score", 5).alias("score"))


@query("multinoulli_log_scores", _posterior_sql(_text_scores_sql(_multinoulli_term("ln(p)")), 4))
def multinoulli_log_scores(spark, sf_dir):
    model, scored, _ = _text_scores(spark, sf_dir, "multinoulli", log_terms=True)
    return _score_rows(model, scored, 4)


PREDICTED = f"""WITH {VECTOR_SCORES}, best AS (SELECT id, classLabel AS pred,
    row_number() OVER (PARTITION BY id ORDER BY score DESC, classLabel) AS rn FROM sc)"""


@query("nb_predict", f"{PREDICTED} SELECT id, pred FROM best WHERE rn = 1")
def nb_predict(spark, sf_dir):
    model, scored, _ = _vector_scores(spark, sf_dir)
    return nb.predict(scored, model.classes)


@query(
    "nb_accuracy",
    f"""{PREDICTED} SELECT round(100.0 * avg((pred = classLabel)::INTEGER), 6) AS accuracy, count(*) AS n_test
    FROM best JOIN sp USING (id) WHERE rn = 1""",
)
def nb_accuracy(spark, sf_dir):
    model, scored, testing = _vector_scores(spark, sf_dir)
    found = nb.accuracy(nb.predict(scored, model.classes), testing)
    return found.withColumn("accuracy", rounded("accuracy"))


@query(
    "nb_accuracy_text",
    f"""WITH {_text_scores_sql(GAUSS_TERM)}, best AS (SELECT id, classLabel AS pred,
    row_number() OVER (PARTITION BY id ORDER BY score DESC, classLabel) AS rn FROM sc)
  SELECT round(100.0 * avg((pred = classLabel)::INTEGER), 6) AS accuracy, count(*) AS n_test
    FROM best JOIN sp USING (id) WHERE rn = 1""",
)
def nb_accuracy_text(spark, sf_dir):
    model, scored, testing = _text_scores(spark, sf_dir)
    found = nb.accuracy(nb.predict(scored, model.classes), testing)
    return found.withColumn("accuracy", rounded("accuracy"))


INFORMATIVE = f"""{TEXT_SPLIT}, p AS (SELECT term, count(*) FILTER (classLabel = 0)::DOUBLE AS c0,
    count(*) FILTER (classLabel = 1)::DOUBLE AS c1 FROM bag JOIN sp ON doc_id = id WHERE train GROUP BY term),
  m AS (SELECT term, c0 / (SELECT n FROM n WHERE classLabel = 0) AS m0, c1 / (SELECT n FROM n WHERE classLabel = 1) AS m1 FROM p),
  r AS (SELECT term AS feature, CASE WHEN m1 = 0 THEN INF ELSE m0 / m1 END AS ratio_0,
    CASE WHEN m0 = 0 THEN INF ELSE m1 / m0 END AS ratio_1 FROM m),
  g AS (SELECT *, greatest(ratio_0, ratio_1) AS best FROM r)
  SELECT feature, round(ratio_0, 6) AS ratio_0, round(ratio_1, 6) AS ratio_1, round(best, 6) AS best,
    CASE WHEN ratio_0 >= ratio_1 THEN 0 ELSE 1 END AS likelier FROM g"""


def _informative(spark, sf_dir, k, ignore_inf):
    counts, training, _ = text_sets(spark, sf_dir)
    rows = nb.informative_features(counts, training, k, ignore_inf)
    for c in ("ratio_0", "ratio_1", "best"):
        rows = rows.withColumn(c, rounded(c))
    return rows


@query("informative_features", f"WITH {INFORMATIVE.replace('INF', '0')} ORDER BY g.best DESC, feature LIMIT 25")
def informative_features(spark, sf_dir):
    return _informative(spark, sf_dir, 25, True)


@query("feature_ratios", f"WITH {INFORMATIVE.replace('INF', '9999')}")
def feature_ratios(spark, sf_dir):
    """Every feature's ratios, features of one class only at 9999."""
    return _informative(spark, sf_dir, None, False)
