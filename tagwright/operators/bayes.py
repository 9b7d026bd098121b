"""Naive Bayes over sparse feature rows with the exact semantics of a dense table.

A missing (id, feature) row is the value 0.  Moments, likelihoods and presence shares are
computed from the rows that exist and corrected for the zeros that do not.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.density import (
    DENSITIES, bernoulli_term, gaussian_log_density, literal, literal_array, probability_term,
)
from ..sources.scratch import materialize
from .lookup import BROADCAST_BYTES, lookup_join

LABEL = "classLabel"


def priors(labels: DataFrame, label_col: str = LABEL) -> DataFrame:
    """Share of each class among the labeled rows."""
    known = labels.where(F.col(label_col).isNotNull())
    total = known.select(F.count(F.lit(1))).scalar()
    return known.groupBy(label_col).agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) / total).alias("prior")
    )


def class_sizes(labels: DataFrame, label_col: str = LABEL) -> dict:
    """Rows per class in class order; one small aggregate."""
    known = labels.where(F.col(label_col).isNotNull())
    return {r[0]: r[1] for r in known.groupBy(label_col).count().orderBy(label_col).collect()}


def moment_arrays(
    features: DataFrame, labels: DataFrame, sizes: dict, label_col: str, id_col: str
) -> DataFrame:
    """``(feature, moments)``: mean and deviation per class, in the order of ``sizes``.

    One pass: Spark's mergeable central moments of the stored values are combined with the
    block of zeros.  An explicit NULL value is left out, as in a dense table.  A class with
    one row has a NULL deviation."""
    known = labels.where(F.col(label_col).isNotNull()).select(id_col, label_col)
    stored = (
        features.join(known, id_col)
        .groupBy("feature", label_col)
        .agg(
            F.count("value").alias("m"),
            (F.count(F.lit(1)) - F.count("value")).alias("nulls"),
            F.avg("value").alias("avg"),
            F.var_pop("value").alias("var"),
        )
    )
    parts = F.struct("m", "nulls", "avg", "var")
    per_feature = stored.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct(label_col, parts))).alias("stored")
    )
    classes, counts = literal_array(sizes), literal_array(float(n) for n in sizes.values())
    filled = f"""transform({classes}, (c, i) -> named_struct(
        'm', coalesce(try_element_at(stored, c).m, 0) + 0D,
        'n', {counts}[i] - coalesce(try_element_at(stored, c).nulls, 0),
        'avg', coalesce(try_element_at(stored, c).avg, 0D),
        'var', coalesce(try_element_at(stored, c).var, 0D)))"""
    moments = """transform(filled, s -> named_struct(
        'mean', try_divide(s.m * s.avg, s.n),
        'std', if(s.n > 1, sqrt((s.m * s.var + s.avg * s.avg * s.m * (s.n - s.m) / s.n) / (s.n - 1)), NULL)))"""
    rows = per_feature.select("feature", F.expr(filled).alias("filled"))
    return rows.select("feature", F.expr(moments).alias("moments"))


def class_moments(
    features: DataFrame, labels: DataFrame, label_col: str = LABEL, id_col: str = "id"
) -> DataFrame:
    """``(class, feature, mean, std)`` for every class and feature of the training rows."""
    sizes = class_sizes(labels, label_col)
    arrays = moment_arrays(features, labels, sizes, label_col, id_col)
    named = f"transform(moments, (s, i) -> named_struct('c', {literal_array(sizes)}[i], 's', s))"
    rows = arrays.select("feature", F.expr(f"inline({named})"))
    return rows.select(F.col("c").alias(label_col), "feature", "s.mean", "s.std")


def _usable(moment) -> Column:
    return F.coalesce((moment["std"] > 0) & moment["mean"].isNotNull(), F.lit(False))


def usable_features(moments: DataFrame) -> DataFrame:
    """Features with a positive deviation and a mean in every class."""
    good = F.coalesce((F.col("std") > 0) & F.col("mean").isNotNull(), F.lit(False))
    return moments.groupBy("feature").agg(F.bool_and(good).alias("usable")).where("usable").select("feature")


@dataclass(frozen=True)
class BayesModel:
    """``params`` is a stored table with one row per usable feature; its moments and shares of
    zeros are arrays in the order of ``classes``.  ``shares`` (multinoulli) is a stored table with
    one row per feature and value."""

    density: str
    log_terms: bool
    classes: list
    log_priors: list[float]
    base: list[float]
    params: DataFrame
    shares: DataFrame | None = None


def fit_bayes(
    features: DataFrame, labels: DataFrame, density: str = "gaussian", log_terms: bool = False,
    label_col: str = LABEL, id_col: str = "id",
) -> BayesModel:
    """Class priors and per-feature parameters, written once as a model table.

    ``base`` is the likelihood of an all-zero row, so scoring touches stored values only."""
    if density not in DENSITIES:
        raise ValueError(f"density must be one of {DENSITIES}, got {density!r}")
    sizes = class_sizes(labels, label_col)
    classes, total = list(sizes), sum(sizes.values())
    log_priors = [math.log(n / total) for n in sizes.values()]
    shares = None
    params = moment_arrays(features, labels, sizes, label_col, id_col).where(F.forall("moments", _usable))
    if density == "multinoulli":
        zeros, shares = _value_shares(features, labels, classes, sizes, label_col, id_col)
        params = params.join(zeros, "feature")
    params = materialize(params, "bayes")
    terms = _terms("0D", density, log_terms, len(classes))
    sums = params.select([F.expr(f"coalesce(sum({t}), 0D)") for t in terms]).first()
    return BayesModel(density, log_terms, classes, log_priors, list(sums), params, shares)


def _value_shares(features, labels, classes, sizes, label_col, id_col) -> tuple[DataFrame, DataFrame]:
    """What each value says about the classes, as two tables in the order of ``classes``.

    One row per feature with the share of zeros, and one row per feature and value other than
    zero with its shares, so no row grows with the number of distinct values."""
    known = labels.where(F.col(label_col).isNotNull()).select(id_col, label_col)
    counts = materialize(
        features.join(known, id_col).groupBy("feature", label_col, "value").agg(F.count(F.lit(1)).alias("n")), "value-counts"
    )
    own = lambda c, extra: F.sum(F.when((F.col(label_col) == F.lit(c)) & extra, F.col("n")))
    value = F.col("value")
    cells = []
    for i, c in enumerate(classes):
        cells.append(F.coalesce(own(c, value.isNotNull() & (value != 0)), F.lit(0)).cast("double").alias(f"s{i}"))
        cells.append((F.lit(sizes[c]) - F.coalesce(own(c, value.isNull()), F.lit(0))).cast("double").alias(f"t{i}"))
    sums = materialize(counts.groupBy("feature").agg(*cells), "value-sums")
    zeros = []
    for i in range(len(classes)):
        left = F.col(f"t{i}") - F.col(f"s{i}")
        zeros.append(F.struct(F.when(left > 0, left / F.col(f"t{i}")).alias("zero")))
    seen = counts.where("value <> 0").groupBy("feature", "value").agg(
        *[own(c, F.lit(True)).cast("double").alias(f"n{i}") for i, c in enumerate(classes)]
    )
    totals = sums.select("feature", *[f"t{i}" for i in range(len(classes))])
    shares = F.array(*[F.col(f"n{i}") / F.col(f"t{i}") for i in range(len(classes))])
    long = seen.join(totals, "feature").select(F.struct("feature", "value").alias("cell"), shares.alias("shares"))
    return sums.select("feature", F.array(*zeros).alias("values")), materialize(long, "value-shares")


def _terms(x: str, density: str, log_terms: bool, n_classes: int) -> list[str]:
    """One likelihood term per class for value ``x``; undefined terms count 0."""
    terms = []
    for i in range(n_classes):
        mean, std, value = f"moments[{i}].mean", f"moments[{i}].std", f"values[{i}]"
        if density == "gaussian":
            term = gaussian_log_density(x, mean, std)
        elif density == "bernoulli":
            term = bernoulli_term(x, mean, log_terms)
        else:
            seen = f"{value}.zero" if x == "0D" else f"if({x} = 0, {value}.zero, shares[{i}])"
            term = probability_term(seen, log_terms)
        terms.append(f"coalesce({term}, 0D)")
    return terms


def log_posterior(
    features: DataFrame, ids: DataFrame, model: BayesModel, id_col: str = "id",
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(id, scores, posterior)``: per-class arrays in the order of ``model.classes``.

    ``ids`` lists the rows to score, so a row without any stored value still gets the score
    of the all-zero row."""
    k = len(model.classes)
    joined = lookup_join(
        features.join(ids.select(id_col), id_col, "left_semi").where(F.col("value").isNotNull()),
        model.params, "feature", id_col, row_bytes=64 + 48 * k, broadcast_limit=broadcast_limit,
    )
    if model.shares is not None:
        joined = lookup_join(
            joined.withColumn("cell", F.struct("feature", "value")), model.shares, "cell", id_col,
            row_bytes=96 + 16 * k, how="left", broadcast_limit=broadcast_limit,
        )
    at_value = _terms("value", model.density, model.log_terms, k)
    at_zero = _terms("0D", model.density, model.log_terms, k)
    sums = joined.groupBy(id_col).agg(
        *[F.expr(f"sum({v} - {z})").alias(f"d{i}") for i, (v, z) in enumerate(zip(at_value, at_zero))]
    )
    scored = ids.select(id_col).join(sums, id_col, "left")
    totals = ", ".join(
        f"{literal(float(model.log_priors[i] + model.base[i]))} + coalesce(d{i}, 0D)" for i in range(k)
    )
    scored = scored.select(id_col, F.expr(f"array({totals})").alias("scores"))
    top = F.array_max("scores")
    log_sum = top + F.ln(
        F.aggregate("scores", F.lit(0.0), lambda acc, s: acc + F.exp(s - top))
    )
    return scored.withColumn("posterior", F.transform("scores", lambda s: s - log_sum))


def class_rows(
    scored: DataFrame, classes: list, id_col: str = "id", label_col: str = LABEL
) -> DataFrame:
    """Score arrays as one row per (id, class)."""
    labels = F.array(*[F.lit(c) for c in classes])
    cells = F.arrays_zip(labels.alias("c"), F.col("scores"), F.col("posterior"))
    return scored.select(id_col, F.explode(cells).alias("s")).select(
        id_col, F.col("s")["c"].alias(label_col),
        F.col("s.scores").alias("score"), F.col("s.posterior").alias("log_posterior"),
    )


def predict(scored: DataFrame, classes: list, id_col: str = "id") -> DataFrame:
    """Class of the largest posterior; classes are in order, so ties go to the smallest."""
    best = F.array_position("posterior", F.array_max("posterior"))
    return scored.select(
        id_col, F.element_at(F.array(*[F.lit(c) for c in classes]), best.cast("int")).alias("pred")
    )


def accuracy(
    predictions: DataFrame, truth: DataFrame, label_col: str = LABEL, id_col: str = "id"
) -> DataFrame:
    """Percent of the test rows predicted right; a row without a prediction is wrong."""
    hit = F.coalesce((F.col(label_col) == F.col("pred")).cast("int"), F.lit(0))
    return truth.select(id_col, label_col).join(predictions, id_col, "left").agg(
        (100.0 * F.avg(hit)).alias("accuracy"), F.count(F.lit(1)).alias("n_test")
    )


def informative_features(
    features: DataFrame, labels: DataFrame, k: int | None = 10, ignore_inf: bool = True,
    label_col: str = LABEL, id_col: str = "id",
) -> DataFrame:
    """Features whose presence differs most between two classes.

    Positive values count as present; negative ones keep their value.  A ratio over an absent
    feature is 0 or, with ``ignore_inf=False``, 9999."""
    present = features.withColumn("value", F.when(F.col("value") > 0, 1.0).otherwise(F.col("value")))
    moments = class_moments(present, labels, label_col, id_col)
    first = labels.where(F.col(label_col).isNotNull()).select(F.min(label_col)).scalar()
    means = moments.groupBy("feature").agg(
        F.max(F.when(F.col(label_col) == first, F.col("mean"))).alias("mean_0"),
        F.max(F.when(F.col(label_col) != first, F.col("mean"))).alias("mean_1"),
    )
    unbounded = F.lit(0.0 if ignore_inf else 9999.0)

    def ratio(a: str, b: str) -> Column:
        over_zero = F.when(F.col(a) > 0, unbounded).when(F.col(a) < 0, F.lit(float("-inf")))
        return F.when(F.col(b) == 0, over_zero).otherwise(F.try_divide(F.col(a), F.col(b)))

    rows = means.select("feature", ratio("mean_0", "mean_1").alias("ratio_0"), ratio("mean_1", "mean_0").alias("ratio_1"))
    top = F.greatest("ratio_0", "ratio_1")
    rows = rows.select(
        "feature", "ratio_0", "ratio_1", top.alias("best"),
        F.when(top.isNull(), None).when(F.col("ratio_0") == top, 0).otherwise(1).alias("likelier"),
    )
    return rows.orderBy(F.desc_nulls_last("best"), "feature").limit(k) if k else rows
