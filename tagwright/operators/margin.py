"""Scoring with given linear or kernel models, and the geometry between rows.

A linear model is a table ``(model_id, feature, weight)``; the bias is the row of the
reserved feature ``__bias__``.  A kernel model is a support table
``(model_id, id, coef, vec)`` and ``rho`` per model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import kernels as kn
from ..functions.density import literal, literal_array
from ..sources.scratch import materialize
from .bayes import class_sizes, moment_arrays
from .blocks import kernel_sum
from .lookup import BROADCAST_BYTES, lookup_join

BIAS = "__bias__"
WIDE_MODELS = 16  # models whose sums share a row


def class_mean_model(
    features: DataFrame, labels: DataFrame, label_col: str = "classLabel", id_col: str = "id"
) -> DataFrame:
    """The hyperplane halfway between a class's mean and the mean of all other rows, for
    every class.  It needs no solver and can stand in for a fitted model anywhere."""
    sizes = class_sizes(labels, label_col)
    arrays = moment_arrays(features, labels, sizes, label_col, id_col)
    classes, counts = literal_array(sizes), literal_array(float(n) for n in sizes.values())
    total = literal(float(sum(sizes.values())))
    sums = f"aggregate(zip_with(moments, {counts}, (m, n) -> m.mean * n), 0D, (a, v) -> a + v)"
    cells = f"""inline(transform(moments, (m, i) -> named_struct('model_id', {classes}[i], 'pos', m.mean,
        'neg', try_divide(overall - m.mean * {counts}[i], {total} - {counts}[i]))))"""
    sides = arrays.withColumn("overall", F.expr(sums)).select(
        F.col("feature").cast("string").alias("feature"), F.expr(cells)
    )
    sides = materialize(sides, "class-means")
    weights = sides.select("model_id", "feature", (F.col("pos") - F.col("neg")).alias("weight"))
    square = F.sum(F.col("pos") * F.col("pos")) - F.sum(F.col("neg") * F.col("neg"))
    bias = sides.groupBy("model_id").agg((-square / 2).alias("weight")).select(
        "model_id", F.lit(BIAS).alias("feature"), "weight"
    )
    return weights.unionByName(bias)


def decision_values(
    features: DataFrame, model: DataFrame, ids: DataFrame, id_col: str = "id",
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(id, model_id, decision)`` for every row and model of a stored linear model table.

    Weights are grouped per feature, so a row's value is joined once for all models; rows
    are summed on the map side before the exchange, up to ``WIDE_MODELS`` models in one row."""
    own = model.where(F.col("feature") != BIAS)
    names = [r[0] for r in own.select("model_id").distinct().limit(WIDE_MODELS + 1).collect()]
    wide = 0 < len(names) <= WIDE_MODELS
    if wide:
        cells = F.array(*[F.sum(F.when(F.col("model_id") == m, F.col("weight"))) for m in names])
    else:
        cells = F.collect_list(F.struct("model_id", "weight"))
    by_feature = materialize(own.groupBy("feature").agg(cells.alias("w")), "weights")
    shape = by_feature.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("w")), F.lit(1))).first()
    keyed = features.select(id_col, F.col("feature").cast("string").alias("feature"), "value")
    joined = lookup_join(
        keyed, by_feature, "feature", id_col, row_bytes=48 + 24 * shape[1], n_rows=shape[0],
        broadcast_limit=broadcast_limit,
    )
    if wide:
        sums = joined.groupBy(id_col).agg(*[F.sum(F.col("value") * F.col("w")[i]).alias(f"dot{i}") for i in range(len(names))])
        each = [F.struct(F.lit(m).alias("model_id"), F.col(f"dot{i}").alias("dot")) for i, m in enumerate(names)]
        dots = sums.select(id_col, F.inline(F.array(*each)))
    else:
        dots = (
            joined.select(id_col, "value", F.explode("w").alias("w"))
            .groupBy(id_col, F.col("w.model_id").alias("model_id"))
            .agg(F.sum(F.col("value") * F.col("w.weight")).alias("dot"))
        )
    pairs = F.collect_list(F.struct("model_id", "bias"))
    bias_rows = model.groupBy("model_id").agg(
        F.coalesce(F.sum(F.when(F.col("feature") == BIAS, F.col("weight"))), F.lit(0.0)).alias("bias")
    )
    biases = bias_rows.select(F.map_from_entries(pairs)).scalar()
    every = ids.select(id_col, F.explode(biases).alias("model_id", "bias"))
    return every.join(dots, [id_col, "model_id"], "left").select(
        id_col, "model_id", (F.coalesce("dot", F.lit(0.0)) + F.col("bias")).alias("decision")
    )


def kernel_decision_values(
    rows: DataFrame, support: DataFrame, rho: DataFrame, kind: str = "rbf", gamma: float = 1.0,
    coef0: float = 0.0, degree: int = 3, id_col: str = "id",
) -> DataFrame:
    """Exact kernel decisions: sum of coefficient times kernel over the support rows, minus
    ``rho`` (a ``(model_id, rho)`` table with one row per model)."""
    sums = kernel_sum(rows, support, kind, gamma, coef0, degree, id_col=id_col)
    pairs = F.collect_list(F.struct(F.col("model_id").cast("string"), "rho"))
    rhos = rho.select(F.map_from_entries(pairs)).scalar()
    return sums.select(
        F.col("id").alias(id_col), "model_id",
        (F.col("total") - F.element_at(rhos, F.col("model_id"))).alias("decision"),
    )


def predict_sign(scores: DataFrame) -> DataFrame:
    return scores.withColumn("pred", F.when(F.col("decision") > 0, 1).otherwise(0))


def ovo_table(scores: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, i, j, value)`` holding each pairwise decision and its mirror image.

    The input has columns ``i``, ``j`` and ``decision``; one narrow explode, no second scan."""
    both = F.array(
        F.struct(F.col("i"), F.col("j"), F.col("decision").alias("value")),
        F.struct(F.col("j").alias("i"), F.col("i").alias("j"), (-F.col("decision")).alias("value")),
    )
    return scores.select(id_col, F.inline(both))


def binary_scores(scores: DataFrame, id_col: str = "id") -> DataFrame:
    """The two evaluation columns of a binary model: minus and plus the decision value."""
    return scores.select(
        id_col, "model_id", (-F.col("decision")).alias("score_0"), F.col("decision").alias("score_1")
    )


def squared_norms(model: DataFrame) -> DataFrame:
    """Squared weight norm per linear model, the bias left out."""
    square = F.when(F.col("feature") != BIAS, F.col("weight") * F.col("weight"))
    return model.groupBy("model_id").agg(F.coalesce(F.sum(square), F.lit(0.0)).alias("w2"))


def hyperplane_distance(
    scores: DataFrame, norms: DataFrame, signed: bool = False, scale: str = "w2"
) -> DataFrame:
    """Decision over the squared norm (``scale="norm"`` for the Euclidean distance); 0 for a
    model with zero weights.  ``norms`` is one small row per model, read as a map."""
    if scale not in ("w2", "norm"):
        raise ValueError(f"scale must be 'w2' or 'norm', got {scale!r}")
    lookup = norms.select(F.map_from_entries(F.collect_list(F.struct("model_id", "w2")))).scalar()
    w2 = F.element_at(lookup, F.col("model_id"))
    value = F.col("decision") if signed else F.abs("decision")
    unit = F.sqrt(w2) if scale == "norm" else w2
    return scores.withColumn("distance", F.coalesce(F.try_divide(value, unit), F.lit(0.0)))


def cautious_predict(predictions: DataFrame, id_col: str = "id") -> DataFrame:
    """The largest label any model gives a row."""
    if predictions.isEmpty():
        raise ValueError("no models have been initialized")
    return predictions.groupBy(id_col).agg(F.max("pred").alias("pred"))


def export_model(model: DataFrame) -> DataFrame:
    """A linear model's parameters: one row per weight with its position, and ``rho``, the
    negated bias, repeated on each row of the model."""
    bias = F.sum(F.when(F.col("feature") == BIAS, F.col("weight")))
    by_model = model.groupBy("model_id").agg(F.coalesce(-bias, F.lit(0.0)).alias("rho"))
    rhos = by_model.select(F.map_from_entries(F.collect_list(F.struct("model_id", "rho")))).scalar()
    return model.where(F.col("feature") != BIAS).select(
        "model_id", "feature", F.col("weight").alias("coef"), F.element_at(rhos, F.col("model_id")).alias("rho")
    )


def kernel_pairs(
    pairs: DataFrame, left: DataFrame, right: DataFrame, kind: str = "rbf", gamma: float = 1.0,
    coef0: float = 0.0, degree: int = 3, id_col: str = "id", vector_col: str = "vec",
) -> DataFrame:
    """``(a, b, k_ab, k_aa, k_bb)`` for requested pairs of rows."""
    joined = _pair_vectors(pairs, left, right, id_col, vector_col)

    def k(x: str, y: str) -> Column:
        return kn.kernel(F.col(x), F.col(y), kind, gamma, coef0, degree)

    return joined.select(
        "a", "b", k("a_vec", "b_vec").alias("k_ab"), k("a_vec", "a_vec").alias("k_aa"),
        k("b_vec", "b_vec").alias("k_bb"),
    )


def kernel_table(
    pairs: DataFrame, left: DataFrame, right: DataFrame, kernels: dict[str, tuple], id_col: str = "id", vector_col: str = "vec",
) -> DataFrame:
    """``(a, b, <name>, ...)``: several kernels of requested pairs, the vectors brought together once.
    ``kernels`` maps a column name to (kind, gamma, coef0, degree)."""
    joined = _pair_vectors(pairs, left, right, id_col, vector_col)
    values = [kn.kernel(F.col("a_vec"), F.col("b_vec"), *settings).alias(name) for name, settings in kernels.items()]
    return joined.select("a", "b", *values)


def _pair_vectors(pairs: DataFrame, left: DataFrame, right: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(id_col).alias(name), F.col(vector_col).alias(f"{name}_vec"))

    return pairs.join(side(left, "a"), "a").join(side(right, "b"), "b")


def pair_kernel_cosine(kernel_rows: DataFrame) -> DataFrame:
    value = kn.kernel_cosine(F.col("k_ab"), F.col("k_aa"), F.col("k_bb"))
    return kernel_rows.select("a", "b", value.alias("cosine"))


def pair_kernel_distance(kernel_rows: DataFrame, metric: bool = False) -> DataFrame:
    value = kn.kernel_distance(F.col("k_ab"), F.col("k_aa"), F.col("k_bb"), metric)
    return kernel_rows.select("a", "b", value.alias("distance"))
