"""Confusion counts, learner metrics and the grid metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .pool import minority_stats


def confusion(
    predictions: DataFrame, by: Sequence[str] = (), label_col: str = "classLabel", pred_col="pred"
) -> DataFrame:
    """tp, fp, tn, fn; a row is positive if its true label is above 0.  A missing prediction is
    wrong."""
    right = F.coalesce(F.col(label_col) == F.col(pred_col), F.lit(False))
    positive = F.col(label_col) > 0
    cells = {
        "tp": right & positive, "fp": ~right & ~positive, "tn": right & ~positive, "fn": ~right & positive
    }
    return predictions.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in cells.items()])


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def learner_metrics(
    predictions: DataFrame, labeled: DataFrame | None = None, label_col: str = "classLabel",
    pred_col: str = "pred", sens_when_no_tp: float = 0.0,
) -> DataFrame:
    """One row of counts, accuracy and sensitivity over the test predictions.

    With ``labeled`` the minority rows found while labeling count as true positives and the
    others as true negatives.  No test rows, no result row."""
    if labeled is None:
        found, others = F.lit(0).cast("long"), F.lit(0).cast("long")
    else:
        stats = minority_stats(labeled, label_col)
        found = stats.select("minority_rows").scalar()
        others = stats.select("majority_rows").scalar()
    tested = predictions.where(F.col(label_col).isNotNull())
    counts = confusion(tested, (), label_col, pred_col).where("tp + fp + tn + fn > 0")
    counts = counts.select(
        found.alias("npos"), (F.col("tp") + found).alias("tp"), "fp",
        (F.col("tn") + others).alias("tn"), "fn",
    )
    tp, total = F.col("tp"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return counts.withColumn("accuracy", _ratio(tp + F.col("tn"), total)).withColumn(
        "sensitivity",
        F.when(tp == 0, F.lit(sens_when_no_tp)).otherwise(_ratio(tp, tp + F.col("fn"))),
    )


def power_list(low: int, high: int, step: int) -> list[float]:
    """Powers of two with exponents from ``low`` below ``high``."""
    return [2.0**d for d in range(low, high, step)]


def grid_points(
    df: DataFrame, c_range=(-4, 10, 2), g_range=(-10, 3, 2), linear: bool = False
) -> DataFrame:
    """Every row of ``df`` once per (C, gamma) point; a linear kernel has gamma 1 only."""
    def powers(low, high, step):
        exponents = F.sequence(F.lit(low), F.lit(high - 1), F.lit(step))
        return F.transform(exponents, lambda d: F.pow(F.lit(2.0), d))

    gammas = F.array(F.lit(1.0)) if linear else powers(*g_range)
    return df.withColumn("C", F.explode(powers(*c_range))).withColumn("gamma", F.explode(gammas))


def grid_metrics(
    predictions: DataFrame, beta: float = 10.0, sens_only: bool = False, sens_when_no_tp: float = 1.0,
    by: Sequence[str] = ("C", "gamma"), label_col: str = "classLabel", pred_col: str = "pred",
) -> DataFrame:
    """Specificity plus ``beta`` times sensitivity of the pooled held-out predictions.

    Without true positives sensitivity is 1; without negatives the metric is NULL."""
    counts = confusion(predictions, by, label_col, pred_col)
    tp = F.col("tp")
    sensitivity = F.when(tp == 0, F.lit(sens_when_no_tp)).otherwise(_ratio(tp, tp + F.col("fn")))
    specificity = _ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    metric = sensitivity if sens_only else specificity + beta * sensitivity
    return counts.withColumn("metric", metric)


def grid_best(metrics: DataFrame) -> DataFrame:
    """The best point; the first in (C, gamma) order among equals."""
    return metrics.orderBy(F.desc_nulls_last("metric"), "C", "gamma").limit(1)


def multiclass_accuracy(
    predictions: DataFrame, label_col: str = "classLabel", pred_col: str = "pred"
) -> DataFrame:
    hit = F.coalesce((F.col(label_col) == F.col(pred_col)).cast("int"), F.lit(0))
    return predictions.agg((100.0 * F.avg(hit)).alias("accuracy"), F.count(F.lit(1)).alias("n_test"))
