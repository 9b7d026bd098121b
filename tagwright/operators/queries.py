"""Choosing pool rows to label, applying labels, combining one model per class."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.order import hash_key
from ..sources.scratch import materialize
from .blocks import _kernel_matrix, _self_kernel, dense_matrix, kernel_sum
from .labels import name_classes
from .topk import kept_rows, merge_best

# Picks of the greedy query between two stored score tables, rows it keeps at hand, and the
# decimals at which sums are compared, so that equal ones fall back to the smallest id.
STEPS_PER_TABLE = 16
LEADERS = 256
SCORE_DIGITS = 10


def uncertainty_query(distances: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    """The k pool rows nearest the hyperplane; equal distances in id order."""
    return distances.select(id_col, "distance").orderBy("distance", id_col).limit(k)


def random_query(pool: DataFrame, k: int, seed: int, id_col: str = "id") -> DataFrame:
    """k distinct pool ids in seeded random order."""
    return pool.select(id_col).orderBy(hash_key(seed, id_col), id_col).limit(k)


def _kernel_cosines(a: np.ndarray, b: np.ndarray, kernel: tuple) -> np.ndarray:
    values = np.abs(_kernel_matrix(a, b, *kernel))
    product = np.outer(_self_kernel(a, *kernel), _self_kernel(b, *kernel))
    return np.where(product == 0, 0.0, values / np.sqrt(np.where(product > 0, product, 1.0)))


def _current_leaders(
    scores: DataFrame, recent: np.ndarray, taken: list, kernel: tuple, largest: bool, most: float, id_col: str
) -> tuple[list, np.ndarray, np.ndarray]:
    """The best ``LEADERS`` open rows after the ``recent`` picks: ids, totals, vectors.

    One narrow pass.  ``total`` of a row is its sum before those picks, and each can add 0 to
    ``most``; a row whose bound does not reach the task's last leader is not evaluated."""
    sign = -1.0 if largest else 1.0

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worst = [math.inf]  # signed value of the last leader, once there are enough

        def tables():
            kept_values = np.empty(0)
            for batch in batches:
                table = pa.Table.from_batches([batch])
                stale = np.asarray(table.column("total"))
                with np.errstate(invalid="ignore"):
                    bound = sign * stale + (-most * len(recent) if largest else 0.0)
                at = np.flatnonzero(~(bound > worst[0] + 1e-9))
                if not len(at):
                    continue
                table = table.take(pa.array(at))
                now = stale[at]
                if len(recent):
                    now = now + _kernel_cosines(dense_matrix(table), recent, kernel).sum(axis=1)
                kept_values = np.sort(np.append(kept_values, sign * now))[:LEADERS]
                if len(kept_values) == LEADERS:
                    worst[0] = kept_values[-1]
                table = table.drop_columns(["total"]).append_column("total", pa.array(now))
                table = table.append_column("value", pa.array(np.round(now, SCORE_DIGITS)))
                yield table.append_column("all", pa.array(np.zeros(len(now), np.int32))).select(names)

        kept = kept_rows(tables(), "all", ["value", id_col], LEADERS, largest)
        if kept is not None:
            yield from kept.to_batches()

    names = [id_col, "vec", "_task", "total", "value", "all"]
    open_rows = scores.where(~F.col(id_col).isin(taken)) if taken else scores
    id_type = scores.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, vec array<double>, _task int, total double, value double, all int"
    found = open_rows.select(id_col, "vec", F.spark_partition_id().alias("_task"), "total").mapInArrow(lead, schema)
    table = merge_best(found, "all", ["value", id_col], LEADERS, largest).toArrow()
    return table.column(id_col).to_pylist(), np.asarray(table.column("total")).copy(), dense_matrix(table)


def diversity_query(
    pool: DataFrame, labeled: DataFrame, k: int, kind: str = "rbf", gamma: float = 1.0,
    coef0: float = 0.0, degree: int = 3, start_random: bool = True, prefer: str = "similar",
    seed: int = 7, id_col: str = "id",
) -> DataFrame:
    """Greedy selection by the summed kernel cosine to everything labeled or picked so far.

    The default takes the largest sum each time, ``prefer="dissimilar"`` the smallest.  As
    documented for the batch size, one pick is the random start if ``start_random``, and
    k - 1 greedy picks follow.  Returns ``(id, step)``; step 0 is the random start.

    The sums over the labeled rows are computed once and stored.  A pass over the pool brings
    its few leaders to the driver, with their exact sums.  A pick changes a sum by 0 to 1, so the
    leaders' own sums decide pick after pick until a row that is not among them might win; only
    then the next pass is made."""
    if prefer not in ("similar", "dissimilar"):
        raise ValueError(f"prefer must be 'similar' or 'dissimilar', got {prefer!r}")
    spark, largest = pool.sparkSession, prefer == "similar"
    rows = pool.select(id_col, F.col("vec").cast("array<double>").alias("vec"))
    kernel = (kind, gamma, coef0, degree)
    # a kernel that is an inner product has cosines of at most 1
    most = 1.0 if kind in ("rbf", "linear") or (kind == "poly" and coef0 >= 0) else math.inf
    picks: list[tuple] = []
    anchors = labeled.select(id_col, "vec")
    if start_random:
        first = random_query(pool, 1, seed, id_col).first()
        if first is None:
            raise ValueError("the pool is empty")
        picks.append((first[id_col], 0))
        anchors = anchors.unionByName(rows.where(F.col(id_col) == first[id_col]))
    tagged = anchors.select(F.lit("all").alias("model_id"), id_col, F.lit(1.0).alias("coef"), "vec")
    totals = kernel_sum(rows, tagged, kind, gamma, coef0, degree, cosine=True, id_col=id_col)
    # an empty labeled set leaves every sum at 0
    scores = materialize(
        rows.join(totals.select(F.col("id").alias(id_col), "total"), id_col, "left").select(
            id_col, "vec", F.coalesce("total", F.lit(0.0)).alias("total")
        ),
        "diversity",
    )
    recent: list[np.ndarray] = []
    ids: list = []
    values = vectors = np.empty(0)
    outside, best = None, -1  # the best a row that is no leader can have now; None: not known
    for step in range(1, k):
        if outside is not None and ids:
            order = sorted(range(len(ids)), key=lambda i: (-shown[i] if largest else shown[i], ids[i]))
            best = order[0]
            sure = shown[best] > outside + 1e-9 if largest else shown[best] < outside - 1e-9
        if outside is None or not ids or not sure:
            if len(recent) >= STEPS_PER_TABLE:
                scores, recent = _with_recent(scores, np.array(recent), kernel, id_col), []
            picked = np.array(recent) if recent else np.empty((0, 0))
            ids, values, vectors = _current_leaders(scores, picked, [p for p, _ in picks], kernel, largest, most, id_col)
            if not ids:
                break
            shown = np.round(values, SCORE_DIGITS)
            best = min(range(len(ids)), key=lambda i: (-shown[i] if largest else shown[i], ids[i]))
            whole = len(ids) < LEADERS  # then there are no other rows
            outside = (-math.inf if largest else math.inf) if whole else (shown.min() if largest else shown.max())
        chosen = vectors[best]
        picks.append((ids[best], step))
        recent.append(chosen)
        ids = ids[:best] + ids[best + 1 :]
        values, vectors = np.delete(values, best), np.delete(vectors, best, axis=0)
        if ids:
            values = values + _kernel_cosines(vectors, chosen[None], kernel)[:, 0]
        shown = np.round(values, SCORE_DIGITS)
        outside += most if largest else 0.0
    return spark.createDataFrame(picks, f"{id_col} {pool.schema[id_col].dataType.simpleString()}, step int")


def _with_recent(scores: DataFrame, recent: np.ndarray, kernel: tuple, id_col: str) -> DataFrame:
    """The stored sums with the recent picks added."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            total = np.asarray(table.column("total")) + _kernel_cosines(dense_matrix(table), recent, kernel).sum(axis=1)
            yield from table.select([id_col, "vec"]).append_column("total", pa.array(total)).to_batches()

    return materialize(scores.select(id_col, "vec", "total").mapInArrow(add, scores.schema), "diversity")


def exclude_labeled(pool: DataFrame, labeled: DataFrame, id_col: str = "id") -> DataFrame:
    return pool.join(labeled.select(id_col), id_col, "left_anti")


def apply_labels(
    pool: DataFrame, labels: DataFrame, allowed: Iterable[int], label_col: str = "classLabel", id_col: str = "id"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move pool rows with a valid delivered label to the labeled set.

    ``labels`` is ``(id, label)``.  Returns (newly labeled rows, remaining pool, rejected
    labels); rejected are labels outside ``allowed``, labels for ids not in the pool, and all
    labels of an id that got different ones.  A label delivered twice counts once."""
    labels = labels.select(id_col, "label").distinct()
    inside = labels.where(F.col("label").isin(list(allowed)))
    per_id = inside.groupBy(id_col).agg(F.count(F.lit(1)).alias("_labels"), F.first("label").alias("label"))
    valid = per_id.where("_labels = 1").select(id_col, "label")
    several = per_id.where("_labels > 1").select(id_col, F.lit(True).alias("_several"))
    labeled = (
        pool.drop(label_col)
        .join(valid.select(id_col, F.col("label").alias(label_col)), id_col)
        .select(*pool.columns)
    )
    rest = pool.join(valid.select(id_col), id_col, "left_anti")
    known = pool.select(id_col, F.lit(True).alias("_known"))
    outside = ~F.coalesce(F.col("label").isin(list(allowed)), F.lit(False))
    bad = labels.join(known, id_col, "left").join(several, id_col, "left").where(
        F.col("_known").isNull() | outside | F.col("_several").isNotNull()
    )
    reason = F.when(F.col("_known").isNull(), "not in the pool").when(outside, "unknown label").otherwise("conflicting labels")
    return labeled, rest, bad.select(id_col, "label", reason.alias("reason"))


def ovr_argmax(scores: DataFrame, id_col: str = "id", class_col="model_id", score_col="decision") -> DataFrame:
    """Class of the largest positive-side score; ties go to the smallest class."""
    label = F.col(class_col).cast("int")
    return scores.groupBy(id_col).agg(F.max_by(label, F.struct(F.col(score_col), -label)).alias("pred"))


def single_class_argmax(scores: DataFrame, id_col: str = "id") -> DataFrame:
    """With one binary model the larger of its two score columns decides."""
    pred = F.when(F.col("score_1") > F.col("score_0"), 1).otherwise(0)
    return scores.select(id_col, pred.alias("pred"))


def tag_labeled(labeled: DataFrame, names, class_col: str = "class", id_col: str = "id") -> DataFrame:
    """Labeled rows of every class learner in one table: positives carry the class name,
    the others their 0."""
    named = name_classes(labeled, names, class_col, "_name")
    tag = F.when(F.col("y") > 0, F.col("_name")).otherwise(F.col("y").cast("string"))
    return named.select(id_col, "origText", class_col, tag.alias("classLabel"))


def final_predictions(
    scores: DataFrame, labeled: DataFrame, pool: DataFrame, names, id_col: str = "id",
    class_col="model_id", score_col="decision", text_col: str = "origText",
) -> DataFrame:
    """``(id, pred, name, text)`` for the pool rows that no learner has labeled."""
    open_rows = exclude_labeled(pool.select(id_col, text_col), labeled, id_col)
    best = ovr_argmax(scores, id_col, class_col, score_col)
    named = name_classes(open_rows.join(best, id_col), names, "pred", "name")
    return named.select(id_col, "pred", "name", text_col)
