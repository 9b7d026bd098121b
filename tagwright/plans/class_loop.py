"""The labeling loop of all classes together: one binary learner per class over one pool.

Every round is the same few passes however many classes there are: one pass over the pool measures
the distance of each row to each hyperplane and keeps the nearest per class, one pass over the labeled
rows refits all learners.  The labeled rows are one table keyed by learner.  A row that all learners
start from is stored once, with no learner named; a row asked for by one learner is that learner's.
Labeled rows carry their vectors, so no round reads the vectors of the pool for them again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.order import hash_key
from ..operators import training as tr
from ..operators.blocks import dense_matrix
from ..operators.evaluate import multiclass_accuracy
from ..operators.lookup import fits_broadcast
from ..operators.queries import final_predictions, ovr_argmax
from ..operators.sampling import hash_rank
from ..operators.topk import kept_rows, merge_best
from ..sources.learners import load_learner, save_learner
from ..sources.scratch import materialize

DIGITS = 10  # distances are compared to so many decimals, equal ones by id


@dataclass(frozen=True)
class ClassLoop:
    """``pool`` is ``(id, vec)`` without the rows all learners started from; ``labeled`` is
    ``(model_id, id, label, round, vec)``, model_id null for those rows.  ``balanced`` fits on
    labeled rows cut to the smaller side per learner."""

    classes: tuple[int, ...]
    pool: DataFrame
    labeled: DataFrame
    model: tr.MarginModel | None = None
    round: int = 0
    balanced: bool = True
    seed: int = 7


Fitter = Callable[[ClassLoop, DataFrame], tr.MarginModel]


def start(vectors: DataFrame, labels: DataFrame, classes, balanced: bool = True, seed: int = 7) -> ClassLoop:
    """A loop over ``vectors`` ``(id, vec)``; the rows of ``labels`` ``(id, classLabel)`` are what every
    learner starts from, all others are the pool."""
    rows = vectors.select("id", F.col("vec").cast("array<double>").alias("vec"))
    known = materialize(labels.where("classLabel is not null").select("id", F.col("classLabel").cast("int").alias("label")), "class-start")
    side = F.broadcast(known) if fits_broadcast(known.count(), 32) else known
    labeled = rows.join(side, "id").select(
        F.lit(None).cast("string").alias("model_id"), "id", "label", F.lit(0).alias("round"), "vec"
    )
    pool = rows.join(side.select("id"), "id", "left_anti")
    return ClassLoop(tuple(classes), materialize(pool, "class-pool"), materialize(labeled, "class-labeled"), balanced=balanced, seed=seed)


def class_members(state: ClassLoop) -> DataFrame:
    """``(id, label, vec, learners)``: the learners, by place in ``classes``, whose fit a labeled row takes
    part in; a balanced fit keeps the first of the larger side in seeded hash order."""
    numbers = F.array(*[F.lit(i) for i in range(len(state.classes))])
    names = F.array(*[F.lit(str(c)) for c in state.classes])
    own = F.array(F.array_position(names, F.col("model_id")).cast("int") - 1)
    rows = state.labeled.withColumn("learners", F.when(F.col("model_id").isNull(), numbers).otherwise(own))
    if not state.balanced:
        return rows.select("id", "label", "vec", "learners")
    listed = F.array(*[F.lit(c) for c in state.classes])
    seed = state.seed + state.round
    sides = rows.select("id", "label", F.explode("learners").alias("m")).select(
        "id", F.concat_ws(":", "m", (F.col("label") == F.get(listed, F.col("m"))).cast("int")).alias("side")
    )
    sizes = {r["side"]: r["count"] for r in sides.groupBy("side").count().collect()}  # two a learner
    cuts = {}
    for m in range(len(state.classes)):
        less, more = sorted((f"{m}:{y}" for y in (0, 1)), key=lambda s: sizes.get(s, 0))
        if 0 < sizes.get(less, 0) < sizes.get(more, 0):
            cuts[more] = sizes[less]
    if not cuts:
        return rows.select("id", "label", "vec", "learners")
    ranked = hash_rank(sides.where(F.col("side").isin(list(cuts))), "side", seed)
    last = F.element_at(F.create_map(*[F.lit(x) for kv in cuts.items() for x in kv]), F.col("side"))
    ends = ranked.where(F.col("rank") == last).select("side", hash_key(seed, "id").alias("h"), "id").collect()  # one a learner
    at = {int(r["side"].split(":")[0]): r for r in ends}
    id_type = rows.schema["id"].dataType
    cut = F.array(
        *[
            F.struct(F.lit(r["side"].endswith(":1")).alias("y"), F.lit(r["h"]).alias("h"), F.lit(r["id"]).cast(id_type).alias("id"))
            if (r := at.get(m)) else F.lit(None).cast(f"struct<y:boolean,h:string,id:{id_type.simpleString()}>")
            for m in range(len(state.classes))
        ]
    )
    rows = rows.withColumn("_h", hash_key(seed, "id")).withColumn("_cut", cut)

    def stays(m):
        c = F.get("_cut", m)
        late = (F.col("_h") > c["h"]) | ((F.col("_h") == c["h"]) & (F.col("id") > c["id"]))
        return c.isNull() | ~(((F.col("label") == F.get(listed, m)) == c["y"]) & late)

    kept = F.filter("learners", stays)
    return rows.select("id", "label", "vec", kept.alias("learners")).where(F.size("learners") > 0)


def fit_means(state: ClassLoop, members: DataFrame) -> tr.MarginModel:
    """The hyperplane halfway between the mean of a learner's positive rows and that of its others; all
    zeros where a side has no rows."""
    n_models, classes = len(state.classes), np.array(state.classes)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            x = dense_matrix(table)
            lists = table.column("learners").combine_chunks()
            row = np.repeat(np.arange(len(x)), np.diff(np.asarray(lists.offsets)))
            m = np.asarray(lists.flatten())
            positive = np.asarray(table.column("label"))[row] == classes[m]
            if sums is None:
                sums = np.zeros((n_models * 2, x.shape[1] + 1))
            for side in range(2 * n_models):
                at = row[(m == side // 2) & (positive == bool(side % 2))]
                sums[side, :-1] += x[at].sum(axis=0)
                sums[side, -1] += len(at)
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.reshape(-1)), pa.array(np.full(sums.size, sums.shape[1]))], names=["cell", "x", "width"])

    cells = members.mapInArrow(partial, "cell long, x double, width long").groupBy("cell", "width").agg(F.sum("x").alias("x")).collect()
    if not cells:
        raise ValueError("no labeled data has been provided")
    width = cells[0]["width"]  # sides times dimensions, no rows
    flat = np.zeros(2 * n_models * width)
    for r in cells:
        flat[r["cell"]] = r["x"]
    sums = flat.reshape(n_models, 2, width)
    counts = sums[:, :, -1]
    both = (counts > 0).all(axis=1)
    means = sums[:, :, :-1] / np.maximum(counts, 1)[:, :, None]
    weights = np.zeros((n_models, width))
    weights[:, :-1] = means[:, 1] - means[:, 0]
    weights[:, -1] = ((means[:, 0] ** 2).sum(axis=1) - (means[:, 1] ** 2).sum(axis=1)) / 2
    weights[~both] = 0.0
    specs = tuple(tr.Spec(str(c), 1.0, 1.0, c) for c in state.classes)
    return tr.MarginModel("linear", specs, weights, width - 1, 0, state.seed)


def margin_fitter(params: tr.MarginParams) -> Fitter:
    """Large-margin learners, all fitted in the same passes over the labeled rows."""

    def fit(state: ClassLoop, members: DataFrame) -> tr.MarginModel:
        train = members.select("id", "vec", "label", F.explode("learners").alias("fold"))
        train = materialize(train, "class-train")
        n_features = train.select(F.max(F.size("vec"))).first()[0] or 1
        known = tr.resolve(params, n_features)
        specs = [tr.Spec(str(c), known.C, known.gamma, c, only=i) for i, c in enumerate(state.classes)]
        return tr.fit_specs(train, specs, known)

    return fit


def refit(state: ClassLoop, fitter: Fitter = fit_means) -> ClassLoop:
    return replace(state, model=fitter(state, class_members(state)))


def ask(state: ClassLoop, k: int) -> DataFrame:
    """``(model_id, id, distance, vec)``: for every learner the k pool rows nearest its hyperplane that
    it has no label for, in one pass over the pool and without sorting it."""
    if state.model is None:
        raise ValueError("no models have been initialized")
    rows = state.pool
    taken = state.labeled.where(F.col("model_id").isNotNull()).groupBy("id").agg(F.collect_set("model_id").alias("taken"))
    taken = materialize(taken, "class-taken")
    n_taken = taken.count()
    if n_taken:
        side = F.broadcast(taken) if fits_broadcast(n_taken, 64 + 16 * len(state.classes)) else taken
        rows = rows.join(side, "id", "left")
    else:
        rows = rows.withColumn("taken", F.lit(None).cast("array<string>"))
    rows = rows.withColumn("_task", F.spark_partition_id())
    id_type = state.pool.schema["id"].dataType.simpleString()
    model, squares = state.model, state.model.squared_norms()
    sent = rows.sparkSession.sparkContext.broadcast(model.weights)
    kernel, specs, shape = model.kernel, model.specs, (model.n_features, model.n_components, model.seed)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = tr._mapper(kernel, *shape)

        def tables():
            for batch in batches:
                table = pa.Table.from_batches([batch])
                x, cache = dense_matrix(table), {}
                lists = table.column("taken").to_pylist()
                for i, s in enumerate(specs):
                    open_rows = np.array([not t or s.model_id not in t for t in lists])
                    w2 = squares[s.model_id]
                    values = np.abs(mapped(x, s.gamma, cache) @ sent.value[i])
                    distance = np.round(values / w2, DIGITS) if w2 else np.zeros(len(x))
                    some = table.select(["id", "vec", "_task"]).append_column("distance", pa.array(distance))
                    some = some.append_column("model_id", pa.array([s.model_id] * len(x), pa.string())).filter(pa.array(open_rows))
                    yield some.select(["model_id", "id", "distance", "vec", "_task"])

        kept = kept_rows(tables(), "model_id", ["distance", "id"], k)
        if kept is not None:
            yield from kept.to_batches()

    schema = f"model_id string, id {id_type}, distance double, vec array<double>, _task int"
    return merge_best(rows.mapInArrow(nearest, schema), "model_id", ["distance", "id"], k)


def tell(state: ClassLoop, asked: DataFrame, feed: DataFrame) -> ClassLoop:
    """The state with the answers of ``feed`` ``(id, label)`` to what was asked; a row without an answer,
    or with different ones, stays in the pool."""
    asked = materialize(asked.select("model_id", "id", "vec"), "class-asked")
    wanted = asked.select("id").distinct()
    told = feed.where(F.col("label").isNotNull()).join(F.broadcast(wanted), "id", "left_semi") if fits_broadcast(
        asked.count(), 32
    ) else feed.where(F.col("label").isNotNull()).join(wanted, "id", "left_semi")
    one = told.groupBy("id").agg(F.min("label").cast("int").alias("label"), F.max("label").alias("_other")).where("label = _other")
    number = state.round + 1
    new = asked.join(one.drop("_other"), "id").select("model_id", "id", "label", F.lit(number).alias("round"), "vec")
    labeled = materialize(state.labeled.unionByName(new), "class-labeled")
    return replace(state, labeled=labeled, round=number)


def learn(state: ClassLoop, feed: DataFrame, rounds: int, k: int, fitter: Fitter = fit_means) -> ClassLoop:
    """``rounds`` times: ask k rows for each learner, take their labels, refit all."""
    if state.model is None:
        state = refit(state, fitter)
    for _ in range(rounds):
        state = refit(tell(state, ask(state, k), feed), fitter)
    return state


def class_scores(state: ClassLoop, vectors: DataFrame) -> DataFrame:
    """``(id, model_id, decision)`` of rows to evaluate."""
    return tr.margin_decisions(vectors, state.model)


def accuracy(state: ClassLoop, vectors: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of right classes by the largest score over test rows ``(id, classLabel)``."""
    predicted = ovr_argmax(class_scores(state, vectors))
    return multiclass_accuracy(truth.select("id", "classLabel").join(predicted, "id"))


def predict_rest(state: ClassLoop, texts: DataFrame, names) -> DataFrame:
    """Classes of the pool rows that no learner has a label for: ``(id, pred, name, origText)``."""
    return final_predictions(class_scores(state, state.pool), state.labeled.select("id").distinct(), texts, names)


def save(state: ClassLoop, path: str, name: str = "classes") -> None:
    """A new version of the whole loop but its pool, which is read from its source again."""
    model = state.model.table(state.pool.sparkSession)
    save_learner(
        path, name, state.labeled, model, {}, False, round=state.round, classes=list(state.classes), balanced=state.balanced, seed=state.seed
    )


def resume(vectors: DataFrame, path: str, name: str = "classes") -> ClassLoop | None:
    """The loop as it was saved last, over the same vectors; None if there is none."""
    spark = vectors.sparkSession
    saved = load_learner(spark, path, name)
    if saved is None:
        return None
    labeled = saved["labeled"]
    first = labeled.where(F.col("model_id").isNull()).select("id")
    rows = vectors.select("id", F.col("vec").cast("array<double>").alias("vec"))
    pool = materialize(rows.join(first, "id", "left_anti"), "class-pool")
    return ClassLoop(
        tuple(saved["classes"]), pool, labeled, tr.MarginModel.from_table(saved["model"]), saved["round"], saved["balanced"], saved["seed"]
    )
