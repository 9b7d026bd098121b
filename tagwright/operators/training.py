"""Fitting large-margin classifiers, many at once.

Every (C, gamma, fold, class) combination is one row of a weight matrix.  A pass over the
stored training rows evaluates loss and gradient of all models that are still moving, with
one matrix product per Arrow batch; partial gradients are summed by Spark.  The driver holds
weights only, so its memory depends on the number of models and features, never on rows.

The objective is half the squared weight norm plus C times the hinge loss, the hinge being
rounded on an interval of width ``smooth`` below margin 1.  A model is fitted when its gradient
is at most ``tolerance`` times the first one; a fit that doesn't get there is an error.  An RBF kernel is approximated by
random Fourier features (Rahimi and Recht 2007): decisions approach those of an exact kernel
solver as the number of features grows and are not equal to them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.kernels import default_gamma
from ..sources.scratch import materialize
from .blocks import dense_matrix
from .evaluate import grid_best, grid_metrics, power_list
from .sampling import hash_rank

HISTORY = 8
BATCH_ROWS = 4_096
LEAST_ROWS = 128
MAPPED_ROWS = 1_024  # rows mapped to the features of a kernel at a time
DRIVER_BYTES = 16 << 20


@dataclass(frozen=True)
class MarginParams:
    """``gamma=None`` means one over the number of features.  ``weights`` maps labels (1 and
    0) to loss weights; None leaves both at 1."""

    C: float = 1.0
    gamma: float | None = None
    kernel: str = "rbf"
    weights: dict | None = None
    n_components: int = 1024
    seed: int = 7
    tolerance: float = 1e-3
    max_passes: int = 5_000
    smooth: float = 0.1


@dataclass(frozen=True)
class Spec:
    """One model to fit: its class (None: labels are already 0/1), penalty, kernel width, the
    fold it must not see, or the only one it may see."""

    model_id: str
    C: float
    gamma: float
    positive: int | None = None
    held_out: int | None = None
    only: int | None = None


MODEL_SCHEMA = (
    "number int, model_id string, C double, gamma double, positive int, held_out int, kernel string, n_features int, "
    "n_components int, seed int, coefs array<double>, bias double, loss double, gradient double, passes int"
)


@dataclass(frozen=True)
class MarginModel:
    """Weights per model over the mapped features; the last column is the bias."""

    kernel: str
    specs: tuple[Spec, ...]
    weights: np.ndarray
    n_features: int
    n_components: int
    seed: int
    losses: tuple[float, ...] = field(default=())
    gradients: tuple[float, ...] = field(default=())  # last over first norm
    passes: tuple[int, ...] = field(default=())

    def table(self, spark) -> DataFrame:
        """One row per model with all that is needed to score with it (``from_table``)."""
        rows = []
        for i, s in enumerate(self.specs):
            fitted = [float(x[i]) if len(x) else None for x in (self.losses, self.gradients)]
            rows.append(
                (i, s.model_id, float(s.C), float(s.gamma), s.positive, s.held_out, self.kernel, self.n_features, self.n_components,
                 self.seed, self.weights[i, :-1].tolist(), float(self.weights[i, -1]), *fitted, self.passes[i] if self.passes else None)
            )
        return spark.createDataFrame(rows, MODEL_SCHEMA)

    @staticmethod
    def from_table(table: DataFrame) -> "MarginModel":
        """The model that ``table`` was made from; its size is that of the weights."""
        rows = table.orderBy("number").collect()
        specs = tuple(Spec(r["model_id"], r["C"], r["gamma"], r["positive"], r["held_out"]) for r in rows)
        weights = np.array([[*r["coefs"], r["bias"]] for r in rows])
        one = rows[0]
        kept = [tuple(r[c] for r in rows) if one[c] is not None else () for c in ("loss", "gradient", "passes")]
        return MarginModel(one["kernel"], specs, weights, one["n_features"], one["n_components"], one["seed"], *kept)

    def subset(self, wanted) -> "MarginModel":
        keep = [i for i, s in enumerate(self.specs) if wanted(s)]
        some = {name: tuple(x[i] for i in keep) for name in ("losses", "gradients", "passes") if (x := getattr(self, name))}
        return replace(self, specs=tuple(self.specs[i] for i in keep), weights=self.weights[keep], **some)

    def squared_norms(self) -> dict[str, float]:
        return {s.model_id: float((w[:-1] ** 2).sum()) for s, w in zip(self.specs, self.weights)}


def _mapper(kernel: str, n_features: int, n_components: int, seed: int):
    """Function of (raw rows, gamma) giving mapped rows with a trailing 1 for the bias.

    All widths share one projection; only its scale differs."""
    if kernel == "linear":
        return lambda x, gamma, cache: np.hstack([x, np.ones((len(x), 1))])
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((n_features, n_components))
    phases = rng.uniform(0.0, 2.0 * np.pi, n_components)

    def mapped(x, gamma, cache):
        if "base" not in cache:
            cache["base"] = x @ directions
        z = np.cos(np.sqrt(2.0 * gamma) * cache["base"] + phases) * np.sqrt(2.0 / n_components)
        return np.hstack([z, np.ones((len(x), 1))])

    return mapped


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, at most ``MAPPED_ROWS`` at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, MAPPED_ROWS):
            yield batch.slice(start, MAPPED_ROWS)


def _rounded_hinge(margins: np.ndarray, smooth: float) -> tuple[np.ndarray, np.ndarray]:
    gap = 1.0 - margins
    loss = np.where(gap >= smooth, gap - smooth / 2, np.square(np.maximum(gap, 0.0)) / (2 * smooth))
    return loss, np.clip(gap / smooth, 0.0, 1.0)


def _gradient_pass(
    train: DataFrame, specs: Sequence[Spec], weights: np.ndarray, template: MarginModel,
    label_weights: dict | None, n_parts: int, smooth: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Loss and gradient of the data term for each model, summed over all rows.

    The partial sums of all partitions are added by Spark, or directly on the driver when
    together they are small."""
    # the shape is sent as numbers and the weights as one broadcast matrix
    sent = train.sparkSession.sparkContext.broadcast(weights)
    kernel, width = template.kernel, weights.shape[1]
    n_features, n_components, seed = template.n_features, template.n_components, template.seed
    specs = tuple(specs)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = _mapper(kernel, n_features, n_components, seed)
        w = sent.value
        loss, grad = np.zeros(len(specs)), np.zeros((len(specs), width))
        groups: dict[float, list[int]] = {}
        for i, s in enumerate(specs):
            groups.setdefault(s.gamma, []).append(i)
        seen = False
        for batch in _pieces(batches):
            seen = True
            table = pa.Table.from_batches([batch])
            x, cache = dense_matrix(table), {}
            label = np.asarray(table.column("label"))
            fold = np.asarray(table.column("fold"))
            for gamma, members in groups.items():
                z = mapped(x, gamma, cache)
                values = z @ w[members].T
                y = np.empty_like(values)
                use = np.ones_like(values)
                for j, i in enumerate(members):
                    positive = label > 0 if specs[i].positive is None else label == specs[i].positive
                    y[:, j] = np.where(positive, 1.0, -1.0)
                    if label_weights:
                        use[:, j] = np.where(positive, label_weights.get(1, 1.0), label_weights.get(0, 1.0))
                    if specs[i].held_out is not None:
                        use[fold == specs[i].held_out, j] = 0.0
                    if specs[i].only is not None:
                        use[fold != specs[i].only, j] = 0.0
                terms, slope = _rounded_hinge(values * y, smooth)
                loss[members] += (terms * use).sum(axis=0)
                grad[members] -= (slope * y * use).T @ z
        if seen:
            yield pa.record_batch(
                [
                    pa.array(np.arange(len(specs), dtype=np.int32)),
                    pa.array(loss),
                    pa.FixedSizeListArray.from_arrays(pa.array(grad.ravel()), width).cast(pa.list_(pa.float64())),
                ],
                names=["m", "loss", "grad"],
            )

    def total(group: pa.Table) -> pa.Table:
        grads = np.asarray(group.column("grad").combine_chunks().flatten()).reshape(-1, width)
        return pa.table(
            {
                "m": pa.array([group.column("m")[0].as_py()], pa.int32()),
                "loss": [float(np.asarray(group.column("loss")).sum())],
                "grad": pa.array([grads.sum(axis=0)], pa.list_(pa.float64())),
            }
        )

    schema = "m int, loss double, grad array<double>"
    sums = train.mapInArrow(partial, schema)
    if n_parts * weights.nbytes > DRIVER_BYTES:
        sums = sums.groupBy("m").applyInArrow(total, schema)
    rows = sums.toArrow()
    sent.unpersist()
    loss, grad = np.zeros(len(specs)), np.zeros((len(specs), width))
    which = np.asarray(rows.column("m"))
    np.add.at(loss, which, np.asarray(rows.column("loss")))
    np.add.at(grad, which, dense_matrix(rows, "grad").reshape(-1, width))
    return loss, grad


class _Descent:
    """Limited-memory BFGS for many independent models that share their data passes.

    A model whose trial point is not good enough halves its own step while the others go on."""

    def __init__(self, start: np.ndarray, tolerance: float):
        self.w, self.tolerance = start, tolerance
        n = len(start)
        self.step, self.direction = np.ones(n), np.zeros_like(start)
        self.value, self.grad = np.full(n, np.inf), np.zeros_like(start)
        self.pairs: list[list] = [[] for _ in range(n)]
        self.moving = np.ones(n, dtype=bool)
        self.first_norm, self.norm = np.ones(n), np.full(n, np.inf)
        self.passes = np.zeros(n, dtype=int)

    def trial(self) -> np.ndarray:
        return self.w + self.step[:, None] * self.direction

    def _next_direction(self, i: int) -> np.ndarray:
        q, alphas = self.grad[i].copy(), []
        for s, y, rho in reversed(self.pairs[i]):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * y
        if self.pairs[i]:
            s, y, _ = self.pairs[i][-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(np.linalg.norm(q), 1.0)
        for (s, y, rho), a in zip(self.pairs[i], reversed(alphas)):
            q += s * (a - rho * (y @ q))
        return -q

    def accept(self, members: np.ndarray, trial: np.ndarray, value: np.ndarray, grad: np.ndarray) -> None:
        self.passes[members] += 1
        for row, i in enumerate(members):
            slope = self.grad[i] @ self.direction[i]
            first = np.isinf(self.value[i])
            if not first and value[row] > self.value[i] + 1e-4 * self.step[i] * slope:
                self.step[i] /= 2
                if self.step[i] < 1e-6:  # forget the curvature and go down the gradient, once
                    self.moving[i] = bool(self.pairs[i])
                    self.pairs[i] = []
                    self.step[i], self.direction[i] = 1.0, self._next_direction(i)
                continue
            if not first:
                s, y = trial[row] - self.w[i], grad[row] - self.grad[i]
                if s @ y > 1e-12 * (y @ y):
                    self.pairs[i] = (self.pairs[i] + [(s, y, 1.0 / (s @ y))])[-HISTORY:]
            self.w[i], self.value[i], self.grad[i] = trial[row], value[row], grad[row]
            norm = np.linalg.norm(grad[row])
            if first:
                self.first_norm[i] = max(norm, 1e-12)
            self.norm[i] = norm
            if norm <= self.tolerance * self.first_norm[i]:
                self.moving[i] = False
                continue
            self.step[i], self.direction[i] = 1.0, self._next_direction(i)


def training_table(
    vectors: DataFrame, labels: DataFrame, label_col: str = "classLabel", id_col: str = "id",
    folds: int | None = None, seed: int = 7,
) -> DataFrame:
    """Stored ``(id, vec, label, fold)`` rows, evenly spread in moderate partitions.

    Folds are exact and stratified: the random rank within a class modulo the fold count."""
    known = labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    if folds:
        known = hash_rank(known, "label", seed, "id", "rank").withColumn(
            "fold", ((F.col("rank") - 1) % folds).cast("int")
        )
    else:
        known = known.withColumn("fold", F.lit(-1))
    rows = vectors.select(F.col(id_col).alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    return materialize(rows.join(known, "id").select("id", "vec", "label", "fold"), "train")


def fit_specs(
    train: DataFrame, specs: Sequence[Spec], params: MarginParams, start: MarginModel | None = None
) -> MarginModel:
    """Fit all ``specs`` on one stored training table."""
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not stats["n"]:
        raise ValueError("no labeled data has been provided")
    width = (stats["d"] if params.kernel == "linear" else params.n_components) + 1
    model = MarginModel(
        params.kernel, tuple(specs), np.zeros((len(specs), width)), stats["d"], params.n_components, params.seed
    )
    if start is not None:
        model = replace(model, weights=start.weights.copy())
    # tasks of bounded size, and work for every core while there are few rows
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-stats["n"] // BATCH_ROWS), min(cores, -(-stats["n"] // LEAST_ROWS)), 1)
    rows = train.repartition(parts, "id").persist()
    penalty = np.array([s.C for s in specs])
    descent = _Descent(model.weights, params.tolerance)
    for _ in range(params.max_passes):
        members = np.flatnonzero(descent.moving)
        if not len(members):
            break
        trial = descent.trial()[members]
        loss, grad = _gradient_pass(rows, [specs[i] for i in members], trial, model, params.weights, parts, params.smooth)
        free = trial.copy()
        free[:, -1] = 0.0
        value = 0.5 * (free**2).sum(axis=1) + penalty[members] * loss
        grad = free + penalty[members][:, None] * grad
        descent.accept(members, trial, value, grad)
    rows.unpersist()
    relative = descent.norm / descent.first_norm
    late = np.flatnonzero(relative > params.tolerance)
    if len(late):
        raise RuntimeError(
            f"{len(late)} of {len(specs)} models not fitted after {int(descent.passes.max())} passes: relative gradient up to {relative.max():.2g}"
        )
    return replace(
        model, weights=descent.w, losses=tuple(descent.value.tolist()), gradients=tuple(relative.tolist()),
        passes=tuple(descent.passes.tolist()),
    )


def resolve(params: MarginParams, n_features: int) -> MarginParams:
    return replace(params, gamma=params.gamma or default_gamma(n_features))


def fit_margin(
    vectors: DataFrame, labels: DataFrame, params: MarginParams = MarginParams(),
    label_col: str = "classLabel", id_col: str = "id", classes: Sequence[int] | None = None,
) -> MarginModel:
    """One binary model for 0/1 labels, or one model per class when ``classes`` is given."""
    train = training_table(vectors, labels, label_col, id_col)
    n_features = train.select(F.max(F.size("vec"))).first()[0] or 1
    params = resolve(params, n_features)
    targets = [None] if classes is None else list(classes)
    specs = [Spec("model" if t is None else str(t), params.C, params.gamma, t) for t in targets]
    return fit_specs(train, specs, params)


def margin_decisions(vectors: DataFrame, model: MarginModel, id_col: str = "id") -> DataFrame:
    """``(id, model_id, decision)``: a narrow pass over the rows to score."""
    sent = vectors.sparkSession.sparkContext.broadcast(model.weights)
    kernel, specs = model.kernel, model.specs
    shape = (model.n_features, model.n_components, model.seed)
    id_type = vectors.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = _mapper(kernel, *shape)
        for batch in _pieces(batches):
            table = pa.Table.from_batches([batch])
            x, cache = dense_matrix(table), {}
            for i, s in enumerate(specs):
                values = mapped(x, s.gamma, cache) @ sent.value[i]
                yield pa.record_batch(
                    [batch.column(0), pa.array([s.model_id] * len(x), pa.string()), pa.array(values)],
                    names=[id_col, "model_id", "decision"],
                )

    rows = vectors.select(id_col, F.col("vec").cast("array<double>").alias("vec"))
    return rows.mapInArrow(score, f"{id_col} {id_type}, model_id string, decision double")


def held_out_decisions(train: DataFrame, model: MarginModel) -> DataFrame:
    """``(id, label, C, gamma, decision)``: each training row scored only by the models whose
    held-out fold it is in."""
    sent = train.sparkSession.sparkContext.broadcast(model.weights)
    kernel, specs = model.kernel, model.specs
    shape = (model.n_features, model.n_components, model.seed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = _mapper(kernel, *shape)
        for batch in _pieces(batches):
            table = pa.Table.from_batches([batch])
            x, cache = dense_matrix(table), {}
            fold = np.asarray(table.column("fold"))
            for i, s in enumerate(specs):
                own = np.flatnonzero(fold == s.held_out)
                if not len(own):
                    continue
                values = (mapped(x, s.gamma, cache) @ sent.value[i])[own]
                picked = table.take(pa.array(own))
                yield pa.record_batch(
                    [
                        picked.column("id").combine_chunks(), picked.column("label").combine_chunks(),
                        pa.array(np.full(len(own), s.C)), pa.array(np.full(len(own), s.gamma)), pa.array(values),
                    ],
                    names=["id", "label", "C", "gamma", "decision"],
                )

    id_type = train.schema["id"].dataType.simpleString()
    return train.mapInArrow(score, f"id {id_type}, label int, C double, gamma double, decision double")


def cv_decisions(
    vectors: DataFrame, labels: DataFrame, points: Sequence[tuple[float, float]], folds: int = 5,
    params: MarginParams = MarginParams(), label_col: str = "classLabel", id_col: str = "id",
) -> DataFrame:
    """Pooled held-out decisions for every (C, gamma) point; all fits run together."""
    train = training_table(vectors, labels, label_col, id_col, folds, params.seed)
    specs = [
        Spec(f"{c}|{g}|{f}", c, g, None, f) for c, g in points for f in range(folds)
    ]
    model = fit_specs(train, specs, params)
    return held_out_decisions(train, model).withColumnRenamed("id", id_col)


def cv_predictions(vectors, labels, points, folds=5, params=MarginParams(), label_col="classLabel", id_col="id"):
    decisions = cv_decisions(vectors, labels, points, folds, params, label_col, id_col)
    return decisions.select(
        id_col, F.col("label").alias(label_col), "C", "gamma",
        F.when(F.col("decision") > 0, 1).otherwise(0).alias("pred"),
    )


def grid_search(
    vectors: DataFrame, labels: DataFrame, folds: int = 5, c_range=(-4, 10, 2), g_range=(-10, 3, 2),
    beta: float = 10.0, sens_only: bool = False, linear: bool = False,
    params: MarginParams = MarginParams(), label_col: str = "classLabel", id_col: str = "id",
) -> MarginParams:
    """``params`` with the kernel searched and its best C and gamma by cross-validation; a
    linear kernel searches C only."""
    gammas = [1.0] if linear else power_list(*g_range)
    points = [(c, g) for c in power_list(*c_range) for g in gammas]
    used = replace(params, kernel="linear") if linear else params
    predicted = cv_predictions(vectors, labels, points, folds, used, label_col, id_col)
    best = grid_best(grid_metrics(predicted, beta, sens_only, label_col=label_col)).first()
    return replace(used, C=best["C"], gamma=best["gamma"])


def calibrate(
    scores: DataFrame, labels: DataFrame, label_col: str = "classLabel", id_col: str = "id"
):
    """A sigmoid from decision values to the probability of class 1 (Platt 1999), fitted on
    held-out decisions.  Returns the fitted transformer."""
    joined = scores.join(labels.select(id_col, F.col(label_col).cast("double").alias("label")), id_col)
    rows = joined.where(F.col("label").isNotNull()).select(
        array_to_vector(F.array("decision")).alias("features"), "label"
    )
    return LogisticRegression(maxIter=50, regParam=0.0).fit(materialize(rows, "calibration"))


def probabilities(scores: DataFrame, calibration) -> DataFrame:
    """Add ``p_0`` and ``p_1``; a model that was not calibrated is an error."""
    if calibration is None:
        raise TypeError("the model does not support probability estimates")
    rows = scores.withColumn("features", array_to_vector(F.array("decision")))
    scored = calibration.transform(rows).withColumn("p", vector_to_array("probability"))
    return scored.select(*scores.columns, F.col("p")[0].alias("p_0"), F.col("p")[1].alias("p_1"))
