"""Fitting large-margin models over sparse rows, such as weighted terms, many models at once.

Training rows are stored once as chunks of entries sorted by feature shard.  Weights, gradients
and the history of the descent are tables with one row per shard of features, so a vocabulary of any
size has no dense vector on the driver.  A pass computes decisions, losses and the partial
gradients of all models that still move; gradients are added per shard.  While all weights fit a
broadcast a task does the whole pass over its chunks; beyond that each piece of a chunk meets the
weights of its own shard, decisions are added per chunk and go back to the pieces.  The driver holds
weights and history up to ``HELD_BYTES``; beyond that they are tables, each of which goes when the next
one is written.

Every vector of the descent is a combination of training rows.  While there are several chunks for a
core and few enough rows, the driver holds the combinations and their decisions in place of weights:
a pass goes over shards of features and brings the decisions of the new gradient, so that nothing as
long as the vocabulary is moved or stored again.

The descent is limited-memory BFGS in which the driver only sees inner products: a direction is a
combination of stored vectors, and its coefficients follow from their products (Chen, Wang and Zhou
2014).  Objective, rounded hinge and tolerance are those of ``training``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.scratch import discard, materialize, shuffles_freed
from .lookup import BROADCAST_BYTES, fits_broadcast, key_frequency, lookup_join
from .margin import BIAS
from .training import DRIVER_BYTES, _rounded_hinge

SHARD_FEATURES = 8_192
CHUNK_ENTRIES = 1 << 16
HISTORY = 5
STORED = 2 * HISTORY + 1  # steps, gradient changes, gradient
HELD_BYTES = 256 << 20  # of weights and history on the driver
STATE = "shard int, n int, bias int, w binary, basis binary, dots array<double>"
LOSS = -1  # in place of a shard number
PIECES = "array<struct<shard:int,rows:binary,cols:binary,vals:binary>>"
SUMS = "shard int, cols binary, vals binary"


@dataclass(frozen=True)
class SparseSpec:
    """One model: labels equal to ``positive`` (None: above 0) against all others, with penalty ``C``.
    ``weights`` of labels 1 and 0 scale the loss, as in ``MarginParams``."""

    model_id: str
    C: float = 1.0
    positive: int | None = None
    weights: tuple[float, float] = (1.0, 1.0)


@dataclass(frozen=True)
class SparseRows:
    """``chunks``: chunk, n, labels, pieces.  ``vocabulary``: feature, shard, idx; the bias is a feature
    that every row has."""

    chunks: DataFrame
    vocabulary: DataFrame
    n_rows: int
    n_features: int
    n_shards: int
    n_chunks: int


@dataclass(frozen=True)
class SparseFit:
    """``weights`` is a linear model table ``(model_id, feature, weight)`` as ``margin`` scores it;
    ``report`` has a row per model: model_id, C, loss, gradient (last over first norm), passes."""

    weights: DataFrame
    report: DataFrame


def sparse_training_rows(
    features: DataFrame, labels: DataFrame, label_col: str = "classLabel", id_col: str = "id",
    chunk_entries: int = CHUNK_ENTRIES, shard_features: int = SHARD_FEATURES,
) -> SparseRows:
    """Stored training rows from ``(id, feature, value)`` and labels; a labeled row without features
    counts as one of zeros, and a row without a label takes no part."""
    with shuffles_freed(features.sparkSession):
        return _training_rows(features, labels, label_col, id_col, chunk_entries, shard_features)


def _training_rows(
    features: DataFrame, labels: DataFrame, label_col: str, id_col: str, chunk_entries: int, shard_features: int
) -> SparseRows:
    known = labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    known = materialize(known, "sparse-labels")
    n_rows = known.count()
    if not n_rows:
        discard(known)
        raise ValueError("no labeled data has been provided")
    narrow = fits_broadcast(n_rows, 48)
    side = F.broadcast(known) if narrow else known
    own = features.select(F.col(id_col).alias("id"), F.col("feature").cast("string").alias("feature"), F.col("value").cast("double"))
    entries = own.join(side, "id").select("id", "label", "feature", "value")
    bias = known.select("id", "label", F.lit(BIAS).alias("feature"), F.lit(1.0).alias("value"))
    entries = entries.unionByName(bias)
    entries = entries if narrow else materialize(entries, "sparse-entries")
    frequency = key_frequency(entries, "feature")
    size = frequency.agg(F.count(F.lit(1)).alias("features"), F.sum("n_rows").alias("entries")).first()
    n_shards = -(-size.features // shard_features)
    shard = F.pmod(F.xxhash64("feature"), F.lit(n_shards)).cast("int")
    place = F.row_number().over(Window.partitionBy("shard").orderBy("feature")) - 1
    vocabulary = frequency.select("feature", shard.alias("shard")).withColumn("idx", place)
    vocabulary = materialize(vocabulary, "sparse-vocabulary")
    placed = lookup_join(entries, vocabulary, "feature", "id", row_bytes=96, frequency=frequency, n_rows=size.features)
    placed = placed.select("id", "label", "shard", "idx", "value")
    if not fits_broadcast(size.features, 96):  # its exchange goes before the one by chunk
        placed = materialize(placed, "sparse-placed")
    n_chunks = -(-size.entries // chunk_entries)

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").combine_chunks().dictionary_encode()
        row = np.asarray(ids.indices).astype(np.int32)
        n = len(ids.dictionary)
        label = np.zeros(n, np.int32)
        label[row] = np.asarray(table.column("label"))
        shard, col = np.asarray(table.column("shard")), np.asarray(table.column("idx"))
        order = np.lexsort((row, col, shard))
        row, col, shard, value = row[order], col[order].astype(np.int32), shard[order], np.asarray(table.column("value"))[order]
        ends = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard))
        pieces = [
            {"shard": int(shard[a]), "rows": row[a:b].tobytes(), "cols": col[a:b].tobytes(), "vals": value[a:b].tobytes()}
            for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)
        ]
        kind = pa.list_(pa.struct([("shard", pa.int32()), ("rows", pa.binary()), ("cols", pa.binary()), ("vals", pa.binary())]))
        return pa.table(
            {"chunk": table.column("chunk").slice(0, 1), "n": pa.array([n], pa.int32()), "labels": [label.tobytes()], "pieces": pa.array([pieces], kind)}
        )

    chunk = F.pmod(F.xxhash64("id"), F.lit(n_chunks))
    chunks = (
        placed.select(chunk.alias("chunk"), "id", "label", "shard", "idx", "value")
        .groupBy("chunk").applyInArrow(pack, f"chunk long, n int, labels binary, pieces {PIECES}")
    )
    chunks = materialize(chunks, "sparse-chunks")
    discard(known, entries, frequency, placed)
    return SparseRows(chunks, vocabulary, n_rows, size.features, n_shards, n_chunks)


# ---- one pass over the rows


def _slopes(decisions: np.ndarray, labels: np.ndarray, specs, smooth: float) -> tuple[np.ndarray, np.ndarray]:
    """(loss per model, derivative by decision) of a chunk."""
    y = np.empty_like(decisions)
    use = np.empty_like(decisions)
    for j, s in enumerate(specs):
        positive = labels > 0 if s.positive is None else labels == s.positive
        y[:, j] = np.where(positive, 1.0, -1.0)
        use[:, j] = np.where(positive, *s.weights)
    terms, slope = _rounded_hinge(decisions * y, smooth)
    return (terms * use).sum(axis=0), -slope * y * use


def _arrays(piece: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(piece["rows"], np.int32), np.frombuffer(piece["cols"], np.int32), np.frombuffer(piece["vals"])


def _add_decisions(total: np.ndarray, piece: dict, w: np.ndarray) -> None:
    rows, cols, vals = _arrays(piece)
    for m in range(total.shape[1]):
        total[:, m] += np.bincount(rows, vals * w[cols, m], len(total))


def _piece_gradient(piece: dict, slopes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of the piece, their gradients)."""
    rows, cols, vals = _arrays(piece)
    first = np.flatnonzero(np.append(True, np.diff(cols) != 0))
    return cols[first], np.add.reduceat(vals[:, None] * slopes[rows], first, axis=0)


def _sum_row(shard: int, cols: np.ndarray, vals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([cols.astype(np.int32).tobytes()], pa.binary()), pa.array([vals.tobytes()], pa.binary())],
        names=["shard", "cols", "vals"],
    )


def _added(sums: DataFrame, n_models: int) -> DataFrame:
    """``(shard, grad)``: partial gradients added per shard, one after another."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shard = np.zeros((0, n_models)), None
        for batch in batches:
            for r in batch.to_pylist():
                cols, vals = np.frombuffer(r["cols"], np.int32), np.frombuffer(r["vals"]).reshape(-1, n_models)
                shard = r["shard"]
                if len(cols) and cols[-1] >= len(total):
                    total = np.vstack([total, np.zeros((cols[-1] + 1 - len(total), n_models))])
                total[cols] += vals
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["shard", "grad"])

    return sums.groupBy("shard").applyInArrow(add, "shard int, grad binary")


def _gathered(sums: DataFrame, n_models: int, few: bool) -> dict[int, bytes]:
    """Partial gradients added per shard on the driver; ``few``: those of all tasks are small together."""
    if not few:
        return {r["shard"]: r["grad"] for r in _added(sums, n_models).toArrow().to_pylist()}
    total: dict[int, np.ndarray] = {}
    for r in sums.toArrow().to_pylist():
        cols, own = np.frombuffer(r["cols"], np.int32), total.get(r["shard"], np.zeros((0, n_models)))
        if len(cols) and cols[-1] >= len(own):
            own = np.vstack([own, np.zeros((cols[-1] + 1 - len(own), n_models))])
        own[cols] += np.frombuffer(r["vals"]).reshape(-1, n_models)
        total[r["shard"]] = own
    return {shard: own.tobytes() for shard, own in total.items()}


def _whole_pass(chunks: DataFrame, sent: Broadcast, specs, smooth: float) -> DataFrame:
    """Partial sums when every task can hold all weights, sent by shard."""
    specs = tuple(specs)

    def partial(batches):
        w, k = sent.value, len(specs)
        grads: dict[int, np.ndarray] = {}
        touched: dict[int, np.ndarray] = {}
        loss = np.zeros(k)
        for batch in batches:
            for i in range(batch.num_rows):
                c = batch.slice(i, 1).to_pylist()[0]
                decisions = np.zeros((c["n"], k))
                for piece in c["pieces"]:
                    _add_decisions(decisions, piece, w[piece["shard"]])
                part, slopes = _slopes(decisions, np.frombuffer(c["labels"], np.int32), specs, smooth)
                loss += part
                for piece in c["pieces"]:
                    cols, vals = _piece_gradient(piece, slopes)
                    shard = piece["shard"]
                    if shard not in grads:
                        grads[shard], touched[shard] = np.zeros_like(w[shard]), np.zeros(len(w[shard]), bool)
                    grads[shard][cols] += vals
                    touched[shard][cols] = True
        for shard, total in grads.items():
            cols = np.flatnonzero(touched[shard])
            yield _sum_row(shard, cols, total[cols])
        yield _sum_row(LOSS, np.zeros(1), loss)

    return chunks.mapInArrow(partial, SUMS)


def _sharded_pass(chunks: DataFrame, weights: DataFrame, n_shards: int, specs, smooth: float, limit: int, shard_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(partial sums, the table they are worked out from) when only a shard's weights are sure to fit a task."""
    k, specs = len(specs), tuple(specs)
    pieces = chunks.select("chunk", "n", F.explode("pieces").alias("p")).select("chunk", "n", "p.*")
    joined = lookup_join(pieces, weights.select("shard", "t"), "shard", "chunk", shard_bytes, n_rows=n_shards, broadcast_limit=limit)

    def forward(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                p = batch.slice(i, 1).to_pylist()[0]
                decisions = np.zeros((p["n"], k))
                _add_decisions(decisions, p, np.frombuffer(p["t"]).reshape(-1, k))
                yield pa.RecordBatch.from_arrays([pa.array([p["chunk"]]), pa.array([decisions.tobytes()], pa.binary())], names=["chunk", "part"])

    def judge(parts: pa.Table, head: pa.Table) -> pa.Table:
        labels = np.frombuffer(head.column("labels")[0].as_py(), np.int32)
        decisions = np.zeros((len(labels), k))
        for part in parts.column("part"):
            decisions += np.frombuffer(part.as_py()).reshape(-1, k)
        loss, slopes = _slopes(decisions, labels, specs, smooth)
        return pa.table({"chunk": head.column("chunk"), "slopes": [slopes.tobytes()], "loss": [loss.tobytes()]})

    parts = joined.mapInArrow(forward, "chunk long, part binary").groupBy("chunk")
    heads = chunks.select("chunk", "labels").groupBy("chunk")
    judged = materialize(parts.cogroup(heads).applyInArrow(judge, "chunk long, slopes binary, loss binary"), "sparse-slopes")

    def backward(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                p = batch.slice(i, 1).to_pylist()[0]
                yield _sum_row(p["shard"], *_piece_gradient(p, np.frombuffer(p["slopes"]).reshape(-1, k)))

    def losses(batches):
        loss = np.zeros(k)
        for batch in batches:
            for x in batch.column("loss"):
                loss += np.frombuffer(x.as_py())
        yield _sum_row(LOSS, np.zeros(1), loss)

    back = pieces.join(judged.select("chunk", "slopes"), "chunk").mapInArrow(backward, SUMS)
    return back.unionByName(judged.select("loss").mapInArrow(losses, SUMS)), judged


# ---- the state of the descent: one row per shard


class _Shard:
    """The stored vectors of one shard: weights, and the basis of directions."""

    def __init__(self, row: dict, k: int):
        self.k, self.n, self.bias = k, row["n"], row["bias"]
        self.w = self._read(row["w"], (self.n, k))
        self.basis = self._read(row["basis"], (k, STORED, self.n))  # steps and changes, oldest first, then the gradient

    def _read(self, data: bytes, shape: tuple[int, ...]) -> np.ndarray:
        return np.frombuffer(data).reshape(shape).copy() if data else np.zeros(shape)

    def trial(self, scaled: np.ndarray, moving: np.ndarray) -> np.ndarray:
        """Weights of the models ``moving``, moved by ``scaled``: the coefficients of the basis per model
        times its step."""
        return np.stack([self.w[:, j] + scaled[j] @ self.basis[j] for j in moving], axis=1)

    def free(self, t: np.ndarray) -> np.ndarray:
        """Without the bias, which is not penalised."""
        t = t.copy()
        if self.bias >= 0:
            t[self.bias] = 0.0
        return t

    def square(self, t: np.ndarray) -> np.ndarray:
        return (self.free(t) ** 2).sum(axis=0)

    def advance(
        self, scaled: np.ndarray, found: bytes | None, moving: np.ndarray, accept: np.ndarray, first: np.ndarray, penalty: np.ndarray
    ) -> None:
        """Accepted models take their trial weights and remember the step.  ``found`` is the gradient of
        the data term of the models ``moving``; features at its end that no row has may be missing."""
        t = self.trial(scaled, moving)
        grad = self.free(t)
        if found:
            values = np.frombuffer(found).reshape(-1, len(moving))
            grad[: len(values)] += penalty[moving] * values
        for at, j in enumerate(moving):
            if not accept[j]:
                continue
            own = self.basis[j]
            if not first[j]:
                for lead, new in ((0, t[:, at] - self.w[:, j]), (HISTORY, grad[:, at] - own[-1])):
                    own[lead : lead + HISTORY - 1] = own[lead + 1 : lead + HISTORY].copy()
                    own[lead + HISTORY - 1] = new
            own[-1], self.w[:, j] = grad[:, at], t[:, at]

    def dots(self) -> np.ndarray:
        """Inner products of the stored vectors of each model."""
        return np.stack([own @ own.T for own in self.basis])


class _OnDriver:
    """The state while all of it is small: the same shards, held by the driver."""

    def __init__(self, state: DataFrame, k: int, few: bool):
        """``few``: the partial gradients of all tasks are small together."""
        self.k, self.few, self.shards = k, few, {r["shard"]: _Shard(r.asDict(), k) for r in state.collect()}

    def passed(self, chunks: DataFrame, scaled: np.ndarray, specs, moving: np.ndarray, smooth: float) -> tuple[np.ndarray, np.ndarray]:
        """(squared lengths, losses) of the trial weights of the models ``moving``."""
        trials = {shard: own.trial(scaled, moving) for shard, own in self.shards.items()}
        square = sum(own.square(trials[shard]) for shard, own in self.shards.items())
        sent = chunks.sparkSession.sparkContext.broadcast(trials)
        sums, m = _whole_pass(chunks, sent, specs, smooth), len(moving)
        self.grads = _gathered(sums, m, self.few)
        sent.destroy()
        return square, np.frombuffer(self.grads[LOSS])

    def advance(self, scaled, moving, accept, first, penalty) -> np.ndarray:
        for shard, own in self.shards.items():
            own.advance(scaled, self.grads.get(shard), moving, accept, first, penalty)
        return sum(own.dots() for own in self.shards.values())

    def table(self, spark) -> DataFrame:
        rows = [(shard, own.n, own.bias, own.w.tobytes(), b"", None) for shard, own in self.shards.items()]
        return spark.createDataFrame(rows, STATE)


class _InRows:
    """The state by training rows: a vector is the sum of the rows times its coefficients, and a bias.

    ``at`` and ``basis`` are the weights and the stored vectors of each model: coefficients, decisions
    without the bias, and biases.  Decisions of a trial follow from those stored, and so do inner products."""

    def __init__(self, rows: SparseRows, k: int):
        spark = rows.chunks.sparkSession
        heads = rows.chunks.select("chunk", "n", "labels").orderBy("chunk").toArrow().to_pylist()
        first = np.cumsum([0] + [h["n"] for h in heads])
        self.k, self.n, self.rows = k, int(first[-1]), rows
        self.labels = np.frombuffer(b"".join(h["labels"] for h in heads), np.int32)
        self.columns = _columns(rows, {h["chunk"]: int(a) for h, a in zip(heads, first)})
        cores = spark.sparkContext.defaultParallelism
        self.few = fits_broadcast(cores * self.n, 8 * k, DRIVER_BYTES)
        self.dealt = self.columns.coalesce(cores)  # a sum of all rows from each task
        self.at = (np.zeros((k, self.n)), np.zeros((k, self.n)), np.zeros(k))
        self.basis = (np.zeros((k, STORED, self.n)), np.zeros((k, STORED, self.n)), np.zeros((k, STORED)))

    def passed(self, chunks: DataFrame, scaled: np.ndarray, specs, moving: np.ndarray, smooth: float) -> tuple[np.ndarray, np.ndarray]:
        self.trial = [np.stack([x[j] + scaled[j] @ own[j] for j in moving]) for x, own in zip(self.at, self.basis)]
        coefs, decisions, bias = self.trial
        loss, slopes = _slopes((decisions + bias[:, None]).T, self.labels, specs, smooth)
        self.slopes = np.ascontiguousarray(slopes.T)
        return (coefs * decisions).sum(axis=1), loss

    def advance(self, scaled, moving, accept, first, penalty) -> np.ndarray:
        some = np.flatnonzero(accept[moving])
        slopes = self.slopes[some]
        sent = self.dealt.sparkSession.sparkContext.broadcast(slopes)
        found = _gathered(_decided(self.dealt, sent, self.n), len(some), self.few)
        sent.destroy()
        image = np.concatenate([np.frombuffer(found[i]).reshape(-1, len(some)) for i in sorted(found)]).T
        for i, at in enumerate(some):
            j = moving[at]
            trial = [x[at] for x in self.trial]
            grad = [trial[0] + penalty[j] * slopes[i], trial[1] + penalty[j] * image[i], penalty[j] * slopes[i].sum()]
            for x, own, t, g in zip(self.at, self.basis, trial, grad):
                if not first[j]:
                    for lead, new in ((0, t - x[j]), (HISTORY, g - own[j, -1])):
                        own[j, lead : lead + HISTORY - 1] = own[j, lead + 1 : lead + HISTORY].copy()
                        own[j, lead + HISTORY - 1] = new
                own[j, -1], x[j] = g, t
        dots = np.stack([a @ d.T + np.outer(b, b) for a, d, b in zip(*self.basis)])
        return (dots + dots.transpose(0, 2, 1)) / 2

    def table(self, spark) -> DataFrame:
        """The weights of each shard."""
        sent, k = spark.sparkContext.broadcast((self.at[0], self.at[2])), self.k

        def weigh(batches):
            coefs, bias = sent.value
            for batch in batches:
                for i in range(batch.num_rows):
                    c = batch.slice(i, 1).to_pylist()[0]
                    w = np.stack([_column_sums(c, coefs[j]) for j in range(k)], axis=1)
                    if c["bias"] >= 0:
                        w[c["bias"]] = bias
                    yield pa.RecordBatch.from_arrays([pa.array([c["shard"]], pa.int32()), pa.array([w.tobytes()], pa.binary())], names=["shard", "w"])

        found = materialize(self.columns.mapInArrow(weigh, "shard int, w binary"), "sparse-state")
        sent.destroy()
        discard(self.columns)
        return found


def _columns(rows: SparseRows, first: dict[int, int]) -> DataFrame:
    """Stored entries by feature: the places ``starts`` at which the features of a shard begin in rows
    and values.  ``first`` is the number of the first row of each chunk."""
    spark = rows.chunks.sparkSession
    place = rows.vocabulary.where(F.col("feature") == BIAS).first()
    bias = (place["shard"], place["idx"]) if place else (-1, -1)
    sent = spark.sparkContext.broadcast(first)

    def gather(table: pa.Table) -> pa.Table:
        pieces = table.to_pylist()
        row = np.concatenate([np.frombuffer(p["rows"], np.int32) + sent.value[p["chunk"]] for p in pieces]).astype(np.int32)
        col = np.concatenate([np.frombuffer(p["cols"], np.int32) for p in pieces])
        vals = np.concatenate([np.frombuffer(p["vals"]) for p in pieces])
        order = np.argsort(col, kind="stable")
        starts = np.flatnonzero(np.diff(col[order], prepend=-1)).astype(np.int32)
        shard = pieces[0]["shard"]
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()), "bias": pa.array([bias[1] if shard == bias[0] else -1], pa.int32()),
                "starts": pa.array([starts.tobytes()], pa.binary()), "rows": pa.array([row[order].tobytes()], pa.binary()),
                "vals": pa.array([vals[order].tobytes()], pa.binary()),
            }
        )

    pieces = rows.chunks.select("chunk", F.explode("pieces").alias("p")).select("chunk", "p.*")
    columns = pieces.groupBy("shard").applyInArrow(gather, "shard int, bias int, starts binary, rows binary, vals binary")
    columns = materialize(columns, "sparse-columns")
    sent.destroy()
    return columns


def _column_sums(c: dict, coefs: np.ndarray) -> np.ndarray:
    """For each feature of a shard the sum of its values times the coefficients of their rows."""
    return np.add.reduceat(np.frombuffer(c["vals"]) * coefs[np.frombuffer(c["rows"], np.int32)], np.frombuffer(c["starts"], np.int32))


def _decided(columns: DataFrame, sent: Broadcast, n: int) -> DataFrame:
    """Partial decisions, without the bias, of the sums of rows times the coefficients sent: a slice of
    rows in place of a shard."""

    def partial(batches):
        coefs = sent.value
        total = np.zeros(coefs.shape)
        for batch in batches:
            for i in range(batch.num_rows):
                c = batch.slice(i, 1).to_pylist()[0]
                rows, vals, starts = np.frombuffer(c["rows"], np.int32), np.frombuffer(c["vals"]), np.frombuffer(c["starts"], np.int32)
                sizes = np.diff(starts, append=len(rows))
                for j, own in enumerate(coefs):
                    w = _column_sums(c, own)
                    if c["bias"] >= 0:
                        w[c["bias"]] = 0.0
                    total[j] += np.bincount(rows, vals * np.repeat(w, sizes), n)
        for i, a in enumerate(range(0, n, SHARD_FEATURES)):
            part = np.ascontiguousarray(total[:, a : a + SHARD_FEATURES].T)
            yield _sum_row(i, np.arange(len(part)), part)

    return columns.select("bias", "starts", "rows", "vals").mapInArrow(partial, SUMS)


class _InTables:
    """The state as a table of shards, written anew after every pass."""

    def __init__(self, state: DataFrame, k: int, rows: SparseRows, broadcast_limit: int):
        self.state, self.k, self.rows, self.limit = state, k, rows, broadcast_limit
        self.grads = None
        self.shard_bytes = 8 * k * max(state.agg(F.max("n")).first()[0], 1)

    def passed(self, chunks: DataFrame, scaled: np.ndarray, specs, moving: np.ndarray, smooth: float) -> tuple[np.ndarray, np.ndarray]:
        trials, m = _trials(self.state, scaled, moving), len(moving)
        discard(self.grads)
        if fits_broadcast(self.rows.n_features, 8 * self.k, self.limit):
            found = trials.toArrow().to_pylist()
            weights = {r["shard"]: np.frombuffer(r["t"]).reshape(-1, m) for r in found}
            square = np.sum([r["square"] for r in found], axis=0)
            sent = chunks.sparkSession.sparkContext.broadcast(weights)
            self.grads = materialize(_added(_whole_pass(chunks, sent, specs, smooth), m), "sparse-gradient")
            sent.destroy()
        else:
            trials = materialize(trials, "sparse-trials")
            cells = trials.select(F.posexplode("square").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
            square = np.array([r["x"] for r in cells.orderBy("at").collect()])
            sums, judged = _sharded_pass(chunks, trials, self.rows.n_shards, specs, smooth, self.limit, self.shard_bytes)
            self.grads = materialize(_added(sums, m), "sparse-gradient")
            discard(trials, judged)
        return square, np.frombuffer(self.grads.where(F.col("shard") == LOSS).first()["grad"])

    def advance(self, scaled, moving, accept, first, penalty) -> np.ndarray:
        k = self.k

        def step(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    own = _Shard(r, k)
                    own.advance(scaled, r["grad"], moving, accept, first, penalty)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r["shard"]], pa.int32()), pa.array([own.n], pa.int32()), pa.array([own.bias], pa.int32()),
                            pa.array([own.w.tobytes()], pa.binary()), pa.array([own.basis.tobytes()], pa.binary()),
                            pa.array([own.dots().reshape(-1).tolist()]),
                        ],
                        names=["shard", "n", "bias", "w", "basis", "dots"],
                    )

        joined = self.state.drop("dots").join(self.grads, "shard", "left")
        old, self.state = self.state, materialize(joined.mapInArrow(step, STATE), "sparse-state")
        discard(old)
        rows = self.state.select(F.posexplode("dots").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
        out = np.zeros(k * STORED * STORED)
        for r in rows:
            out[r["at"]] = r["x"]
        return out.reshape(k, STORED, STORED)

    def table(self, spark) -> DataFrame:
        discard(self.grads)
        return self.state


def _trials(state: DataFrame, scaled: np.ndarray, moving: np.ndarray) -> DataFrame:
    """``(shard, t, square)``: trial weights and their squared length per model that moves."""
    k = len(scaled)

    def move(batches):
        for batch in batches:
            for r in batch.to_pylist():
                own = _Shard(r, k)
                t = own.trial(scaled, moving)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]], pa.int32()), pa.array([t.tobytes()], pa.binary()), pa.array([own.square(t).tolist()])],
                    names=["shard", "t", "square"],
                )

    return state.drop("dots").mapInArrow(move, "shard int, t binary, square array<double>")


def _direction(dots: np.ndarray, pairs: int) -> np.ndarray:
    """Coefficients of the descent direction over the stored vectors; the last ``pairs`` count."""
    out = np.zeros(STORED)
    out[-1] = -1.0
    slots = range(HISTORY - pairs, HISTORY)
    if not pairs:
        return out / max(np.sqrt(dots[-1, -1]), 1.0)
    alpha = {}
    for i in reversed(slots):
        alpha[i] = (out @ dots[:, i]) / dots[i, HISTORY + i]
        out[HISTORY + i] -= alpha[i]
    last = HISTORY - 1
    out *= dots[last, HISTORY + last] / dots[HISTORY + last, HISTORY + last]
    for i in slots:
        out[i] += alpha[i] - (out @ dots[:, HISTORY + i]) / dots[i, HISTORY + i]
    return out


def fit_sparse(
    rows: SparseRows, specs: Sequence[SparseSpec], tolerance: float = 1e-3, max_passes: int = 1_000,
    smooth: float = 0.1, broadcast_limit: int = BROADCAST_BYTES, driver_limit: int = HELD_BYTES,
) -> SparseFit:
    """Fit all ``specs`` together; a model that does not reach the tolerance is an error.

    The limits choose where weights and history are held, not what is fitted.  Tables that are read no
    more go, and the files of a shuffle as soon as the table it was for is written."""
    if not specs:
        raise ValueError("no model has been asked for")
    with shuffles_freed(rows.chunks.sparkSession):
        return _fitted(rows, specs, tolerance, max_passes, smooth, broadcast_limit, driver_limit)


def _held(rows: SparseRows, k: int, broadcast_limit: int, driver_limit: int) -> tuple[_OnDriver | _InRows | _InTables, DataFrame]:
    """(where the state of the descent is held, the chunks as it reads them)"""
    chunks, cores = rows.chunks, rows.chunks.sparkSession.sparkContext.defaultParallelism
    several = rows.n_chunks > 4 * cores
    if several and fits_broadcast(rows.n_rows, 16 * k * (STORED + 1), driver_limit) and fits_broadcast(rows.n_rows, 8 * k, broadcast_limit):
        return _InRows(rows, k), chunks
    empty = F.lit(b"").cast("binary")
    bias = F.coalesce(F.max(F.when(F.col("feature") == BIAS, F.col("idx"))), F.lit(-1)).cast("int")
    state = materialize(
        rows.vocabulary.groupBy("shard").agg(F.count(F.lit(1)).cast("int").alias("n"), bias.alias("bias")).select(
            "shard", "n", "bias", empty.alias("w"), empty.alias("basis"), F.lit(None).cast("array<double>").alias("dots")
        ),
        "sparse-state",
    )
    if not fits_broadcast(rows.n_features, 8 * k * (STORED + 1), driver_limit) or not fits_broadcast(rows.n_features, 8 * k, broadcast_limit):
        return _InTables(state, k, rows, broadcast_limit), chunks
    few = not several and fits_broadcast(rows.n_features * rows.n_chunks, 8 * k, DRIVER_BYTES)
    if few:  # a task for each chunk
        chunks = chunks.repartition(rows.n_chunks, "chunk")
    held = _OnDriver(state, k, few)
    discard(state)
    return held, chunks.persist()


def _fitted(
    rows: SparseRows, specs: Sequence[SparseSpec], tolerance: float, max_passes: int, smooth: float, broadcast_limit: int, driver_limit: int
) -> SparseFit:
    spark, k = rows.chunks.sparkSession, len(specs)
    held, chunks = _held(rows, k, broadcast_limit, driver_limit)
    penalty = np.array([s.C for s in specs])
    moving, first = np.ones(k, bool), np.ones(k, bool)
    step, delta, slope = np.ones(k), np.zeros((k, STORED)), np.zeros(k)
    value, pairs, passes = np.full(k, np.inf), np.zeros(k, int), np.zeros(k, int)
    norm, first_norm = np.full(k, np.inf), np.ones(k)
    dots = np.zeros((k, STORED, STORED))
    for _ in range(max_passes):
        scaled, members = delta * np.where(moving, step, 0.0)[:, None], np.flatnonzero(moving)
        square, loss = held.passed(chunks, scaled, [specs[i] for i in members], members, smooth)
        new = np.zeros(k)
        new[members] = 0.5 * square + penalty[members] * loss
        passes[moving] += 1
        accept = moving & (first | (new <= value + 1e-4 * step * slope))
        if accept.any():
            dots = held.advance(scaled, members, accept, first, penalty)
        for i in np.flatnonzero(moving):
            if accept[i]:
                value[i], norm[i] = new[i], np.sqrt(dots[i, -1, -1])
                if first[i]:
                    first_norm[i], first[i] = max(norm[i], 1e-12), False
                else:
                    s, y = HISTORY - 1, 2 * HISTORY - 1
                    useful = dots[i, s, y] > 1e-12 * dots[i, y, y]
                    pairs[i] = min(pairs[i] + 1, HISTORY) if useful else 0
                if norm[i] <= tolerance * first_norm[i]:
                    moving[i] = False
                    continue
            else:
                step[i] /= 2
                if step[i] >= 1e-6:
                    continue
                moving[i], pairs[i] = pairs[i] > 0, 0  # down the gradient, once
            step[i], delta[i] = 1.0, _direction(dots[i], pairs[i])
            slope[i] = delta[i] @ dots[i, :, -1]
        if not moving.any():
            break
    chunks.unpersist()
    relative = norm / first_norm
    if (relative > tolerance).any():
        raise RuntimeError(
            f"{int((relative > tolerance).sum())} of {k} models not fitted after {int(passes.max())} passes: relative gradient up to {relative.max():.2g}"
        )
    state = held.table(spark)
    weights = materialize(_named_weights(state, rows.vocabulary, [s.model_id for s in specs]), "sparse-weights")
    discard(state)
    report = [(s.model_id, float(s.C), float(value[i]), float(relative[i]), int(passes[i])) for i, s in enumerate(specs)]
    return SparseFit(
        weights,
        spark.createDataFrame(report, "model_id string, C double, loss double, gradient double, passes int"),
    )


def _named_weights(state: DataFrame, vocabulary: DataFrame, names: list[str]) -> DataFrame:
    """``(model_id, feature, weight)`` of every model and feature."""
    k = len(names)

    def name(own: pa.Table, words: pa.Table) -> pa.Table:
        w = np.frombuffer(own.column("w")[0].as_py()).reshape(-1, k)[np.asarray(words.column("idx"))]
        return pa.table(
            {
                "model_id": pa.array(np.repeat(names, len(w)), pa.string()),
                "feature": pa.concat_arrays([words.column("feature").combine_chunks()] * k),
                "weight": w.T.reshape(-1),
            }
        )

    sides = state.select("shard", "w").groupBy("shard").cogroup(vocabulary.groupBy("shard"))
    return sides.applyInArrow(name, "model_id string, feature string, weight double")
