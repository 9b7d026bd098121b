"""Whitening of embeddings by their leading principal components, found by contour integration.

Entries become integers, ``x = floor(64 c) + 1000000``.  The fit list holds each distinct vector of
integers once; its sums are exact, its covariance is summed over tasks after centring.

The components come from FEAST (Polizzi 2009).  Inertia counts, the signs of the pivots of a shifted
symmetric factorisation, slice the spectrum into intervals with a few eigenvalues each.  For an
interval the projector onto its eigenvectors is a contour integral of the resolvent; eight Gauss
nodes on the upper half circle give eight complex shifted systems, each a row of a Spark job.
Rayleigh and Ritz on the projected subspace gives eigenpairs, repeated until the residuals are at
rounding and the number found is the number counted, so none is missed.  Driver and tasks hold
matrices of the vectors' dimension, never a number of vectors.

Defined results for odd rows: rows whose vector is null, empty, or holds null or non-finite entries
are dropped, and so are rows with an entry of 2 ** 56 or more, which the integers cannot hold.  Where
lengths differ, the most frequent one is fitted (of equally frequent ones the smallest) and other
rows are dropped.  Rows are independent, so repeated and null ids give rows of their own.
Components whose eigenvalue is below 1e-10 of the greatest are constant up to rounding and not
returned; one distinct vector has none, an empty table has no rows.  ``deviation`` is null where it
doesn't fit a long.  Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.scratch import materialize

OFFSET = 1_000_000
COMPONENTS = 16
LARGEST = 2.0**62  # of 64 * entry
BLOCK_CELLS = 1 << 20
NODES = 8
IN_INTERVAL = 8  # eigenvalues of an interval, where the spectrum lets itself be cut
ROUNDS = 40
FLOOR = 1e-10  # of the greatest eigenvalue
RESIDUAL = 1e-13  # of the trace


@dataclass(frozen=True)
class Whitening:
    """``sums`` are of ``floor(64 c)``, exact.  Columns of ``vectors`` are unit eigenvectors by
    falling eigenvalue."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and a rest in [0, 1)."""
        whole = [s // self.n for s in self.sums]
        rest = [float(Fraction(s, self.n) - w) for s, w in zip(self.sums, whole, strict=True)]
        return np.array(whole, np.int64), np.array(rest)


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dim and the integers in the fewest bytes that hold all of a vector."""
    for batch in batches:
        column = batch.column("vec")
        lengths = np.diff(np.asarray(column.offsets))
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(lengths)
        ids, dims, codes = [], [], []
        for dim in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == dim)
            step = max(1, BLOCK_CELLS // dim)
            for first in range(0, len(rows), step):
                at = rows[first : first + step]
                c = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                with np.errstate(over="ignore"):
                    c = c * 64.0
                good = (np.abs(c) < LARGEST).all(axis=1)  # false for null (nan) and infinite entries
                f = np.floor(c[good]).astype(np.int64)
                most = np.maximum(f.max(axis=1, initial=0), -1 - f.min(axis=1, initial=0))
                ids.append(at[good])
                dims.append(np.full(len(f), dim))
                for row, size in zip(f, most, strict=True):
                    kind = "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<i8"
                    codes.append(row.astype(kind).tobytes())
        if codes:
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.concatenate(ids))), pa.array(np.concatenate(dims), pa.int32()), pa.array(codes, pa.binary())],
                names=["vec_id", "dim", "code"],
            )


def _floors(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their integers) in blocks of bounded size."""
    codes = batch.column("code").to_pylist()
    sizes = np.array([len(c) // dim for c in codes])
    step = max(1, BLOCK_CELLS // dim)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        for first in range(0, len(rows), step):
            at = rows[first : first + step]
            packed = np.frombuffer(b"".join(codes[i] for i in at), f"<i{size}")
            yield at, packed.astype(np.int64).reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows of the fit list and their exact sums; halves of the integers are added apart, so that
    none overflows."""

    def partial(batches):
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            for at, f in _floors(batch, dim):
                n += len(at)
                high += (f >> 32).sum(axis=0)
                low += (f & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim)), pa.array(np.full(dim, n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"]
        )

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = fit.mapInArrow(partial, "i long, n long, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), wide("high"), wide("low"))
    found = sorted(rows.collect())  # one row for each dimension
    return found[0].n, [(int(r.high) << 32) + int(r.low) for r in found]


def _second_moments(fit: DataFrame, dim: int, rows_of, width: int) -> np.ndarray:
    """Sum of r r' over the rows ``rows_of(integers)``, ``width`` columns each."""
    upper = np.triu_indices(width)

    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for _, f in _floors(batch, dim):
                r = rows_of(f)
                total += r.T @ r
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["cell", "x"])

    cells = fit.mapInArrow(partial, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
    out = np.zeros((width, width))
    for r in cells:  # width * (width + 1) / 2 numbers
        out[upper[0][r.cell], upper[1][r.cell]] = out[upper[1][r.cell], upper[0][r.cell]] = r.x
    return out


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: positive pivots of its factorisation
    after the shift (Sylvester), with pivots of one or two rows, whichever is the larger."""
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        p, q = divmod(int(off.argmax()), len(a))
        if diagonal[i] >= 0.6403882032022076 * off[p, q]:  # (1 + sqrt 17) / 8
            pivot, rows = a[i, i], [i]
            if pivot == 0:
                break  # nothing is left
            positive += pivot > 0
            column = a[:, i]
            a = a - np.outer(column, column / pivot)
        else:
            rows = [p, q]
            block = a[np.ix_(rows, rows)]
            positive += int((np.linalg.eigvalsh(block) > 0).sum())
            a = a - a[:, rows] @ np.linalg.solve(block, a[rows, :])
        a = np.delete(np.delete(a, rows, axis=0), rows, axis=1)
    return int(positive)


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), highest first, that hold the ``wanted`` greatest above the
    floor.  No end lies within rounding of an eigenvalue."""
    top = float(np.trace(matrix)) * (1 + 1e-9)
    thin = 1e-12 * top

    def clear(x: float) -> int | None:
        above = count_above(matrix, x + thin)
        return above if above == count_above(matrix, x - thin) else None

    low, high = 0.0, top  # the greatest eigenvalue, for the floor
    while high - low > 1e-3 * high:
        mid = (low + high) / 2
        low, high = (mid, high) if count_above(matrix, mid) else (low, mid)
    bottom = next(x for k in range(200) if clear(x := max(FLOOR * high, 4 * thin) * 0.97**k) is not None)
    found, open_slices = [], [(bottom, top, clear(bottom), 0)]
    while open_slices:
        low, high, above_low, above_high = open_slices.pop()
        count = above_low - above_high
        if not count or above_high >= wanted:
            continue
        cuts = (low + (high - low) * s for s in (0.5, 0.43, 0.57, 0.38, 0.62, 0.29, 0.71))
        cut = None
        if count > IN_INTERVAL and high - low > 1e-9 * top:
            cut = next(((x, n) for x in cuts if (n := clear(x)) is not None), None)
        if cut is None:
            found.append((low, high, count))
        else:
            open_slices += [(low, cut[0], above_low, cut[1]), (cut[0], high, cut[1], above_high)]
    return found


def _projected(spark: SparkSession, matrix: np.ndarray, todo: dict[int, tuple[float, float, np.ndarray]]) -> dict[int, np.ndarray]:
    """The subspace of each interval under its spectral projector, by quadrature: a task for each
    shifted system."""
    dim = len(matrix)
    x, weight = np.polynomial.legendre.leggauss(NODES)
    rows = []
    for key, (low, high, _) in todo.items():
        for k in range(NODES):
            turn = np.exp(0.5j * np.pi * (1 - x[k])) * (high - low) / 2
            z = (low + high) / 2 + turn
            rows.append((key, float(z.real), float(z.imag), float((weight[k] * turn / 2).real), float((weight[k] * turn / 2).imag)))
    bases = {key: basis for key, (_, _, basis) in todo.items()}

    def solve(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shifted = complex(r["re"], r["im"]) * np.eye(dim) - matrix
                part = (complex(r["wre"], r["wim"]) * np.linalg.solve(shifted, bases[r["key"]].astype(complex))).real
                at = np.arange(part.size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(part.size, r["key"])), pa.array(at), pa.array(part.reshape(-1))], names=["key", "cell", "x"]
                )

    nodes = spark.createDataFrame(rows, "key long, re double, im double, wre double, wim double").repartition(len(rows))
    cells = nodes.mapInArrow(solve, "key long, cell long, x double").groupBy("key", "cell").agg(F.sum("x").alias("x")).collect()
    out = {key: np.zeros(basis.size) for key, basis in bases.items()}
    for r in cells:  # dim times the columns of all subspaces
        out[r.key][r.cell] = r.x
    return {key: out[key].reshape(dim, -1) for key in out}


def _ritz(matrix: np.ndarray, subspace: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residuals) of the matrix within a subspace."""
    left, sizes, _ = np.linalg.svd(subspace, full_matrices=False)
    basis = left[:, sizes > 1e-13 * sizes[0]]
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    vectors = basis @ turn
    return values, vectors, np.linalg.norm(matrix @ vectors - vectors * values, axis=0)


def leading_components(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues above the floor and their unit vectors, none missed."""
    dim, size = len(matrix), float(np.trace(matrix))
    if not size > 0:
        return np.zeros(0), np.zeros((dim, 0))
    scaled = matrix / size
    slices = intervals(scaled, wanted)
    rng = np.random.default_rng(11)
    columns = [min(dim, 2 * count + 4) for _, _, count in slices]
    todo = {k: (low, high, rng.standard_normal((dim, columns[k]))) for k, (low, high, _) in enumerate(slices)}
    done: dict[int, np.ndarray] = {}
    for _ in range(ROUNDS):
        for key, subspace in _projected(spark, scaled, todo).items():
            low, high, _ = todo[key]
            values, vectors, residual = _ritz(scaled, subspace)
            inside = (values > low) & (values < high)
            if inside.sum() == slices[key][2] and (residual[inside] <= RESIDUAL).all():
                done[key] = vectors[:, inside]
                del todo[key]
            else:
                fill = rng.standard_normal((dim, columns[key] - vectors.shape[1]))
                todo[key] = (low, high, np.hstack([vectors, fill]))
        if not todo:
            break
    else:
        raise ArithmeticError(f"{len(todo)} of {len(slices)} eigenvalue intervals did not settle in {ROUNDS} rounds")
    values, vectors, _ = _ritz(scaled, np.hstack([done[k] for k in sorted(done)]))
    order = np.argsort(-values)[:wanted]
    vectors = vectors[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order] * size, vectors * sign


def _centred(f: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (f - whole).astype(np.float64) - rest


def fit_whitening(codes: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fitted over the distinct vectors of ``codes`` (vec_id, dim, code); None for an empty table."""
    most = codes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return None
    dim = most.dim
    fit = materialize(codes.where(F.col("dim") == dim).select("code").distinct(), "whitening-fit")
    n, sums = _sums(fit, dim)
    model = Whitening(dim, n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
    whole, rest = model.centre()
    covariance = _second_moments(fit, dim, lambda f: _centred(f, whole, rest), dim) / n
    values, vectors = leading_components(codes.sparkSession, covariance, min(components, dim))
    error = None
    if len(values):
        scaled = vectors / np.sqrt(values)
        white = _second_moments(fit, dim, lambda f: _centred(f, whole, rest) @ scaled, len(values)) / n
        error = float(np.abs(white - np.eye(len(values))).max())
    return Whitening(dim, n, sums, values, vectors, float(np.trace(covariance)), error)


def _deviations(f: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of (n x - S)^2, exact."""
    largest = max(float(np.abs(f.astype(np.float64)).max(initial=0)) * n, max(abs(float(s)) for s in sums))
    if largest < 2.0**62:
        d = n * f - np.array(sums, np.int64)
        if float((d.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) < 2.0**62:
            return (d * d).sum(axis=1).tolist()
    exact = ((n * f.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(x) if x < 1 << 63 else None for x in exact]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each remaining row of ``vectors`` (vec_id, embedding) and component."""
    rows = vectors.where(F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    codes = materialize(rows.mapInArrow(_codes, "vec_id long, dim int, code binary"), "whitening-codes")
    model = fit_whitening(codes, components)
    if model is None or not len(model.values):
        return codes.sparkSession.createDataFrame([], SCHEMA)
    whole, rest = model.centre()
    scaled = model.vectors / np.sqrt(model.values)
    share = model.values / model.trace
    k, n, sums, dim, error = len(share), model.n, model.sums, model.dim, model.identity_error

    def project(batches):
        for batch in batches:
            for at, f in _floors(batch, dim):
                white = _centred(f, whole, rest) @ scaled
                ids = batch.column("vec_id").take(pa.array(np.repeat(at, k)))
                deviation = pa.array(_deviations(f, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(ids), n)),
                        deviation, pa.array(white.reshape(-1)), pa.array(np.tile(share, len(at))), pa.array(np.full(len(ids), error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return codes.where(F.col("dim") == dim).select("vec_id", "code").mapInArrow(project, SCHEMA)
