"""Near-duplicate vectors of equal label by cosine, compared in tiles of leading PCA dimensions.

Unit vectors are rotated to their principal axes, so the leading coordinates carry most of a
product.  Two vectors above the threshold lie within a fixed distance, so on the first axis
only equal or adjacent cells of that width can hold links; cells are cut into tiles of bounded
size.  A pair of tiles accumulates products by groups of leading dimensions.  What the rest can
add is at most the product of the two suffix norms, and a pair stops as soon as even that
cannot reach the threshold.  Pairs that are left are decided by their full cosine.

A tile pair returns a number of links per vector and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import materialize
from .graph import components

TILE = 2048
STEPS = (8, 16, 32, 64, 128, 256, 512)
SLACK = 1e-6  # bounds are loosened by this much; the decision itself is not
PAIRS_AT_ONCE = 1 << 14


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes (columns, most important first) of the unit vectors of each dimension."""

    def gram(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.diff(np.asarray(batch.column("vec").offsets))
            for dim in np.unique(lengths):
                some = pa.table([batch.column("vec").take(pa.array(np.flatnonzero(lengths == dim)))], names=["vec"])
                unit = _unit(_matrix(some.column("vec"), int(dim)))
                sums[int(dim)] = sums.get(int(dim), 0) + unit.T @ unit
        for dim, total in sums.items():
            at = np.arange(dim * dim)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim * dim, dim)), pa.array(at), pa.array(total.reshape(-1))], names=["dim", "at", "x"])

    rows = vectors.select("vec").mapInArrow(gram, "dim long, at long, x double")
    total: dict[int, np.ndarray] = {}
    for r in rows.groupBy("dim", "at").agg(F.sum("x").alias("x")).collect():  # dim * dim numbers
        total.setdefault(r.dim, np.zeros(r.dim * r.dim))[r.at] = r.x
    out = {}
    for dim, values in total.items():
        _, basis = np.linalg.eigh(values.reshape(dim, dim))
        out[dim] = basis[:, ::-1].copy()
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)  # keeps squares of very large or small values finite
    x = x / largest
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _candidates(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose products may reach the threshold, by accumulated leading dimensions."""
    dim = a.shape[1]
    stops = [s for s in STEPS if s < dim] + [dim]
    rest_a = np.sqrt(np.maximum(np.cumsum(a[:, ::-1] ** 2, axis=1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum(np.cumsum(b[:, ::-1] ** 2, axis=1)[:, ::-1], 0))
    need = threshold - SLACK
    total = np.zeros((len(a), len(b)), dtype=np.float64)
    done = 0
    for stop in stops:  # the whole tile, while many pairs are open
        total += a[:, done:stop] @ b[:, done:stop].T
        done = stop
        if stop == dim:
            return np.nonzero(total >= need)
        open_pairs = total + np.outer(rest_a[:, stop], rest_b[:, stop]) >= need
        if np.count_nonzero(open_pairs) * 16 < total.size:
            break
    i, j = np.nonzero(open_pairs)
    product = total[i, j]
    for stop in stops[stops.index(done) + 1 :]:  # then pair by pair
        for at in range(0, len(i), PAIRS_AT_ONCE):
            cut = slice(at, at + PAIRS_AT_ONCE)
            product[cut] += np.einsum("ij,ij->i", a[i[cut], done:stop], b[j[cut], done:stop])
        bound = product if stop == dim else product + rest_a[i, stop] * rest_b[j, stop]
        keep = bound >= need
        i, j, product, done = i[keep], j[keep], product[keep], stop
    return i, j


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex that each of n vertices reaches over the links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, root[i], least)
        np.minimum.at(new, root[j], least)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _compare(axes, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        basis = axes.value[dim]
        ids, counts = table.column("id").to_numpy(), table.column("m").to_numpy()
        right = table.column("right").to_numpy(zero_copy_only=False)
        vectors = _matrix(table.column("vec"), dim)
        unit = _unit(vectors)
        turned = unit @ basis
        left, other = np.flatnonzero(~right), np.flatnonzero(right)
        inside = not len(other) and table.column("inside")[0].as_py()
        if inside:
            other = left
        i, j = _candidates(turned[left], turned[other], threshold)
        i, j = left[i], other[j]
        if inside:
            i, j = i[i < j], j[i < j]
        keep = np.empty(len(i), dtype=bool)
        for at in range(0, len(i), PAIRS_AT_ONCE):
            cut = slice(at, at + PAIRS_AT_ONCE)
            keep[cut] = np.einsum("ij,ij->i", unit[i[cut]], unit[j[cut]]) >= threshold
        i, j = i[keep], j[keep]
        n = np.bincount(i, weights=counts[j], minlength=len(ids)) + np.bincount(j, weights=counts[i], minlength=len(ids))
        some = np.flatnonzero(n)
        root = _forest(i, j, len(ids))
        return pa.table({"id": ids[some], "n": n[some].astype(np.int64), "root": ids[root[some]]})

    return run


def cosine_links(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    tile: int = TILE,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row: how many other vectors of the same label and
    length have a cosine of at least ``threshold``, the smallest id that links reach, and
    whether that is the row itself.

    Without a label, or with a vector that is null, empty, zero or holds a null or non-finite
    component, a row links with nothing.  A row with a null id links with nothing either and
    has no component.  Repeated rows count as vectors of their own.  Equal vectors are compared
    once.  Other columns are not read."""
    spark = vectors.sparkSession
    rows = vectors.select(
        vectors[id_column].cast("long").alias("id"), vectors[label].alias("label"), vectors[vector].cast("array<double>").alias("vec")
    )
    usable = (
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists("vec", lambda x: x != 0)
    )
    rows = rows.withColumn("vec", F.when(F.coalesce(usable, F.lit(False)), F.col("vec")))
    good = rows.where("vec is not null")
    classes = materialize(good.groupBy("label", "vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m")), "vector-classes")
    axes = spark.sparkContext.broadcast(_axes(classes))
    width = math.sqrt(2 - 2 * threshold) + SLACK

    def place(batches):
        for batch in batches:
            vec = batch.column("vec")
            flat, offsets = vec.flatten().to_numpy(zero_copy_only=False), np.asarray(vec.offsets)
            offsets = offsets - offsets[0]
            size, cell = np.diff(offsets), np.zeros(batch.num_rows, dtype=np.int64)
            for dim in np.unique(size):
                here = np.flatnonzero(size == dim)
                x = _unit(flat[offsets[here][:, None] + np.arange(dim)])
                cell[here] = np.floor(x @ axes.value[int(dim)][:, 0] / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype(np.int64)), pa.array(cell)], names=[*batch.schema.names, "dim", "cell"])

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.mapInArrow(place, f"label {kind}, vec array<double>, id long, m long, dim long, cell long")
    cells = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    cells = materialize(cells, "vector-cells")
    near = cells
    for step, name in ((1, "above"), (-1, "below")):
        side = cells.select("label", "dim", (F.col("cell") - step).alias("cell"), F.col("tiles").alias(name))
        near = near.join(side, ["label", "dim", "cell"], "left").fillna(0, [name])
    at = placed.join(near, ["label", "dim", "cell"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    up_to = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own, cell = F.col("own"), F.col("cell")

    def meeting(c1, t1, c2, t2, right):
        return F.struct(c1.alias("c1"), t1.alias("t1"), c2.alias("c2"), t2.alias("t2"), F.lit(right).alias("right"))

    met = F.concat(
        F.transform(up_to(F.col("tiles")), lambda t: F.when(
            t >= own, meeting(cell, own, cell, t, False)).otherwise(meeting(cell, t, cell, own, True))),
        F.transform(up_to(F.col("above")), lambda t: meeting(cell, own, cell + 1, t, False)),
        F.transform(up_to(F.col("below")), lambda t: meeting(cell - 1, t, cell, own, True)),
    )
    tiles = at.select("label", "dim", "id", "m", "vec", F.explode(met).alias("p")).select("label", "dim", "id", "m", "vec", "p.*")
    tiles = tiles.withColumn("inside", (F.col("c1") == F.col("c2")) & (F.col("t1") == F.col("t2")))
    found = materialize(
        tiles.groupBy("label", "dim", "c1", "t1", "c2", "t2").applyInArrow(_compare(axes, threshold), "id long, n long, root long"), "vector-links"
    )
    reached = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = classes.join(found.groupBy("id").agg(F.sum("n").alias("n")), "id", "left").join(reached, "id", "left").select(
        "label", "vec", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    out = rows.join(counted, ["label", "vec"], "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    return out.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
