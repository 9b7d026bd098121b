"""Whitening against a dense eigensolver and exact arithmetic."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright.llm.whitening import count_above, intervals, leading_components, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(row):
    v = row[1]
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def brute(rows):
    """(x by row, fit list, n, S, eigenvalues, unit vectors, trace)"""
    good = [r for r in rows if usable(r)]
    x = [tuple(int(np.floor(64 * np.float64(np.float32(c)))) + 1000000 for c in r[1]) for r in good]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for v in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    return good, x, n, sums, values[::-1], vectors[:, ::-1], np.trace(cov)


def check(spark, rows, expected=None):
    found = whiten(spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit(1)))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = found.collect()
    good, x, n, sums, values, vectors, trace = brute(rows)
    k = expected or min(16, len(sums))
    assert len(got) == k * len(good)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4
    want = []
    for r, v in zip(good, x, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)])
        want += [(r[0], c + 1, deviation, abs(float(centred @ vectors[:, c])) / np.sqrt(values[c])) for c in range(k)]
    order = lambda r: (str(r[0]), r[1], r[2], round(r[3], 6))
    for a, b in zip(sorted(((r.vec_id, r.component, r.deviation, abs(r.whitened)) for r in got), key=order), sorted(want, key=order), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-7, abs=1e-7)
    for r in got[:k]:
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
    signs = {}  # one sign for each component, whatever the row
    by_id = {r[0]: v for r, v in zip(good, x, strict=True)}
    for r in got:
        if r.vec_id is not None:
            centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(by_id[r.vec_id], sums, strict=True)])
            if abs(r.whitened) > 1e-3:
                signs.setdefault(r.component, set()).add(np.sign(r.whitened) * np.sign(centred @ vectors[:, r.component - 1]))
    assert all(len(s) == 1 for s in signs.values())


def test_against_dense_solver(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 24)) * np.linspace(2, 0.1, 24) + rng.standard_normal(24)
    rows = [(i, base[i].astype(np.float32).tolist(), 1) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1], None) for i in range(200)]  # copies count once
    rows += [(2000, None, 1), (2001, [None] * 24, 1), (2002, [float("nan")] * 24, 1), (2003, [float("inf")] + [0.0] * 23, 1), (2004, [], 1)]
    rows += [(None, rows[0][1], 1)]
    check(spark, rows)


def test_few_dimensions_and_large_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(3) * [1e4, 10, 1]).astype(np.float32).tolist(), 1) for i in range(60)]
    check(spark, rows)
    rows = [(i, [float(i % 5), float(i % 5) * 2, 0.0, float(i % 3)], 1) for i in range(60)]  # two of four dimensions
    check(spark, rows, expected=2)


def test_degenerate_tables(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0], 1)] * 5, SCHEMA)).collect() == []  # one distinct vector
    mixed = [(i, [float(i), float(i * i % 7)], 1) for i in range(9)] + [(20, [1.0], 1), (21, [float("nan"), 1.0], 1), (22, [3e38, 1.0], 1)]
    assert {r.vec_id for r in whiten(spark.createDataFrame(mixed, SCHEMA)).collect()} == set(range(9))


@pytest.mark.parametrize("values", [[5.0] * 20, [1.0 + 1e-9 * i for i in range(30)], [2.0**-i for i in range(30)], [3, 3, 3, 1, 1, 0, 0, 0]])
def test_spectra(spark, values):
    """Equal, clustered, steep and deficient spectra: all of the greatest are found, orthonormal."""
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    for shift in (0.5, 1.0000000155, 2.5, 7.0):
        if min(abs(shift - v) for v in values) > 1e-12:
            assert count_above(matrix, shift) == sum(v > shift for v in values)
    want = sorted((v for v in values if v > 1e-10 * max(values)), reverse=True)[:16]
    slices = intervals(matrix / np.trace(matrix), 16)
    assert sum(c for _, _, c in slices) >= len(want)
    assert all(low >= high for (low, _, _), (_, high, _) in zip(slices, slices[1:]))  # highest first, none overlap
    found, vectors = leading_components(spark, matrix, 16)
    assert found == pytest.approx(want, rel=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * max(values)
