"""Kernel expressions between two array columns of one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KERNELS = ("linear", "poly", "rbf", "sigmoid")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def _squared_gap(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, v: acc + v * v)


def kernel(
    a: Column, b: Column, kind: str = "rbf", gamma: float = 1.0, coef0: float = 0.0, degree: int = 3
) -> Column:
    if kind == "linear":
        return dot(a, b)
    if kind == "poly":
        return F.pow(gamma * dot(a, b) + coef0, F.lit(float(degree)))
    if kind == "rbf":
        return F.exp(-gamma * _squared_gap(a, b))
    if kind == "sigmoid":
        return F.tanh(gamma * dot(a, b) + coef0)
    raise ValueError(f"kernel must be one of {KERNELS}, got {kind!r}")


def kernel_cosine(k_ab: Column, k_aa: Column, k_bb: Column) -> Column:
    """Absolute kernel value over the root of the self-kernels; 0 when either is 0."""
    return F.when((k_aa == 0) | (k_bb == 0), F.lit(0.0)).otherwise(
        F.try_divide(F.abs(k_ab), F.sqrt(k_aa * k_bb))
    )


def kernel_distance(k_ab: Column, k_aa: Column, k_bb: Column, metric: bool = False) -> Column:
    """Root of K(a,a) + K(b,b) + 2K(a,b); ``metric=True`` subtracts instead of adding."""
    cross = -2.0 * k_ab if metric else 2.0 * k_ab
    return F.sqrt(F.greatest(k_aa + k_bb + cross, F.lit(0.0)))


def default_gamma(n_features: int) -> float:
    return 1.0 / n_features
