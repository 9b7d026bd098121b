"""Operations on labeled and unlabeled sets.  Every set is an immutable DataFrame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from .sampling import random_cut, take_random

EMPTY_MINORITY = 1


def minority_stats(df: DataFrame, label_col: str = "classLabel") -> DataFrame:
    """One row: minority class, its rows, and all other rows (unlabeled ones included).

    Ties go to the smallest label; an empty set has minority class 1."""
    per_class = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    labeled = F.col(label_col).isNotNull()
    fewest = F.min(F.when(labeled, F.struct(F.col("n"), F.col(label_col).alias("label"))))
    minority = F.coalesce(fewest["label"], F.lit(EMPTY_MINORITY).cast(df.schema[label_col].dataType))
    rows = F.coalesce(fewest["n"], F.lit(0))
    return per_class.agg(
        minority.alias("minority_class"),
        rows.cast("long").alias("minority_rows"),
        (F.coalesce(F.sum("n"), F.lit(0)) - rows).cast("long").alias("majority_rows"),
    )


def split_by_ids(
    df: DataFrame, ids: DataFrame | Iterable, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Rows with the given ids, and the rest."""
    if isinstance(ids, DataFrame):
        keys = ids.select(id_col)
        return df.join(keys, id_col, "left_semi"), df.join(keys, id_col, "left_anti")
    listed = F.col(id_col).isin(list(ids))
    return df.where(listed), df.where(~listed)


def undersample(
    df: DataFrame, n: int, seed: int, label_col: str = "classLabel", id_col: str = "id",
    minority=None,
) -> tuple[DataFrame, DataFrame]:
    """Remove ``n`` random rows outside the minority class: (removed, rest)."""
    if minority is None:
        minority = minority_stats(df, label_col).first()["minority_class"]
    majority = ~F.col(label_col).eqNullSafe(F.lit(minority))
    chosen = majority & random_cut(df.where(majority), n, seed, id_col)
    return df.where(chosen), df.where(~chosen)


def balance(
    df: DataFrame, seed: int, k: int | None = None, label_col: str = "classLabel", id_col: str = "id"
) -> DataFrame:
    """Drop ``k`` majority rows, by default down to the size of the minority class."""
    stats = minority_stats(df, label_col).first()
    total = stats["minority_rows"] + stats["majority_rows"]
    if total == 0:
        raise ValueError("no labeled data has been provided")
    if not k:
        k = stats["majority_rows"] - stats["minority_rows"]
    return undersample(df, k, seed, label_col, id_col, stats["minority_class"])[1]


def assert_unique(df: DataFrame, id_col: str = "id") -> None:
    repeated = df.groupBy(id_col).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"duplicate instance id: {repeated[0][id_col]}")


def append_unique(df: DataFrame, new_rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Both sets together; an id that occurs twice is an error."""
    combined = df.unionByName(new_rows)
    assert_unique(combined, id_col)
    return combined


def move_random(
    pool: DataFrame, labeled: DataFrame, k: int, seed: int, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Move ``k`` random pool rows, with the labels they carry, to the labeled set.

    Returns (pool, labeled)."""
    if pool.isEmpty():
        raise ValueError("the pool is empty")
    moved, rest = take_random(pool, k, seed, id_col)
    return rest, append_unique(labeled, moved, id_col)


def sample_columns(
    df: DataFrame, label_col: str = "classLabel", text_col: str = "origText"
) -> DataFrame:
    """Everything but the label and the text."""
    return df.drop(label_col, text_col)


def label_column(df: DataFrame, label_col: str = "classLabel", id_col: str = "id") -> DataFrame:
    return df.select(id_col, label_col)


def instance_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.select(id_col)
