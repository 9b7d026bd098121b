"""Exact-size seeded random subsets and exact random ranks, without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.order import hash_key

SORTED_LIMIT = 20_000
DIGITS = 3
DIGEST = 32  # digits of a whole hash


def random_cut(df: DataFrame, n: int, seed: int, id_col: str = "id") -> Column:
    """A predicate true for exactly the first ``n`` rows in seeded hash order.

    Only the position of the cut is searched for: counts per leading hex digits (at most
    4,096 rows a pass) narrow it down, then at most ``SORTED_LIMIT`` rows are ordered.  The
    subset and its complement are then plain filters on the same table."""
    if n <= 0:
        return F.lit(False)
    keys = df.select(hash_key(seed, id_col).alias("h"), F.col(id_col).alias("i"))
    prefix, left = "", n
    while left > SORTED_LIMIT and len(prefix) < DIGEST:
        counts = (
            keys.where(F.col("h").startswith(prefix))
            .groupBy(F.substring("h", len(prefix) + 1, DIGITS).alias("d"))
            .count()
            .collect()
        )
        for row in sorted(counts, key=lambda r: r["d"]):
            if row["count"] >= left:
                prefix += row["d"]
                break
            left -= row["count"]
        else:
            return F.lit(True)
    if left > SORTED_LIMIT:
        raise ValueError(f"more than {SORTED_LIMIT} rows share one {id_col}: no exact subset can be named by ids")
    last = (
        keys.where(F.col("h").startswith(prefix))
        .select(F.struct("h", "i").alias("k"))
        .orderBy("k")
        .limit(left)
        .agg(F.max("k").alias("k"), F.count(F.lit(1)).alias("n"))
        .first()
    )
    if last["n"] < left:
        return F.lit(True)
    h, cut = hash_key(seed, id_col), last["k"]
    return (h < cut["h"]) | ((h == cut["h"]) & (F.col(id_col) <= cut["i"]))


def take_random(
    df: DataFrame, n: int, seed: int, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """``n`` random rows and the rest."""
    chosen = random_cut(df, n, seed, id_col)
    return df.where(chosen), df.where(~chosen)


def ratio_split(
    df: DataFrame, ratio: float, seed: int, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Training and testing rows; the training side has exactly int(N * ratio) rows."""
    return take_random(df, int(df.count() * ratio), seed, id_col)


def hash_rank(
    df: DataFrame, by: str, seed: int, id_col: str = "id", out_col: str = "rank"
) -> DataFrame:
    """Exact 1-based rank of each row in seeded hash order within its ``by`` group.

    A group may be most of the table, so no window spans a group: rows are ranked inside
    (group, hash bucket) and the running count of the earlier buckets is added."""
    keyed = df.withColumn("_h", hash_key(seed, id_col)).withColumn(
        "_bucket", F.substring("_h", 1, DIGITS)
    )
    running = Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col(by).alias("_by"),
            F.col("_bucket").alias("_b"),
            F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
        )
    )
    inside = Window.partitionBy(by, "_bucket").orderBy("_h", id_col)
    return (
        keyed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_bucket") == F.col("_b")))
        .withColumn(out_col, (F.col("_inside") + F.col("_before")).cast("long"))
        .drop("_h", "_bucket", "_inside", "_by", "_b", "_before")
    )
