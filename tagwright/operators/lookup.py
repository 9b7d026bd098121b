"""Joins of many rows against one row per key, safe when single keys are very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import materialize

BROADCAST_BYTES = 64 << 20
# A key holding at least 1/HOT_SHARE of the rows is spread; there can be at most HOT_SHARE
# such keys and 2 * HOT_SHARE salts, which bounds the broadcast list of hot keys.
HOT_SHARE = 10_000
HOT_MIN_ROWS = 200_000


def fits_broadcast(n_rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    return n_rows * row_bytes <= limit


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: str | Column,
    frequency: DataFrame,
    how: str = "inner",
    hot_min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """``rows`` joined to ``lookup`` (unique in ``key``), hot keys split over several tasks.

    ``frequency`` is a stored ``(key, n_rows)`` table.  A hot key gets as many salts as its
    share needs; its rows pick one by a hash of ``spread`` and its lookup row is repeated
    once per salt, so no task receives much more than 1/HOT_SHARE of the rows for one key."""
    total = frequency.agg(F.sum("n_rows")).first()[0] or 0
    share = F.col("n_rows") * F.lit(HOT_SHARE)
    hot = frequency.where((F.col("n_rows") >= hot_min_rows) & (share >= total)).select(
        key, F.ceil(share / F.lit(max(total, 1))).cast("int").alias("_salts")
    )
    hot = F.broadcast(hot)
    salted_rows = (
        rows.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", F.lit(1))).cast("int"))
        .drop("_salts")
    )
    salted_lookup = (
        lookup.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return salted_rows.join(salted_lookup, [key, "_salt"], how).drop("_salt")


def key_frequency(rows: DataFrame, key: str) -> DataFrame:
    """Stored row counts per key."""
    return materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")), "frequency")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: str | Column,
    row_bytes: int,
    how: str = "inner",
    frequency: DataFrame | None = None,
    n_rows: int | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
    hot_min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Broadcast the lookup when its measured size allows, otherwise ``spread_join``.

    ``lookup`` should be a stored table or derived from one row by row: unless ``n_rows``
    says how many rows it has, it is counted here."""
    if fits_broadcast(lookup.count() if n_rows is None else n_rows, row_bytes, broadcast_limit):
        return rows.join(F.broadcast(lookup), key, how)
    if frequency is None:
        frequency = key_frequency(rows, key)
    return spread_join(rows, lookup, key, spread, frequency, how, hot_min_rows)


def rows_of(rows: DataFrame, ids: DataFrame, key: str, row_bytes: int = 48) -> DataFrame:
    """The rows whose key is among ``ids``, where they are if the ids fit a broadcast."""
    side = F.broadcast(ids) if fits_broadcast(ids.count(), row_bytes) else ids
    return rows.join(side, key, "left_semi")
