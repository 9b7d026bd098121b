"""The best few rows of every key, without sorting the table.

Each task keeps at most k rows of a key while its batches pass; what the tasks kept is merged per
key in two steps, so a merge reads about the square root of the number of tasks times k rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def best_rows(table: pa.Table, key: str, order: list[str], k: int, largest: bool = False) -> pa.Table:
    """The first k rows of each key by the first column of ``order``, descending if ``largest``, then
    by the others ascending.  Rows without a value in the first come last."""
    if not table.num_rows or k <= 0:
        return table.slice(0, 0)
    directions = ["descending" if largest else "ascending"] + ["ascending"] * (len(order) - 1)
    keys = [(key, "ascending"), *zip(order, directions, strict=True)]
    table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_end"))
    code = np.asarray(table.column(key).combine_chunks().dictionary_encode().indices.fill_null(-1))
    first = np.flatnonzero(np.append(True, np.diff(code) != 0))
    rank = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
    return table.filter(pa.array(rank < k))


def kept_rows(batches: Iterator[pa.Table], key: str, order: list[str], k: int, largest: bool = False) -> pa.Table | None:
    """``best_rows`` of all batches, one after another."""
    kept = None
    for table in batches:
        own = best_rows(table, key, order, k, largest)
        kept = own if kept is None else best_rows(pa.concat_tables([kept, own]), key, order, k, largest)
    return kept


def merge_best(candidates: DataFrame, key: str, order: list[str], k: int, largest: bool = False) -> DataFrame:
    """The best rows per key of rows that are already at most k per key and task.

    ``candidates`` has a column ``_task``, the number of its task; the result doesn't."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = kept_rows((pa.Table.from_batches([b]) for b in batches), key, order, k, largest)
        if kept is not None:
            yield from kept.to_batches()

    lots = math.isqrt(int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if lots > 1:
        lot = F.pmod(F.col("_task"), F.lit(lots))
        candidates = candidates.groupBy(key, lot).applyInArrow(merge, candidates.schema)
    return candidates.groupBy(key).applyInArrow(merge, candidates.schema).drop("_task")


def top_k_per_key(
    rows: DataFrame, key: str, k: int, order: str, tie: str = "id", largest: bool = False
) -> DataFrame:
    """The k rows with the smallest (or largest) ``order`` of every ``key``; equal ones by ``tie``."""
    tagged = rows.withColumn("_task", F.spark_partition_id())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = kept_rows((pa.Table.from_batches([b]) for b in batches), key, [order, tie], k, largest)
        if kept is not None:
            yield from kept.to_batches()

    return merge_best(tagged.mapInArrow(keep, tagged.schema), key, [order, tie], k, largest)
