"""Reading quoted CSV files by several tasks, although cells may hold newlines.

Files are read as lines by splits.  The number of quotes before a split says whether it begins
inside a cell: counts per split are a small table, and their running sum per file gives every split's
first state.  A task then puts the lines of its splits together to records.  Only what crosses the
edge of a split, at most one piece at its beginning and one at its end, is exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.lookup import fits_broadcast

QUOTE = '"'
PIECE = "file long, start long, kind int, first boolean, value string"
WHOLE, HEAD, TAIL, CLOSED_HEAD = 0, 1, 2, 3


def _splits(lines: DataFrame) -> DataFrame:
    """``(file, start, inside)`` for every split that begins a line."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes: dict[tuple[int, int], int] = {}
        for batch in batches:
            file, start = np.asarray(batch.column("file")), np.asarray(batch.column("start"))
            n = np.asarray(pc.count_substring(batch.column("value"), QUOTE)).astype(np.int64)
            cut = np.flatnonzero(np.append(True, (np.diff(file) != 0) | (np.diff(start) != 0)))
            for a, total in zip(cut, np.add.reduceat(n, cut), strict=True):
                key = int(file[a]), int(start[a])
                quotes[key] = quotes.get(key, 0) + int(total)
        keys = list(quotes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(quotes.values()), pa.int64())],
            names=["file", "start", "quotes"],
        )

    counted = lines.mapInArrow(count, "file long, start long, quotes long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Open:
    """The record a split is in the middle of, and whether it began before the split."""

    def __init__(self, key: tuple[int, int], inside: bool):
        self.key, self.inside, self.from_before, self.lines = key, inside, inside, []
        self.first = key[1] == 0  # the next record is the first of the file


def _records(values: pa.Array, state: _Open) -> Iterator[tuple[int, bool, pa.Array]]:
    """(kind, first of its file, records) that end within these lines of one split."""
    odd = (np.asarray(pc.count_substring(values, QUOTE)).astype(np.int64).cumsum() + state.inside) % 2 == 1
    ends = np.flatnonzero(~odd)
    done = 0
    single: list[int] = []
    for end in ends.tolist() if state.lines or state.inside or odd.any() else []:
        if end == done and not state.lines and not state.from_before:
            single.append(end)
            done = end + 1
            continue
        text = "\n".join(state.lines + values.slice(done, end - done + 1).to_pylist())
        if single:
            yield WHOLE, state.first, values.take(pa.array(single))
            single, state.first = [], False
        yield (CLOSED_HEAD if state.from_before else WHOLE), state.first and not state.from_before, pa.array([text], pa.string())
        state.first = state.first and state.from_before
        state.lines, state.from_before, done = [], False, end + 1
    if len(ends) and not done and not single:  # every line is a record
        yield WHOLE, state.first, values
        state.first, done = False, len(values)
    elif single:
        yield WHOLE, state.first, values.take(pa.array(single))
        state.first = False
    state.lines += values.slice(done).to_pylist()
    state.inside = bool(odd[-1]) if len(odd) else state.inside


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(first, value)``: the records of the files as texts, line ends inside cells kept; ``first`` marks
    the first record of a file.  Quotes stand around cells and, doubled, inside them."""
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    known = _splits(lines).orderBy("file", "start").toArrow()  # 17 bytes a split
    if not fits_broadcast(known.num_rows, 17):
        raise ValueError(f"{known.num_rows} splits: raise spark.sql.files.maxPartitionBytes")
    places = {k: i for i, k in enumerate(zip(known.column("file").to_pylist(), known.column("start").to_pylist(), strict=True))}
    inside = known.column("inside").to_pylist()
    sent = spark.sparkContext.broadcast((places, inside))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, state = sent.value, None

        def piece(kind: int, first: bool, values: pa.Array) -> pa.RecordBatch:
            n = len(values)
            marks = np.zeros(n, bool)
            marks[:1] = first
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, state.key[0])), pa.array(np.full(n, state.key[1])), pa.array(np.full(n, kind, np.int32)),
                    pa.array(marks), values,
                ],
                names=["file", "start", "kind", "first", "value"],
            )

        def rest():
            if state is not None and state.lines:
                kind = HEAD if state.from_before else TAIL
                yield piece(kind, state.first and not state.from_before, pa.array(["\n".join(state.lines)], pa.string()))

        for batch in batches:
            file, start = np.asarray(batch.column("file")), np.asarray(batch.column("start"))
            cut = np.flatnonzero(np.append(True, (np.diff(file) != 0) | (np.diff(start) != 0))).tolist() if batch.num_rows else []
            for a, b in zip(cut, cut[1:] + [batch.num_rows], strict=True):
                key = int(file[a]), int(start[a])
                if state is None or state.key != key:
                    yield from rest()
                    if key not in begins[0]:
                        raise RuntimeError("the files were split differently from one pass to the next")
                    state = _Open(key, begins[1][begins[0][key]])
                for kind, first, values in _records(batch.column("value").slice(a, b - a), state):
                    yield piece(kind, first, values)
        yield from rest()

    pieces = lines.mapInArrow(assemble, PIECE)
    whole = pieces.where(F.col("kind") == WHOLE).select("first", "value")
    # a record that crosses splits: its tail, then what the next splits begin with
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == TAIL)
    crossing = pieces.where(F.col("kind") != WHOLE).withColumn(
        "from", F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(order)
    )
    parts = F.array_sort(F.collect_list(F.struct("start", (F.col("kind") != TAIL).alias("later"), "value")))
    joined = crossing.groupBy("file", "from").agg(F.max("first").alias("first"), parts.alias("p"))
    ends = joined.select("first", F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"))
    return whole.unionByName(ends)
