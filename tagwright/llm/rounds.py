"""Questions from chunks of texts to parts of a hash space, and the replies.

A chunk packs the values it asks about into one binary array per part; a part sees what all
chunks ask and replies with one array per chunk, in the order asked.  The number of values a
part holds for one key is at most one per chunk, however often the key occurs in the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import U64, mix

CHUNK_BYTES = 2 << 20
PART_BYTES = 8 << 20


def sizes(source: DataFrame, text: str = "_text") -> tuple[int, int]:
    """(number of chunks, bits of the part number) for a table of texts."""
    total = source.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, total // CHUNK_BYTES), int(total // PART_BYTES).bit_length()


def text_of(table: pa.Table, kind=pa.string()) -> pa.Array:
    column = table.column("_text")
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], kind)


def part_of(key: np.ndarray, bits: int) -> np.ndarray:
    return (mix(key) >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)


def ask(chunk: int, part: np.ndarray, **arrays: np.ndarray) -> pa.Table:
    """One row per part; ``part`` must be ascending."""
    cut = np.flatnonzero(np.diff(part)) + 1
    first, last = (np.concatenate([[0], cut]), np.append(cut, len(part))) if len(part) else (cut, cut)
    columns = {
        "part": pa.array(part[first], pa.int64()),
        "chunk": pa.array(np.full(len(first), chunk), pa.int64()),
    }
    for name, values in arrays.items():
        columns[name] = pa.array([values[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary())
    return pa.table(columns)


def column(table: pa.Table, name: str, kind) -> np.ndarray:
    """The arrays of all rows, one after another."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def replied(table: pa.Table, name: str, kind) -> np.ndarray:
    """The replies to a chunk, in the order of its questions."""
    order = np.argsort(table.column("part").to_numpy(), kind="stable")
    return column(table.take(pa.array(order)), name, kind)


def reply(table: pa.Table, asked: str, width: int, **arrays: np.ndarray) -> pa.Table:
    """A row for each row asked, with its share of each array; ``width`` is the bytes of a
    value of the column ``asked``."""
    ends = np.cumsum([len(x) // width for x in table.column(asked).to_pylist()])
    first = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    columns = {"part": table.column("part"), "chunk": table.column("chunk")}
    for name, values in arrays.items():
        columns[name] = pa.array([values[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())
    return pa.table(columns)
