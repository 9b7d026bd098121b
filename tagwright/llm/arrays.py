"""Whole texts of an Arrow batch as flat NumPy arrays: bytes, words, shingles, ragged slices.

Every helper works on a bounded block of rows inside one task; Spark partitions the work.
"""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALPHANUMERIC = np.ones(256, dtype=bool)
NOT_ALPHANUMERIC[0x30:0x3A] = False
NOT_ALPHANUMERIC[0x41:0x5B] = False
NOT_ALPHANUMERIC[0x61:0x7B] = False
NOT_ALPHANUMERIC[0x80:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def release() -> None:
    """Give memory that is free inside the worker back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frees(fn: Callable) -> Callable:
    """``fn``, a function of batches, a group or two groups, followed by ``release``."""
    if inspect.isgeneratorfunction(fn):

        def of_batches(batches):
            try:
                yield from fn(batches)
            finally:
                release()

        return of_batches

    def of_group(table):
        try:
            return fn(table)
        finally:
            release()

    def of_groups(left, right):
        try:
            return fn(left, right)
        finally:
            release()

    return of_group if len(inspect.signature(fn).parameters) == 1 else of_groups


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value of each 64-bit value (one-to-one)."""
    x = x.astype(U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    x ^= x >> U64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2^64; kept for the last size."""
    have = next(iter(_powers.values()), None)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        up, down = np.full(size, _BASE, dtype=U64), np.full(size, _BASE_INVERSE, dtype=U64)
        up[0] = down[0] = 1
        _powers.clear()
        have = _powers[0] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece hold about ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = utf8(batch.column(column))[1]
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4))
    offsets = offsets.astype(np.int64)
    start = int(offsets[0])
    size = int(offsets[-1]) - start
    values = np.frombuffer(data, np.uint8, size, start) if size else np.empty(0, np.uint8)
    return values, offsets - start


def text_column(values: np.ndarray, offsets: np.ndarray, kind=pa.string()) -> pa.Array:
    """An Arrow column of the byte slices between offsets (their total must stay below 2 GB)."""
    return pa.Array.from_buffers(
        kind, len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of start, start+1, ... for each (start, length), one after another."""
    lengths = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths)
    return out


def words(values: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """(starts, ends, doc) of the maximal runs without separators; none crosses a text."""
    inside = ~separators[values]
    if not len(inside):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    inner = offsets[(offsets > 0) & (offsets < len(values))]
    opens[inner] = inside[inner]
    closes[inner - 1] = inside[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, doc


def slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte slice, equal for equal slices."""
    up, down = powers(len(values))
    table = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95) + U64(seed))
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(table[values] * up[: len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


def fold(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each k consecutive hashes (positions 0 .. n-k)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out, factor = np.full(n, seed + k, dtype=U64), 1
    for j in range(k):
        factor = factor * _BASE % (1 << 64)
        out += hashes[j : j + n] * U64(factor)
    return mix(out)


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int, seed: int = 0):
    """(shingle, doc, first word) of each k consecutive words; a text of fewer words, but not
    none, gives its whole sequence as one."""
    counts = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(counts) - counts
    whole = fold(hashes, k, seed)
    valid = doc[: len(whole)] == doc[k - 1 : k - 1 + len(whole)] if len(whole) else np.empty(0, bool)
    at = np.flatnonzero(valid)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if not len(short):
        return whole[at], doc[at], at
    value = np.empty(len(short), dtype=U64)
    for size in np.unique(counts[short]):
        here = counts[short] == size
        value[here] = fold(hashes, int(size), seed)[first[short[here]]]
    at_all = np.concatenate([at, first[short]])
    order = np.argsort(at_all, kind="stable")
    return np.concatenate([whole[at], value])[order], np.concatenate([doc[at], short])[order], at_all[order]


def distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, value) pairs, sorted by doc, then value; ``doc`` must be ascending."""
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
