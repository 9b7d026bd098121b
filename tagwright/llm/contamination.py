"""Benchmark passages in documents: a prefix-filtered containment join.

The sets are the item windows: 13 consecutive words of a benchmark item, or the whole item if
it is shorter.  Containment must be complete, so one necessary token is enough of a prefix:
each window is indexed under its rarest shingle, by counts over all documents.  A document
shingle that equals it fixes where the window would start; position and length bounds drop
starts outside the document, and the words of the rest are compared one by one.

The benchmark is the query set.  Its windows are dealt into blocks of bounded size; each block
is sent to the tasks that read the documents, which are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import materialize
from .arrays import LOWER, NOT_ALPHANUMERIC, U64, blocks, fold, frees, ranges, signed, slice_hashes, utf8, words

SHINGLE = 5
BLOCK_WINDOWS = 100_000  # about 25 MB as arrays
FILTER_BITS = 22
SPANS = "spans array<int>, items array<string>"


def _word_hashes(block: pa.RecordBatch):
    values, offsets = utf8(block.column("_text"))
    values = LOWER[values]
    starts, ends, doc = words(values, offsets, NOT_ALPHANUMERIC)
    return slice_hashes(values, starts, ends), doc


def item_windows(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """Distinct windows as (words array<long>, items array<string>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_text"):
            hashes, doc = _word_hashes(block)
            names = block.column("_id").to_pylist()
            counts = np.bincount(doc, minlength=block.num_rows)
            first = np.cumsum(counts) - counts
            rows, ids = [], []
            for i in np.flatnonzero(counts):
                own = signed(hashes[first[i] : first[i] + counts[i]])
                for j in range(max(1, len(own) - size + 1)):
                    rows.append(own[j : j + size])
                    ids.append(names[i])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64())), pa.array(ids, pa.string())], names=["words", "item"])

    source = items.select(F.coalesce(items[item_id].cast("string"), F.lit("")).alias("_id"), items[text].alias("_text"))
    found = source.mapInArrow(frees(run), "words array<long>, item string")
    return found.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _Lookup:
    """Places of hashes in a sorted list, behind a bit table that most hashes don't pass."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.seen[keys & U64((1 << FILTER_BITS) - 1)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in hashes, indexes of keys)."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.seen[hashes & U64((1 << FILTER_BITS) - 1)])
        key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[key] == hashes[at]
        return at[same], key[same]


def _tokens(window: np.ndarray) -> np.ndarray:
    return fold(window, min(SHINGLE, len(window)))


def _token_hashes(hashes: np.ndarray, doc: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """(word positions, token hashes) of the documents for each token size in use."""
    for size in sizes:
        value = fold(hashes, size)
        at = np.flatnonzero(doc[: len(value)] == doc[size - 1 :]) if len(value) else np.empty(0, np.int64)
        yield at, value[at]


def _counts(docs: DataFrame, keys: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """How often each token of a window block occurs in all documents."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        total = np.zeros(len(lookup.keys), dtype=np.int64)
        for block in blocks(batches, "_text"):
            hashes, doc = _word_hashes(block)
            for _, values in _token_hashes(hashes, doc, sizes):
                total += np.bincount(lookup.find(values)[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["key", "n"])

    counted = docs.mapInArrow(frees(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    found = {r.key: r.n for r in counted.collect()}  # at most the tokens of one block
    shared.unpersist()
    return found


def _index(rows: list, docs: DataFrame) -> dict:
    """The arrays of one window block, sorted by each window's rarest token."""
    windows = [np.array(r.words, dtype=np.int64).view(U64) for r in rows]
    tokens = [_tokens(w) for w in windows]
    keys = np.unique(np.concatenate(tokens))
    sizes = sorted({min(SHINGLE, len(w)) for w in windows})
    counts = np.zeros(len(keys), dtype=np.int64)
    for key, n in _counts(docs, keys, sizes).items():
        counts[key] = n
    best, shift = [], []
    for own in tokens:
        order = np.lexsort((own, counts[np.searchsorted(keys, own)]))
        best.append(own[order[0]])
        shift.append(order[0])
    order = np.argsort(np.array(best, dtype=U64), kind="stable")
    length = np.array([len(w) for w in windows], dtype=np.int64)[order]
    names = [rows[i].items for i in order]
    prefix, first = np.unique(np.array(best, dtype=U64)[order], return_index=True)
    return {
        "prefix": prefix, "first": first, "per_prefix": np.diff(np.append(first, len(order))),
        "shift": np.array(shift, dtype=np.int64)[order], "length": length,
        "words": np.concatenate([windows[i] for i in order]), "start": np.cumsum(length) - length,
        "names": names, "sizes": sizes,
    }


def _occurrences(index: dict, lookup: _Lookup, hashes: np.ndarray, doc: np.ndarray):
    """(window, first word) of every occurrence of a window in the block of documents."""
    found_window, found_start = [], []
    for at, values in _token_hashes(hashes, doc, index["sizes"]):
        place, key = lookup.find(values)
        repeat = index["per_prefix"][key]
        window = ranges(index["first"][key], repeat)
        start = np.repeat(at[place], repeat) - index["shift"][window]
        end = start + index["length"][window]
        inside = (start >= 0) & (end <= len(hashes))
        window, start, end = window[inside], start[inside], end[inside]
        inside = doc[start] == doc[end - 1]
        window, start = window[inside], start[inside]
        length = index["length"][window]
        same = hashes[ranges(start, length)] == index["words"][ranges(index["start"][window], length)]
        whole = np.logical_and.reduceat(same, np.cumsum(length) - length) if len(length) else np.empty(0, bool)
        found_window.append(window[whole])
        found_start.append(start[whole])
    return np.concatenate(found_window), np.concatenate(found_start)


def _scan(docs: DataFrame, index: dict) -> DataFrame:
    """``docs`` (_id, _text, n_words, n_hit, spans, items, _carry) with a block's hits added."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        lookup = _Lookup(index["prefix"])
        for block in blocks(batches, "_text"):
            n = block.num_rows
            hashes, doc = _word_hashes(block)
            counts = np.bincount(doc, minlength=n)
            first = np.cumsum(counts) - counts
            window, start = _occurrences(index, lookup, hashes, doc)
            hit = np.zeros(len(hashes), dtype=bool)
            hit[ranges(start, index["length"][window])] = True
            spans = block.column("spans")
            flat, ends = spans.flatten().to_numpy(zero_copy_only=False), np.diff(np.asarray(spans.offsets)) // 2
            of = np.repeat(np.arange(n), ends)
            hit[ranges(first[of] + flat[0::2], flat[1::2] - flat[0::2])] = True
            opens, closes = hit.copy(), hit.copy()
            if len(hit):
                edge = doc[1:] != doc[:-1]
                opens[1:] &= ~hit[:-1] | edge
                closes[:-1] &= ~hit[1:] | edge
            opens, closes = np.flatnonzero(opens), np.flatnonzero(closes)
            of = doc[opens]
            pairs = np.stack([opens - first[of], closes + 1 - first[of]], axis=1).reshape(-1).astype(np.int32)
            span_ends = np.concatenate([[0], np.cumsum(2 * np.bincount(of, minlength=n))]).astype(np.int32)
            names = block.column("items").to_pylist()
            for i, w in set(zip(doc[start].tolist(), window.tolist(), strict=True)):
                names[i] = [*names[i], *index["names"][w]]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("_id"), block.column("_text"), pa.array(counts.astype(np.int64)),
                    pa.array(np.bincount(doc[hit], minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(span_ends), pa.array(pairs)),
                    pa.array([sorted(set(x)) for x in names], pa.list_(pa.string())), block.column("_carry"),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(frees(run), schema)


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    size: int = 13,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_windows: int = BLOCK_WINDOWS,
    carry: tuple[str, ...] = (),
    keep_text: bool = False,
) -> DataFrame:
    """(id, n_words, n_hit, spans, items, carried columns) per document row: its words, those inside an
    occurrence of an item window, the hit word ranges as start, end, start, end ..., and the
    ids of the items found, as strings in their order; also the text, if it is kept.

    Null and empty texts have no words and no hits; an item without words has no window; a
    null item id counts as ''.  Repeated rows are judged one by one, equal windows of several
    items count for each of them, and columns that are not carried are not read.  Without
    any window nothing is hit."""
    windows = materialize(item_windows(items, item_id, item_text, size), "windows")
    n_blocks = max(1, -(-windows.count() // block_windows))
    carried = F.struct(*[docs[c] for c in carry]) if carry else F.lit(0)
    out = docs.select(
        docs[id_column].alias("_id"), docs[text].alias("_text"), F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("items"), carried.alias("_carry"),
    )
    texts = docs.select(docs[text].alias("_text"))
    for i in range(n_blocks):
        rows = windows.where(F.pmod(F.hash("words"), F.lit(n_blocks)) == i).collect()  # one bounded block
        if rows:
            index = _index(rows, texts)
        else:
            none = np.empty(0, np.int64)
            index = {"prefix": none.view(U64), "first": none, "per_prefix": none, "shift": none, "length": none, "words": none.view(U64), "start": none, "names": [], "sizes": [SHINGLE]}
        out = _scan(out, index)
        if i + 1 < n_blocks:
            out = materialize(out, "hits")
    rest = [F.col("_carry")[c].alias(c) for c in carry]
    rest += [F.col("_text").alias(text)] if keep_text else []
    return out.select(F.col("_id").alias(id_column), "n_words", "n_hit", "spans", "items", *rest)


def contaminated(n_hit, n_words, share: int = 20):
    """The rule: some hit words, and at least one word in ``share`` is one."""
    return (n_hit > 0) & (n_hit * share >= n_words)
