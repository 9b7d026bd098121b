"""Removal of every byte that lies in a long string which also starts somewhere else.

All strings of a fixed length are compared by names of their content, in place of the sorting
step of suffix-array refinement: equal strings get equal names in any text, so texts need no
exchange for each doubling.  Eight bytes give a place its first name; the name of twice the length
comes from the names of the place and of the later offset, inside a chunk, whether or not the
place is still shared.  No bucket is sorted or split.  Across texts, two steps compare names:

1. Every string has the same smallest q-gram bucket wherever it starts.  Neighbouring strings
   with the same one form a run.  A run whose bucket is met once in all texts is settled: its
   strings are unique.  A run whose whole stretch of bytes is met twice is settled as well.
2. What is left, near the ends of repeated stretches, is refined to buckets of the full length,
   string by string, together with one copy of each settled run of the same bucket.

A chunk of texts sends the names of its buckets to the parts of the hash space and gets one
byte back for each, so a bucket that occurs everywhere costs one entry per chunk.  Full-length
names have 64 bits and the independent bits of the part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import U64, mix, ranges, slice_hashes, utf8

CHUNK_BYTES = 2 << 20
PART_BYTES = 8 << 20
ASKED = "part long, chunk long, bucket binary, name binary, flags binary"
TOLD = "part long, chunk long, step int, told binary"
TWICE, OFTEN = 1, 2  # flags of a chunk's name: it occurs twice there, its bucket is met twice there
SHARED, ASK = 1, 2  # replies: it occurs twice in all; its strings are to be refined


def refine(name: np.ndarray, offset: int) -> np.ndarray:
    """Bucket names of twice the reach from those of a place and of ``offset`` bytes later."""
    out = name[: len(name) - offset] * U64(0x9E3779B97F4A7C15)
    out ^= out >> U64(29)
    out += name[offset:] * U64(0xD6E8FEB86659FD93)
    out ^= out >> U64(32)
    out *= U64(0xBF58476D1CE4E5B9)
    out ^= out >> U64(31)
    return out


def bucket_names(values: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """For each length (ascending, 8 at least), the bucket names of all places with that many bytes."""
    size, out = 8, []
    padded = np.concatenate([values, np.zeros(8, np.uint8)])
    name = np.ndarray((max(len(values) - 7, 0),), dtype="<u8", buffer=padded, strides=(1,)).astype(U64)
    for length in lengths:
        while 2 * size <= length:
            name = refine(name, size) if len(name) > size else name[:0]
            size *= 2
        rest = length - size
        out.append((refine(name, rest) if len(name) > rest else name[:0]) if rest else name)
    return out


def _window(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


class _Chunk:
    """Buckets and runs of the texts of a chunk."""

    def __init__(self, column: pa.Array, length: int, gram: int):
        self.values, self.offsets = utf8(column)
        self.length = length
        size = np.diff(self.offsets)
        self.start = ranges(self.offsets[:-1], np.maximum(size - length + 1, 0))  # of all strings
        none = np.empty(0, U64)
        if not len(self.start):
            self.gram_key = self.run_key = self.name = none
            self.first = self.size = np.empty(0, np.int64)
            self.often = np.empty(0, dtype=bool)
            return
        grams, self.name = bucket_names(self.values, gram, length)
        width = length - gram + 1
        least = _window(grams, width, np.minimum)[: len(self.values) - length + 1]
        own = least[self.start]
        breaks = np.ones(len(own), dtype=bool)
        breaks[1:] = (own[1:] != own[:-1]) | (self.start[1:] != self.start[:-1] + 1)
        first = np.flatnonzero(breaks)
        size = np.diff(np.append(first, len(own)))
        pieces = -(-size // length)  # long runs are cut, so that two strings cover a piece
        at = ranges(np.zeros(len(first), np.int64), pieces) * length
        self.size = np.minimum(np.repeat(size, pieces) - at, length)
        self.first = np.repeat(first, pieces) + at
        self.gram_key = own[self.first]
        low, high = self.start[self.first], self.start[self.first + self.size - 1]
        self.run_key = mix(self.name[low] + mix(self.name[high] + self.size.astype(U64)))
        # Every place that is the smallest of some string of its text, so that a bucket met
        # twice inside one run counts as shared.
        most = np.zeros(len(self.values) + width, dtype=U64)
        most[self.start + width - 1] = own
        most = _window(most, width, np.maximum)[: len(grams)]
        met = grams[most == grams]

        here, n = np.unique(met, return_counts=True)
        self.often = (n > 1)[np.searchsorted(here, self.gram_key)]  # its bucket is met at two places here

    def runs(self, bits: int) -> dict:
        """The distinct (bucket, run) pairs of the chunk, dealt by the bucket."""
        own = distinct(mix(self.gram_key), self.gram_key, self.run_key, bits)
        often = np.zeros(len(own["n"]), dtype=bool)
        often[own["of"]] = self.often
        return own | {"flags": (own["n"] > 1) * TWICE + often * OFTEN}

    def strings(self, told: np.ndarray, bits: int) -> tuple[np.ndarray, dict]:
        """The strings to refine to full length, and their distinct names."""
        runs = np.flatnonzero(told & ASK)
        of = ranges(self.first[runs], self.size[runs])
        at = self.start[of]
        part = slice_hashes(self.values, at, at + self.length, 3)
        own = distinct(part, np.zeros(len(at), U64), self.name[at], bits)
        return of, own | {"flags": (own["n"] > 1) * TWICE}


def distinct(part: np.ndarray, group: np.ndarray, name: np.ndarray, bits: int) -> dict:
    """Distinct (part, group, name) in order, how often each occurs, and where each value went."""
    part = (part >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(name), np.int64)
    order = np.lexsort((name, group, part))
    part, group, name = part[order], group[order], name[order]
    new = np.ones(len(name), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (group[1:] != group[:-1]) | (part[1:] != part[:-1])
    of = np.empty(len(name), np.int64)
    of[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return {"part": part[first], "group": group[first], "name": name[first], "n": np.diff(np.append(first, len(name))), "of": of}


def _ask(chunk: int, own: dict, grouped: bool) -> pa.Table:
    cut = np.flatnonzero(np.diff(own["part"])) + 1
    first, last = np.concatenate([[0], cut]), np.append(cut, len(own["part"]))
    if not len(own["part"]):
        first = last = np.empty(0, np.int64)
    group, flags = own["group"] if grouped else own["group"][:0], own["flags"].astype(np.uint8)
    cuts = list(zip(first, last, strict=True))
    return pa.table(
        {
            "part": pa.array(own["part"][first], pa.int64()),
            "chunk": pa.array(np.full(len(first), chunk), pa.int64()),
            "bucket": pa.array([group[a:b].tobytes() for a, b in cuts], pa.binary()),
            "name": pa.array([own["name"][a:b].tobytes() for a, b in cuts], pa.binary()),
            "flags": pa.array([flags[a:b].tobytes() for a, b in cuts], pa.binary()),
        }
    )


def _spread(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each element the OR of its group; ``first`` marks where groups begin."""
    starts = np.flatnonzero(first)
    return np.repeat(np.logical_or.reduceat(values, starts), np.diff(np.append(starts, len(values))))


def _tell(step: int):
    def run(table: pa.Table) -> pa.Table:
        names = [np.frombuffer(x, U64) for x in table.column("name").to_pylist()]
        flags = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("flags").to_pylist()])
        name = np.concatenate(names)
        group = np.concatenate([np.frombuffer(x, U64) for x in table.column("bucket").to_pylist()])
        if not len(group):
            group = np.zeros(len(name), U64)
        chunk = np.repeat(table.column("chunk").to_numpy(), [len(x) for x in names])
        order = np.lexsort((chunk, name, group))
        name, group, flags = name[order], group[order], flags[order]
        new_group, new_name = np.ones(len(name), dtype=bool), np.ones(len(name), dtype=bool)
        new_group[1:] = group[1:] != group[:-1]
        new_name[1:] = new_group[1:] | (name[1:] != name[:-1])
        repeated = _spread(~new_name | (flags & TWICE > 0), new_name)
        if step == 0:
            met_twice = _spread(~new_group | (flags & (TWICE | OFTEN) > 0), new_group)
            mixed = _spread(~repeated, new_group)
            reply = repeated * SHARED + (met_twice & mixed & (new_name | ~repeated)) * ASK
        else:
            reply = repeated * SHARED
        told = np.empty(len(name), np.uint8)
        told[order] = reply
        ends = np.cumsum([len(x) for x in names])
        return pa.table(
            {
                "part": table.column("part"),
                "chunk": table.column("chunk"),
                "step": pa.array(np.full(table.num_rows, step), pa.int32()),
                "told": pa.array([told[b - len(x) : b].tobytes() for x, b in zip(names, ends, strict=True)], pa.binary()),
            }
        )

    return run


def _text_of(table: pa.Table) -> pa.Array:
    column = table.column("_text")
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())


def _reply(table: pa.Table, step: int) -> np.ndarray:
    """The replies of a step in the order of the distinct names."""
    steps, part = table.column("step").to_numpy(), table.column("part").to_numpy()
    told = table.column("told").to_pylist()
    some = np.flatnonzero(steps == step)
    found = [np.frombuffer(told[i], np.uint8) for i in some[np.argsort(part[some])]]
    return np.concatenate(found) if found else np.empty(0, np.uint8)


def remove_repeats(
    docs: DataFrame, length: int = 200, id_column: str = "doc_id", text: str = "text", gram: int | None = None
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) per row: the UTF-8 bytes of the text, how many lie
    in a string of ``length`` bytes that also starts anywhere else, those stretches as start,
    end, start, end ..., and the bytes that stay.

    Strings are judged on the input and don't cross rows; overlapping repeats count.  A null
    text is empty, shorter texts than ``length`` lose nothing, repeated rows repeat each other,
    and columns besides id and text are not read."""
    gram = gram or length // 2
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(docs[id_column].alias("_id"), docs[text].cast("binary").alias("_text"))
    total = source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = int(total // PART_BYTES).bit_length()
    chunks = F.lit(max(1, total // CHUNK_BYTES))
    chunked = source.withColumn("chunk", F.pmod(F.xxhash64("_id", "_text"), chunks))

    def first(table: pa.Table) -> pa.Table:
        chunk = _Chunk(_text_of(table), length, gram)
        return _ask(table.column("chunk")[0].as_py(), chunk.runs(bits), True)

    def second(table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = _Chunk(_text_of(table), length, gram)
        told = _reply(replies, 0)[chunk.runs(bits)["of"]]
        number = table.column("chunk")[0].as_py() if table.num_rows else 0
        return _ask(number, chunk.strings(told, bits)[1], False)

    def last(table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = _Chunk(_text_of(table), length, gram)
        told = _reply(replies, 0)[chunk.runs(bits)["of"]]
        of, own = chunk.strings(told, bits)
        repeated = np.zeros(len(chunk.start), dtype=bool)
        repeated[of] = _reply(replies, 1)[own["of"]] & SHARED > 0
        runs = np.flatnonzero(told & SHARED)
        repeated[ranges(chunk.first[runs], chunk.size[runs])] = True
        at = chunk.start[repeated]
        change = np.zeros(len(chunk.values) + 1, dtype=np.int32)
        change[at] += 1
        change[at + length] -= 1
        gone = np.cumsum(change[:-1]) > 0
        offsets, n = chunk.offsets, table.num_rows
        opens, closes = gone.copy(), gone.copy()
        opens[1:] &= ~gone[:-1]
        closes[:-1] &= ~gone[1:]
        inner = offsets[(offsets > 0) & (offsets < len(gone))]
        opens[inner] = gone[inner]
        closes[inner - 1] = gone[inner - 1]
        opens, closes = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        doc = np.searchsorted(offsets, opens, side="right") - 1
        pairs = np.stack([opens - offsets[doc], closes - offsets[doc]], axis=1).reshape(-1).astype(np.int32)
        pair_ends = np.concatenate([[0], np.cumsum(2 * np.bincount(doc, minlength=n))]).astype(np.int32)
        lost = np.concatenate([[0], np.cumsum(gone)])[offsets]
        kept, ends = chunk.values[~gone], offsets - lost
        return pa.table(
            {
                "id": table.column("_id"),
                "n_bytes": np.diff(offsets),
                "n_removed": np.diff(lost).astype(np.int64),
                "spans": pa.ListArray.from_arrays(pa.array(pair_ends), pa.array(pairs)),
                "kept": pa.array([kept[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
            }
        )

    told = chunked.groupBy("chunk").applyInArrow(first, ASKED).groupBy("part").applyInArrow(_tell(0), TOLD)
    asked = chunked.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(second, ASKED)
    told_all = told.union(asked.groupBy("part").applyInArrow(_tell(1), TOLD))
    out = chunked.groupBy("chunk").cogroup(told_all.groupBy("chunk")).applyInArrow(
        last, f"id {kind}, n_bytes long, n_removed long, spans array<int>, kept binary"
    )
    return out.withColumnRenamed("id", id_column)
