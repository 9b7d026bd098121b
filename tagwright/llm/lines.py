"""Lines that repeat an earlier line, up to one word edit, by deletion neighbourhoods.

Two lines are near when one word put in, left out or exchanged turns one into the other.  Each
line emits its variants with one word deleted as hashed keys:

* with the place of the deletion, so that equal keys mean an exchanged word at that place;
* without it, to be matched with whole lines: equal keys mean one more word.

So an equal key is itself the verified edit distance of the pair, and every line of a key is
near to every other that it is matched with.  The earliest line of a key then speaks for all
of them: the key keeps a minimum, and no pairs are made, however many lines share it.

Before that, a line is left out unless the first or the last half of its words, one of which
must be untouched, occurs in another line; only the other half then needs deletions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .arrays import SPACES, U64, frees, mix, powers, ranges, slice_hashes, utf8, words
from .rounds import ask, column, part_of, replied, reply, sizes, text_of

MIN_WORDS = 5
NEVER = np.iinfo(np.int64).max
SAME, WHOLE, DELETED = 0, 1, 2
HALF_ASKED = "part long, chunk long, key binary, line binary"
HALF_TOLD = "part long, chunk long, shared binary"
KEY_ASKED = "part long, chunk long, key binary, kind binary, doc binary, at binary"
KEY_TOLD = "part long, chunk long, doc binary, at binary"


class _Lines:
    """The lines of a chunk: place, words and the hashes of word ranges."""

    def __init__(self, table: pa.Table, min_words: int):
        self.values, self.offsets = utf8(text_of(table))
        offsets, n = self.offsets, table.num_rows
        breaks = np.flatnonzero(self.values == 10)
        start = np.concatenate([offsets[:-1], breaks + 1])
        doc = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, side="right") - 1])
        order = np.lexsort((start, doc))
        self.start, self.doc = start[order], doc[order]
        self.count = np.bincount(self.doc, minlength=n)
        self.first = np.cumsum(self.count) - self.count
        self.number = np.arange(len(self.doc)) - self.first[self.doc]
        ids = table.column("_id").to_pandas()
        self.id = ids.fillna(NEVER).to_numpy(np.int64)[self.doc] if n else np.empty(0, np.int64)
        at, ends, _ = words(self.values, offsets, SPACES)
        own = np.searchsorted(self.start, at, side="right") - 1
        n_words = np.bincount(own, minlength=len(self.start))
        up, self.down = powers(max(len(at) + 1, len(self.values)))
        self.sums = np.zeros(len(at) + 1, dtype=U64)
        np.cumsum(slice_hashes(self.values, at, ends) * up[: len(at)], out=self.sums[1:])
        self.judged = np.flatnonzero(n_words >= min_words)
        self.n = n_words[self.judged]
        self.word = (np.cumsum(n_words) - n_words)[self.judged]
        self.key = self.span(self.word, self.word + self.n, 0)
        # One line for each distinct sequence of words: the earliest of the chunk.
        place = (self.number[self.judged], self.id[self.judged], self.key)
        order = np.lexsort(place)
        new = np.ones(len(order), dtype=bool)
        new[1:] = self.key[order][1:] != self.key[order][:-1]
        self.one = order[new]
        self.class_of = np.empty(len(order), np.int64)
        self.class_of[order] = np.cumsum(new) - 1

    def raw(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Polynomial of the words a..b-1, as if they came first."""
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def span(self, a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
        return mix(self.raw(a, b) + mix((b - a).astype(U64) + U64(seed << 40)))

    def halves(self):
        """(key, class, whether it is the first half) of the half keys of the distinct lines."""
        word, n = self.word[self.one], self.n[self.one]
        out = []
        for half, use in ((n // 2, slice(None)), ((n - 1) // 2, n % 2 == 0)):
            of, w, size, h = np.arange(len(n))[use], word[use], n[use], half[use]
            out.append((self.span(w, w + h, 1), of, np.ones(len(of), bool)))
            out.append((self.span(w + size - h, w + size, 2), of, np.zeros(len(of), bool)))
        key, of, first = (np.concatenate(x) for x in zip(*out, strict=True))
        return key, of, first

    def variants(self, head: np.ndarray, tail: np.ndarray):
        """(key, kind, class) of the whole line and its deletions for classes that share their
        first half (head) or their last half (tail) with another line."""
        some = np.flatnonzero(head | tail)
        line = self.one[some]
        word, n = self.word[line], self.n[line]
        low = np.where(tail[some], 0, (n - 1) // 2)
        high = np.where(head[some], n, n - (n - 1) // 2)
        of = np.repeat(np.arange(len(some)), high - low)
        i = ranges(low, high - low)
        w, size = word[of], n[of]
        before, after = self.raw(w, w + i), self.sums[w + size] - self.sums[w + i + 1]
        rest = before + after * self.down[w + 1]
        left_out = mix(rest + mix((size - 1).astype(U64) + U64(3 << 40)))
        exchanged = mix(left_out + mix(i.astype(U64) + U64(4 << 40)))
        whole = mix(self.raw(word, word + n) + mix(n.astype(U64) + U64(3 << 40)))
        key = np.concatenate([left_out, exchanged, whole])
        kind = np.concatenate([np.full(len(i), DELETED), np.full(len(i), SAME), np.full(len(some), WHOLE)]).astype(np.uint8)
        return key, kind, np.concatenate([some[of], some[of], some])


def _ordered(part: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    return np.lexsort((*keys[::-1], part))


def deduplicate_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(id, text, n_lines, removed, carried columns) per row: the text without the lines that
    an earlier line repeats, its number of lines and the numbers of those taken out.

    Lines end at a line feed; words are what stands between blanks.  A line goes when an
    earlier one, by id, then line number, has the same words or differs by one word put in,
    left out or exchanged; whether that earlier line itself goes makes no difference.  Lines of
    fewer than ``min_words`` words always stay and remove nothing.  Null ids come last.  Lines
    at one place of rows with the same id are not earlier than each other.  A null text stays
    null and has no line.  Columns that are not carried are not read."""
    carried = F.struct(*[docs[c] for c in carry]) if carry else F.lit(0)
    source = docs.select(docs[id_column].alias("_id"), docs[text].alias("_text"), carried.alias("_carry"))
    chunks, bits = sizes(source)
    # The three rounds read one exchange of these rows.
    dealt = source.withColumn("chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(chunks)))
    number = lambda table: table.column("chunk")[0].as_py() if table.num_rows else 0

    def half_order(lines: _Lines):
        key, of, first = lines.halves()
        part = part_of(key, bits)
        order = _ordered(part, key)
        return part[order], key[order], of[order], first[order]

    def ask_halves(table: pa.Table) -> pa.Table:
        lines = _Lines(table, min_words)
        part, key, of, _ = half_order(lines)
        return ask(number(table), part, key=key, line=lines.key[lines.one][of])

    def tell_halves(table: pa.Table) -> pa.Table:
        key, line = column(table, "key", U64), column(table, "line", U64)
        order = np.lexsort((line, key))
        key, line = key[order], line[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(key))
        several = np.repeat(line[starts] != line[ends - 1], ends - starts)
        shared = np.empty(len(key), np.uint8)
        shared[order] = several
        return reply(table, "key", 8, shared=shared)

    def open_classes(lines: _Lines, replies: pa.Table):
        _, _, of, first = half_order(lines)
        shared = replied(replies, "shared", np.uint8).astype(bool)
        head, tail = np.zeros(len(lines.one), bool), np.zeros(len(lines.one), bool)
        head[of[shared & first]] = True
        tail[of[shared & ~first]] = True
        return head, tail

    def key_order(lines: _Lines, replies: pa.Table):
        key, what, of = lines.variants(*open_classes(lines, replies))
        exact = mix(lines.key[lines.one] + U64(5 << 40))
        key = np.concatenate([exact, key])
        what = np.concatenate([np.zeros(len(exact), np.uint8), what])
        of = np.concatenate([np.arange(len(exact)), of])
        part = part_of(key, bits)
        order = _ordered(part, key)
        return part[order], key[order], what[order], of[order], (order < len(exact))

    def ask_keys(table: pa.Table, replies: pa.Table) -> pa.Table:
        lines = _Lines(table, min_words)
        part, key, what, of, _ = key_order(lines, replies)
        line = lines.judged[lines.one[of]]
        return ask(number(table), part, key=key, kind=what, doc=lines.id[line], at=lines.number[line].astype(np.int32))

    def tell_keys(table: pa.Table) -> pa.Table:
        key, what = column(table, "key", U64), column(table, "kind", np.uint8)
        doc, at = column(table, "doc", np.int64), column(table, "at", np.int32)
        order = np.lexsort((at, doc, what, key))
        key, what, doc, at = key[order], what[order], doc[order], at[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (what[1:] != what[:-1])
        starts = np.flatnonzero(new)  # the earliest of each (key, kind)
        group = np.cumsum(new) - 1
        target = np.arange(len(starts))
        pair = np.zeros(len(starts), dtype=bool)
        pair[:-1] = (key[starts[1:]] == key[starts[:-1]]) & (what[starts[:-1]] == WHOLE) & (what[starts[1:]] == DELETED)
        target[what[starts] != SAME] = -1
        whole = np.flatnonzero(pair)
        target[whole], target[whole + 1] = whole + 1, whole
        of = target[group]
        from_doc = np.where(of >= 0, doc[starts[of]], NEVER)
        from_at = np.where(of >= 0, at[starts[of]], np.iinfo(np.int32).max)
        told_doc, told_at = np.empty(len(key), np.int64), np.empty(len(key), np.int32)
        told_doc[order], told_at[order] = from_doc, from_at
        return reply(table, "key", 8, doc=told_doc, at=told_at)

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        lines = _Lines(table, min_words)
        # Each reply row says to which round it belongs.
        round_of = replies.column("round").to_numpy()
        halves, keys = (replies.take(pa.array(np.flatnonzero(round_of == r))) for r in (0, 1))
        _, _, _, of, exact = key_order(lines, halves)
        doc, at = replied(keys, "doc", np.int64), replied(keys, "at", np.int32)
        n = len(lines.one)
        first_doc, first_at = np.empty(n, np.int64), np.empty(n, np.int64)
        first_doc[of[exact]], first_at[of[exact]] = doc[exact], at[exact]
        earlier = (doc < first_doc[of]) | ((doc == first_doc[of]) & (at < first_at[of]))
        gone_class = np.zeros(n, dtype=bool)
        gone_class[of[earlier & ~exact]] = True
        line, own = lines.judged, lines.class_of
        later = (lines.id[line] > first_doc[own]) | ((lines.id[line] == first_doc[own]) & (lines.number[line] > first_at[own]))
        gone = np.zeros(len(lines.start), dtype=bool)
        gone[line[later | gone_class[own]]] = True
        texts, removed, total = [], [], []
        any_gone = np.bincount(lines.doc[gone], minlength=table.num_rows)
        for i, value in enumerate(text_of(table).to_pylist()):
            total.append(0 if value is None else int(lines.count[i]))
            if not any_gone[i]:
                texts.append(value)
                removed.append([])
                continue
            flags = gone[lines.first[i] : lines.first[i] + lines.count[i]]
            texts.append("\n".join(x for x, g in zip(value.split("\n"), flags, strict=True) if not g))
            removed.append(np.flatnonzero(flags).tolist())
        return pa.table(
            {
                "id": table.column("_id"), "text": pa.array(texts, pa.string()), "n_lines": pa.array(total, pa.int64()),
                "removed": pa.array(removed, pa.list_(pa.int32())), "carry": table.column("_carry"),
            }
        )

    half = dealt.groupBy("chunk").applyInArrow(frees(ask_halves), HALF_ASKED).groupBy("part").applyInArrow(frees(tell_halves), HALF_TOLD)
    keys = dealt.groupBy("chunk").cogroup(half.groupBy("chunk")).applyInArrow(frees(ask_keys), KEY_ASKED)
    told = keys.groupBy("part").applyInArrow(frees(tell_keys), KEY_TOLD)
    both = half.withColumn("round", F.lit(0)).unionByName(told.withColumn("round", F.lit(1)), allowMissingColumns=True)
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_column].dataType), T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
            T.StructField("removed", T.ArrayType(T.IntegerType())), T.StructField("carry", dealt.schema["_carry"].dataType),
        ]
    )
    out = dealt.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(frees(finish), schema)
    rest = [F.col("carry")[c].alias(c) for c in carry]
    return out.select(F.col("id").alias(id_column), F.col("text").alias(text), "n_lines", "removed", *rest)
