"""Groups of texts whose sets of word shingles are similar by Jaccard, found exactly.

Shingles are ordered by rarity, counted over all texts.  A text is indexed only under the
rarest quarter of its shingles (the prefix), with set size and position in that order; a
shingle of one text alone needs no list.  Two ways of leaving work out keep the lists cheap:

* entries of a list are skipped by position: a shared shingle at a place from which the sets
  can no longer reach the needed overlap, or a set of too different a size, gives no candidate;
* answers are taken over from a similar set: each list first compares its entries with one hub.
  Entries that link with the hub are in its group already, so only entries of different groups
  are compared in the second round, which tests all of those.

Equal sets are collapsed before the lists are made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import fits_broadcast
from ..sources.scratch import materialize
from .arrays import LOWER, SPACES, U64, frees, shingles, signed, slice_hashes, utf8, words
from .graph import components

CHUNK_BYTES = 2 << 20
RANGE_BYTES = 16 << 20


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, offsets): the distinct shingles of each text, ascending within a text."""
    values, offsets = utf8(column)
    values = LOWER[values]
    starts, ends, doc = words(values, offsets, SPACES)
    value, doc, _ = shingles(slice_hashes(values, starts, ends), doc, len(column), k)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(column)))])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        value[a:b].sort()
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(column)))])


def _text_of(table: pa.Table) -> pa.Array:
    column = table.column("_text")
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())


def _rarity(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """(chunk, part, levels): the rarity level of each distinct shingle of a chunk in hash order.

    A chunk sends its distinct shingles to the parts of the hash space, 32 bits each (parts
    that differ by the leading bits), and gets back one byte for each: 0 for a shingle of one
    text, then the logarithm of the number of texts.  Two shingles may share the 32 bits; the
    level is then too high for both, which costs a comparison but no result."""

    def send(table: pa.Table) -> pa.Table:
        value, _ = shingle_sets(_text_of(table), k)
        key, count = np.unique(value >> U64(32 - bits), return_counts=True)
        part = (key >> U64(32)).astype(np.int64)
        low, count = (key & U64(0xFFFFFFFF)).astype("<u4"), np.minimum(count, 255).astype(np.uint8)
        cut = np.flatnonzero(np.diff(part)) + 1
        first, last = np.concatenate([[0], cut]), np.append(cut, len(key))
        if not len(key):
            first = last = np.empty(0, np.int64)
        return pa.table(
            {
                "part": pa.array(part[first], pa.int64()),
                "chunk": pa.array(np.full(len(first), table.column("chunk")[0].as_py()), pa.int64()),
                "low": pa.array([low[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
                "n": pa.array([count[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
            }
        )

    def rate(table: pa.Table) -> pa.Table:
        low = [np.frombuffer(x, "<u4") for x in table.column("low").to_pylist()]
        count = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("n").to_pylist()])
        _, place = np.unique(np.concatenate(low), return_inverse=True)
        texts = np.bincount(place, weights=count)
        level = np.ceil(np.log2(texts)).astype(np.uint8)[place]
        ends = np.cumsum([len(x) for x in low])
        return pa.table(
            {
                "part": table.column("part"),
                "chunk": table.column("chunk"),
                "levels": pa.array([level[b - len(x) : b].tobytes() for x, b in zip(low, ends, strict=True)], pa.binary()),
            }
        )

    sent = docs.groupBy("chunk").applyInArrow(frees(send), "part long, chunk long, low binary, n binary")
    return sent.groupBy("part").applyInArrow(frees(rate), "part long, chunk long, levels binary")


def _prefixes(docs: DataFrame, levels: DataFrame, k: int, bits: int, share: int, id_type: str) -> DataFrame:
    """One row per text: id, n, and for those with a shared shingle in the prefix the
    fingerprint of the set, its prefix from the first shared shingle on, and its members."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        value, bounds = shingle_sets(_text_of(table), k)
        order = np.argsort(replies.column("part").to_numpy())
        rated = [np.frombuffer(x, np.uint8) for x in replies.column("levels").to_pylist()]
        rated = np.concatenate([rated[i] for i in order]) if rated else np.empty(0, np.uint8)
        key = value >> U64(32 - bits)
        level = rated[np.searchsorted(np.unique(key), key)] if len(key) else rated
        size = np.diff(bounds)
        prefix = size - -(-size * share // 100) + 1
        alone = np.concatenate([[0], np.cumsum(level == 0)])
        alone = alone[bounds[1:]] - alone[bounds[:-1]]
        f1, f2, first, tokens, members = [], [], [], [], []
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if a == b or alone[i] >= prefix[i]:
                for out in (f1, f2, first, tokens, members):
                    out.append(None)
                continue
            own = value[a:b]
            ranked = own[np.argsort(level[a:b], kind="stable")]
            raw = own.tobytes()
            digest = np.frombuffer(hashlib.blake2b(raw, digest_size=16).digest(), np.int64)
            f1.append(int(digest[0]))
            f2.append(int(digest[1]))
            first.append(int(alone[i]))
            tokens.append(signed(ranked[alone[i] : prefix[i]]))
            members.append(raw)
        return pa.table(
            {
                "id": table.column("_id"),
                "n": pa.array(size.astype(np.int64)),
                "f1": pa.array(f1, pa.int64()),
                "f2": pa.array(f2, pa.int64()),
                "first": pa.array(first, pa.int32()),
                "tokens": pa.array(tokens, pa.list_(pa.int64())),
                "members": pa.array(members, pa.binary()),
            }
        )

    return (
        docs.groupBy("chunk").cogroup(levels.groupBy("chunk"))
        .applyInArrow(frees(run), f"id {id_type}, n long, f1 long, f2 long, first int, tokens array<long>, members binary")
    )


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The candidate pairs (a, b) that link, by the exact sizes of intersection and union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * common >= share * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(frees(run), "a long, b long")


def _possible(share: int):
    """Length and position bounds for columns n, pos and n2, pos2 of a shared shingle."""
    low, high = F.least("n", "n2"), F.greatest("n", "n2")
    left = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    return (low * 100 >= high * share) & (left * (100 + share) >= (low + high) * share)


def similar_groups(
    docs: DataFrame, k: int = 5, share: int = 75, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) per row; texts link when ``share`` percent of the union
    of their shingle sets is common, and a component is what links reach.

    Words are runs without blanks, A-Z in lower case.  A text with fewer than ``k`` words is
    one shingle; an empty or null text has none and links with nothing.  Ids are longs; rows
    of one id are one document and share its component; a row with a null id has no component.
    Equal texts of different ids link.  Other columns are not read."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(docs[id_column].alias("_id"), docs[text].alias("_text"))
    total = source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    chunks = max(1, total // CHUNK_BYTES)
    bits = max(0, int(total // RANGE_BYTES).bit_length())
    chunked = source.withColumn("chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(chunks)))
    sets = materialize(_prefixes(chunked, _rarity(chunked, k, bits), k, bits, share, kind), "shingle-sets")

    shared = sets.where(F.col("f1").isNotNull() & F.col("id").isNotNull())
    classes = materialize(shared.groupBy("f1", "f2", "n").agg(F.min("id").alias("class")), "set-classes")
    chosen = shared.join(classes.select(F.col("class").alias("id"), "f1", "f2"), ["id", "f1", "f2"])
    entries = chosen.select("id", "n", "first", F.posexplode("tokens").alias("at", "token")).select(
        "token", "id", "n", (F.col("first") + F.col("at")).alias("pos")
    )
    listed = entries.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    lists = materialize(entries.join(listed, "token"), "shingle-lists")

    near = lists.withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(100 / share))))
    hubs = near.groupBy("token", "band").agg(F.min(F.struct("id", F.col("n").alias("n2"), F.col("pos").alias("pos2"))).alias("hub"))
    with_hub = near.join(hubs, ["token", "band"]).select("id", "n", "pos", F.col("hub.id").alias("a"), "hub.n2", "hub.pos2")
    tried = materialize(
        with_hub.where((F.col("id") != F.col("a")) & _possible(share)).select("a", F.col("id").alias("b")).distinct(), "hub-pairs"
    )

    def members_of(pairs: DataFrame) -> DataFrame:
        """The sets in a stored table of pairs; the others don't move if the ids are few."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        rows = shared.select("id", "f1", "f2", "members")
        if fits_broadcast(2 * pairs.count(), 16):
            rows = rows.join(F.broadcast(ids), "id", "left_semi")
        return rows.join(classes.select(F.col("class").alias("id"), "f1", "f2"), ["id", "f1", "f2"]).select("id", "members")

    links = materialize(_verified(tried, members_of(tried), share), "hub-links")
    groups = materialize(components(links), "hub-groups")

    grouped = lists.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = grouped.groupBy("token").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p != q")
    open_lists = grouped.join(mixed.select("token"), "token")
    other = open_lists.select(
        "token", F.col("id").alias("b"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("component").alias("component2")
    )
    rest = materialize(
        open_lists.join(other, "token")
        .where((F.col("id") < F.col("b")) & (F.col("component") != F.col("component2")) & _possible(share))
        .select(F.col("id").alias("a"), "b").distinct()
        .join(tried, ["a", "b"], "left_anti"),
        "cross-pairs",
    )
    more = materialize(_verified(rest, members_of(rest), share), "cross-links")
    final = components(links.union(more))

    named = classes.join(final.withColumnRenamed("id", "class"), "class", "left").select(
        "f1", "f2", "n", F.coalesce("component", "class").alias("component")
    )
    linked = sets.select("id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
    return linked.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
