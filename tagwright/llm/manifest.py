"""Merkle manifest of a document table, and an audit of every leaf by a recursive query.

Each row is a leaf: the digest of its five columns.  The leaves of a language, in order of their
ids, are folded eight at a time until one node is left, the language's subroot; subroots in order
of language are folded the same way into the root.  Every run of up to eight nodes is stored as one
row that holds their digests and the place of their parent.

The audit climbs from all leaves at once in one ``WITH RECURSIVE`` query: a step joins each leaf's
current place with its run, emits the siblings there and folds the leaf's digest, which may come
from a tampered row, into the parent's place.  A run high up has many leaves beneath it, so it is
stored once for each block of 4,096 leaves and no key of the join gathers more than a block.

Places are found without a window over a language: rows are sorted by range, and a row's place is
its offset in its range plus the rows of its language in earlier ranges.

Defined results for odd rows: a null column counts as ``-``; null ids come first in their language
and are never tampered with; rows of one id follow each other by digest, equal rows are leaves of
their own; a null language is a language and comes first; an empty table has no rows and no root.
Empty and very long texts are ordinary values, and other columns don't matter.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.lookup import fits_broadcast, lookup_join
from ..sources.scratch import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 3  # eight nodes to a run
BLOCK_LEVELS = 4  # levels below the top of a block: 8 ** 4 leaves
BLOCK_BITS = BITS * BLOCK_LEVELS
TOP = -1  # number of the tree of subroots
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CLIMB = """
WITH RECURSIVE climb(uid, tree, block, step, idx, folded, siblings, subroot, doc_id, leaf) AS (
  SELECT uid, tree, block, 0, idx, changed, CAST(NULL AS BINARY), CAST(NULL AS BINARY), doc_id, leaf FROM {leaves}
  UNION ALL
  SELECT c.uid, c.tree, c.block, c.step + 1, r.up,
    unhex(sha2(lower(hex(concat(
      substring(r.members, 1, 32 * CAST(c.idx & 7 AS INT)), c.folded,
      substring(r.members, 33 + 32 * CAST(c.idx & 7 AS INT))))), 256)),
    concat(substring(r.members, 1, 32 * CAST(c.idx & 7 AS INT)), substring(r.members, 33 + 32 * CAST(c.idx & 7 AS INT))),
    r.subroot, CAST(NULL AS BIGINT), CAST(NULL AS BINARY)
  FROM climb c JOIN {runs} r
    ON c.tree = r.tree AND c.block = r.block AND c.step = r.step AND shiftright(c.idx, 3) = r.run)
SELECT uid, step, folded, siblings, subroot, doc_id, leaf FROM climb
"""


@dataclass(frozen=True)
class Manifest:
    """``leaves``: uid, doc_id, tree, idx, height, leaf, changed.  ``runs``: tree, level, height,
    run, members (digests in order), parent (digest).  ``root`` is hex, None for an empty table."""

    leaves: DataFrame
    runs: DataFrame
    root: str | None


def digest(*values: Column) -> Column:
    """sha256 in hex of the values one after another; ``-`` for null, else length, colon, value."""
    parts = []
    for value in values:
        value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def lower_text(docs: DataFrame) -> Column:
    """The text of a tampered row: A-Z in lower case where 3 divides the crc32 of the id."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def _height(n: Column) -> Column:
    """Levels of runs above n nodes: octal digits of n - 1."""
    return F.when(n > 1, F.length(F.conv((n - 1).cast("string"), 10, 8))).otherwise(0).cast("int")


def _in_order(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(rows sorted by range with ``seq`` and ``part``, spans): a span says of the rows of one group in
    one range what ``seq`` is first, how many of the group are before, and how many there are in all."""
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    seq = F.monotonically_increasing_id()
    dealt = materialize(sorted_rows.withColumn("seq", seq).withColumn("part", F.shiftright("seq", 33)), name)
    spans = dealt.groupBy(group, "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("here"))
    ranges = Window.partitionBy(group)
    before = F.sum("here").over(ranges.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(
        group, "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("here").over(ranges).alias("n")
    )
    return dealt, materialize(spans, f"{name}-spans")


def _placed(dealt: DataFrame, spans: DataFrame, group: str) -> DataFrame:
    """The rows with their place ``idx`` in the group and the other columns of their span."""
    spans = spans.withColumnRenamed(group, "_group").withColumnRenamed("part", "_part")
    if fits_broadcast(spans.count(), 120):
        spans = F.broadcast(spans)
    same = (dealt["part"] == spans["_part"]) & dealt[group].eqNullSafe(spans["_group"])
    return dealt.join(spans, same).withColumn("idx", F.col("seq") - F.col("first") + F.col("before"))


def _fold(nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Stored runs of each level; ``nodes``: tree, height, idx, hash (hex)."""
    levels = []
    for level in range(height):
        ordered = F.array_sort(F.collect_list(F.struct("idx", "hash")))
        joined = F.array_join(F.transform(ordered, lambda x: x["hash"]), "")
        runs = (
            nodes.where(F.col("height") > level)
            .groupBy("tree", "height", F.shiftright("idx", BITS).alias("run"))
            .agg(joined.alias("_members"))
            .select(
                "tree", F.lit(level).alias("level"), "height", "run",
                F.unhex("_members").alias("members"), F.unhex(F.sha2("_members", 256)).alias("parent"),
            )
        )
        levels.append(materialize(runs, f"{name}-{level}"))
        nodes = levels[-1].select("tree", "height", F.col("run").alias("idx"), F.lower(F.hex("parent")).alias("hash"))
    return levels


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return out


def build_manifest(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """The tree over ``docs`` (columns doc_id, source, lang, n_chars, text).  ``tampered`` is the text
    a row is audited with, by default its own."""
    values = [F.col(c) for c in FIELDS]
    tampered = F.col("text") if tampered is None else tampered
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "lang",
            F.unhex(digest(*values)).alias("leaf"), F.unhex(digest(*values[:-1], tampered)).alias("changed"),
        ).withColumn("uid", F.monotonically_increasing_id()),
        "manifest-leaves",
    )
    dealt, spans = _in_order(rows, "lang", ["doc_id", "leaf", "changed", "uid"], "manifest-order")
    langs = spans.select("lang", "n").distinct().withColumn("all", F.lit(0))
    trees = _placed(*_in_order(langs, "all", ["lang"], "manifest-langs"), "all").select(
        F.col("lang").alias("_lang"), F.col("idx").alias("tree")
    )
    n_trees = trees.count()
    trees = F.broadcast(trees) if fits_broadcast(n_trees, 80) else trees
    spans = materialize(
        spans.join(trees, spans["lang"].eqNullSafe(F.col("_lang"))).drop("_lang").withColumn("height", _height(F.col("n"))),
        "manifest-spans",
    )
    leaves = materialize(
        _placed(dealt, spans, "lang").select("uid", "doc_id", "tree", "idx", "height", "leaf", "changed"), "manifest-placed"
    )
    highest = spans.agg(F.max("height")).first()[0] or 0
    hashes = leaves.select("tree", "height", "idx", F.lower(F.hex("leaf")).alias("hash"))
    levels = _fold(hashes, highest, "manifest-level")
    tops = [leaves.where("height = 0").select("tree", F.col("leaf").alias("hash"))]
    tops += [x.where("level = height - 1").select("tree", F.col("parent").alias("hash")) for x in levels]
    tops = _union(tops)
    above = len(f"{n_trees - 1:o}") if n_trees > 1 else 0
    subroots = tops.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(above).alias("height"), F.col("tree").alias("idx"),
        F.lower(F.hex("hash")).alias("hash"),
    )
    upper = _fold(subroots, above, "manifest-top")
    last = upper[-1].select(F.lower(F.hex("parent"))) if upper else subroots.select("hash")
    root = last.first()
    runs = _union(levels + upper) if levels + upper else None
    if runs is None:  # one leaf or none: there is nothing to climb
        empty = "tree bigint, level int, height int, run bigint, members binary, parent binary"
        runs = docs.sparkSession.createDataFrame([], empty)
    return Manifest(leaves, runs, root[0] if root else None)


def _by_block(manifest: Manifest) -> DataFrame:
    """The runs as the climb meets them: tree, block, step, run, up, members, subroot.  A run over
    more than a block, and every run of subroots, is repeated for each block beneath it."""
    runs = manifest.runs
    above = runs.where(F.col("tree") == TOP).agg(F.max("height")).first()[0] or 0
    own = F.col("tree") != TOP
    is_last = F.col("level") == F.col("height") - 1
    low = runs.where(own & (F.col("level") < BLOCK_LEVELS)).select(
        "tree",
        F.expr(f"shiftright(run, {BLOCK_BITS} - {BITS} * (level + 1))").alias("block"),
        F.col("level").alias("step"), "run",
        F.when(is_last, F.col("tree")).otherwise(F.col("run")).alias("up"),
        "members", F.when(is_last, F.col("parent")).alias("subroot"),
    )
    blocks = runs.where(own & (F.col("level") == BLOCK_LEVELS - 1)).select("tree", F.col("run").alias("block"), "height")
    small = manifest.leaves.where((F.col("idx") == 0) & (F.col("height") < BLOCK_LEVELS))
    blocks = blocks.unionByName(small.select("tree", F.lit(0).cast("long").alias("block"), "height"))
    first = F.least(F.col("height"), F.lit(BLOCK_LEVELS))
    steps = blocks.where(first < F.col("height") + above).withColumn(
        "step", F.explode(F.sequence(first, F.col("height") + above - 1))
    )
    inside = F.col("step") < F.col("height")
    level = F.when(inside, F.col("step")).otherwise(F.col("step") - F.col("height"))
    run = F.when(inside, F.expr(f"shiftright(block, {BITS} * (step - {BLOCK_LEVELS - 1}))")).otherwise(
        F.expr(f"shiftright(tree, {BITS} * (step - height + 1))")
    )
    wanted = steps.select(
        "tree", "block", "step", run.alias("run"),
        F.concat_ws(":", F.when(inside, F.col("tree")).otherwise(TOP), level, run).alias("at"),
    )
    high = runs.where(~own | (F.col("level") >= BLOCK_LEVELS)).select(
        F.concat_ws(":", "tree", "level", "run").alias("at"),
        F.when(is_last & own, F.col("tree")).otherwise(F.col("run")).alias("up"),
        "members", F.when(is_last & own, F.col("parent")).alias("subroot"),
    )
    repeated = lookup_join(wanted, materialize(high, "manifest-high"), "at", F.struct("tree", "block"), 400)
    return materialize(low.unionByName(repeated.drop("at")), "manifest-climb")


@contextmanager
def _unlimited(spark: SparkSession):
    """Without Spark's default limits of a recursive query (a million rows, a hundred steps)."""
    names = ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit")
    old = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "-1")
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def audit(manifest: Manifest) -> DataFrame:
    """A row for each leaf: doc_id, leaf, subroot, root, proof_sha256 (all of the untampered table),
    folded_root (from the tampered leaf and the stored siblings) and verified."""
    spark = manifest.leaves.sparkSession
    start = manifest.leaves.select(
        "uid", "doc_id", "tree", F.shiftright("idx", BLOCK_BITS).alias("block"),
        F.when(F.col("height") == 0, F.col("tree")).otherwise(F.col("idx")).alias("idx"), "leaf", "changed",
    )
    runs = _by_block(manifest)
    with _unlimited(spark):
        climbed = spark.sql(CLIMB, leaves=start, runs=runs)
        path = F.array_sort(F.collect_list(F.struct("step", "folded", "siblings")))
        each = climbed.groupBy("uid").agg(
            F.max("doc_id").alias("doc_id"), F.max("leaf").alias("leaf"), F.max("subroot").alias("subroot"), path.alias("path")
        )
        siblings = F.array_join(F.transform("path", lambda x: F.lower(F.hex(x["siblings"]))), "")
        text = lambda c: F.lower(F.hex(c))
        found = materialize(
            each.select(
                "doc_id", text("leaf").alias("leaf"), text(F.coalesce("subroot", "leaf")).alias("subroot"),
                F.lit(manifest.root).cast("string").alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
                text(F.element_at("path", -1)["folded"]).alias("folded_root"),
            ),
            "manifest-audit",
        )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
