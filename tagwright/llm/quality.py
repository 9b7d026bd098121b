"""Text quality by an interpolated modified Kneser-Ney model of byte 4-grams.

The model is trained on trusted texts.  Its counts grow with them and are never gathered in one
place: 4-grams are dealt to shards by their two middle bytes.  A shard then holds, for its
4-grams, the counts, the weight of each history of three bytes and the lower-order
probabilities of the last three bytes; orders two and one are a table of 256 x 256.  A chunk of
texts asks the shards about its distinct 4-grams and joins the replies with its texts.

A text is kept when its cross entropy is at most a quantile of the trusted texts of its
language.  For that to mean the same for trusted and other texts, the ids fall into two halves
with a model each, and every text is scored by the model of the other half.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.lookup import lookup_join
from ..sources.scratch import materialize
from .arrays import U64, ranges, utf8
from .rounds import ask, column, part_of, replied, reply, sizes, text_of

BINS = 1000  # of a nat, for the quantiles
START = 0x0A  # stands before every text
ASKED = "part long, chunk long, gram binary, n binary"
TOLD = "part long, chunk long, logp binary"


def grams(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 4-gram (as a number) for each byte of the texts, with three start bytes before each."""
    n = len(offsets) - 1
    padded = np.full(len(values) + 3 * n, START, dtype=np.uint32)
    size = np.diff(offsets)
    at = ranges(offsets[:-1] + 3 * np.arange(1, n + 1), size)
    padded[at] = values
    return (padded[at - 3] << np.uint32(24)) | (padded[at - 2] << np.uint32(16)) | (padded[at - 1] << np.uint32(8)) | padded[at]


def _middle(gram: np.ndarray) -> np.ndarray:
    return ((gram >> np.uint32(8)) & np.uint32(0xFFFF)).astype(U64)


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """What is taken from counts of one, two, and three or more, from the numbers of such counts;
    one half where these are too few to tell, so that no byte has probability zero."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        estimate = k - (k + 1) * y * b / a if a else 0.0
        out.append(estimate if 0.0 < estimate < k else 0.5)
    return tuple(out)


def _discounts(counts: DataFrame, n: str = "n") -> tuple[float, float, float]:
    row = counts.agg(*[F.sum((F.col(n) == k).cast("long")) for k in (1, 2, 3, 4)]).first()
    return discounts(*[float(x or 0) for x in row])


def _taken(n: Column, d: tuple[float, float, float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _histories(counts: DataFrame, history: Column, d: tuple[float, float, float]) -> DataFrame:
    """(history, total, rest): its count and the share of probability that it hands down."""
    return counts.groupBy(history.alias("history")).agg(
        F.sum("n").alias("total"), (F.sum(_taken(F.col("n"), d)) / F.sum("n")).alias("rest")
    )


def _low_orders(bigrams: np.ndarray) -> np.ndarray:
    """Smoothed probability of a byte after a byte, from the 256 x 256 continuation counts."""

    def mixed(counts: np.ndarray, wider: np.ndarray) -> np.ndarray:
        d = discounts(*[float(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)])
        taken = np.select([counts == 0, counts == 1, counts == 2], [0.0, d[0], d[1]], d[2])
        total = counts.sum(axis=-1, keepdims=True)
        rest = np.where(total > 0, taken.sum(axis=-1, keepdims=True) / np.maximum(total, 1), 1.0)
        return (counts - taken) / np.maximum(total, 1) + rest * wider

    unigrams = (bigrams > 0).sum(axis=0).astype(np.float64)
    return mixed(bigrams, mixed(unigrams, np.full(256, 1 / 256)))


def build_model(counts: DataFrame, bits: int, half: int) -> tuple[DataFrame, np.ndarray]:
    """(model rows by shard, probabilities of order two) from a stored table (gram, n).

    Rows are (part, kind, key, p): 4 the discounted probability of a 4-gram, 3 the probability
    of the last three bytes, 13 what a history of three hands down, 12 one of two."""
    spark = counts.sparkSession
    low = lambda c, b: F.expr(f"{c} & {(1 << b) - 1}")
    three = materialize(counts.groupBy(low("gram", 24).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "trigrams")
    two = three.groupBy(low("gram", 16).alias("gram")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 65,536
    bigrams = np.zeros((256, 256))
    for r in two:
        bigrams[r.gram >> 8, r.gram & 255] = r.n
    pairs = _low_orders(bigrams)
    d4, d3 = _discounts(counts), _discounts(three)
    shift = lambda b: F.shiftright("gram", b)
    h4, h3 = _histories(counts, shift(8), d4), _histories(three, shift(8), d3)
    p4 = counts.withColumn("history", shift(8)).join(h4, "history").select(
        F.lit(4).alias("kind"), F.col("gram").alias("key"), ((F.col("n") - _taken(F.col("n"), d4)) / F.col("total")).alias("p"),
        low("history", 16).alias("middle"),
    )
    flat = spark.createDataFrame(
        [(i * 256 + j, float(pairs[i, j])) for i in range(256) for j in range(256)], "pair long, lower double"
    )
    p3 = three.withColumn("history", shift(8)).withColumn("pair", low("gram", 16)).join(h3, "history").join(F.broadcast(flat), "pair").select(
        F.lit(3).alias("kind"), F.col("gram").alias("key"),
        ((F.col("n") - _taken(F.col("n"), d3)) / F.col("total") + F.col("rest") * F.col("lower")).alias("p"), F.col("history").alias("middle"),
    )
    r3 = h4.select(F.lit(13).alias("kind"), F.col("history").alias("key"), F.col("rest").alias("p"), low("history", 16).alias("middle"))
    r2 = h3.select(F.lit(12).alias("kind"), F.col("history").alias("key"), F.col("rest").alias("p"), F.col("history").alias("middle"))
    rows = reduce(DataFrame.union, [p4, p3, r3, r2])

    def place(batches):
        for b in batches:
            part = part_of(b.column("middle").to_numpy().astype(U64), bits) * 2 + half
            yield pa.RecordBatch.from_arrays([pa.array(part), b.column("kind"), b.column("key"), b.column("p")], names=["part", "kind", "key", "p"])

    return rows.mapInArrow(place, "part long, kind int, key long, p double"), pairs


class _Table:
    def __init__(self, rows: pa.Table, kind: int):
        some = rows.filter(pa.compute.equal(rows.column("kind"), kind))
        key, p = some.column("key").to_numpy(), some.column("p").to_numpy()
        order = np.argsort(key)
        self.key, self.p = key[order], p[order]

    def get(self, key: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
        """(values, whether the key is known)."""
        if not len(self.key):
            return np.full(len(key), default), np.zeros(len(key), dtype=bool)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        known = self.key[at] == key
        return np.where(known, self.p[at], default), known


def score_grams(gram: np.ndarray, rows: pa.Table, pairs: np.ndarray) -> np.ndarray:
    """Log probabilities of the last byte of 4-grams of a shard."""
    gram = gram.astype(np.int64)
    pair = pairs[(gram >> 8) & 255, gram & 255]
    three, known = _Table(rows, 3).get(gram & 0xFFFFFF, 0.0)
    three = np.where(known, three, _Table(rows, 12).get((gram >> 8) & 0xFFFF, 1.0)[0] * pair)
    own, _ = _Table(rows, 4).get(gram, 0.0)
    return np.log(own + _Table(rows, 13).get(gram >> 8, 1.0)[0] * three)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = 0.99,
    id_column: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    quality: str = "quality",
) -> DataFrame:
    """(id, language, trusted, n_bytes, cross_entropy, threshold, kept) per row of ``docs``.

    Texts whose id has a label of quality 1 are trusted: the models are counted on them, and the
    ``quantile`` of their cross entropies (in thousandths of a nat per byte, rounded up) is the
    threshold of their language, or of all of them for a language without trusted texts.  A
    null or empty text has no cross entropy and is not kept.  A null language is a language of
    its own; without any trusted text nothing is kept.  Rows with equal ids are scored one by
    one, repeated labels count once, labels without a text are ignored; other columns are not
    read.  A row with a null id is never trusted."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(docs[id_column].alias("_id"), docs[text].alias("_text"), docs[language].cast("string").alias("_lang"))
    chunks, bits = sizes(source)
    chunks += 2 - chunks % 2  # an even number: the last bit of the chunk is the half
    by_id = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(chunks))
    chunked = source.withColumn("chunk", F.when(F.col("_id").isNull(), F.pmod(F.xxhash64("_text"), F.lit(chunks))).otherwise(by_id))
    number = lambda table: table.column("chunk")[0].as_py() if table.num_rows else 0
    trusted = labels.where(labels[quality] == 1).select(labels[id_column].alias("_id")).where("_id is not null").distinct()
    trusted = trusted.withColumn("chunk", by_id)

    def is_trusted(table: pa.Table, ids: pa.Table) -> np.ndarray:
        return pa.compute.is_in(table.column("_id"), value_set=ids.column("_id").cast(table.column("_id").type)).to_numpy(zero_copy_only=False)

    def count(table: pa.Table, ids: pa.Table) -> pa.Table:
        values, offsets = utf8(text_of(table))
        mask = np.repeat(is_trusted(table, ids).astype(bool), np.diff(offsets))
        gram, n = np.unique(grams(values, offsets)[mask], return_counts=True)
        part = part_of(_middle(gram), bits) * 2 + number(table) % 2
        order = np.argsort(part, kind="stable")
        return ask(number(table), part[order], gram=gram[order], n=n[order].astype(np.int64))

    def add(table: pa.Table) -> pa.Table:
        gram, n = column(table, "gram", np.uint32), column(table, "n", np.int64)
        keys, at = np.unique(gram, return_inverse=True)
        total = np.zeros(len(keys), dtype=np.int64)
        np.add.at(total, at, n)
        half = np.full(len(keys), table.column("part")[0].as_py() % 2, dtype=np.int32)
        return pa.table({"half": half, "gram": keys.astype(np.int64), "n": total})

    counted = chunked.groupBy("chunk").cogroup(trusted.groupBy("chunk")).applyInArrow(count, ASKED)
    counts = materialize(counted.groupBy("part").applyInArrow(add, "half int, gram long, n long"), "gram-counts")
    models = [build_model(counts.where(F.col("half") == h).select("gram", "n"), bits, h) for h in (0, 1)]
    model = models[0][0].union(models[1][0])
    shared = docs.sparkSession.sparkContext.broadcast([pairs for _, pairs in models])

    def asked(values: np.ndarray, offsets: np.ndarray, chunk: int):
        gram, at = np.unique(grams(values, offsets), return_inverse=True)
        part = part_of(_middle(gram), bits) * 2 + 1 - chunk % 2
        order = np.argsort(part, kind="stable")
        return gram, at, part, order

    def question(table: pa.Table) -> pa.Table:
        gram, _, part, order = asked(*utf8(text_of(table)), number(table))
        return ask(number(table), part[order], gram=gram[order], n=np.empty(0, np.int64))

    def answer(table: pa.Table, rows: pa.Table) -> pa.Table:
        gram = column(table, "gram", np.uint32)
        if not table.num_rows:
            return reply(table, "gram", 4, logp=np.empty(0, np.float32))
        pairs = shared.value[table.column("part")[0].as_py() % 2]
        return reply(table, "gram", 4, logp=score_grams(gram, rows, pairs).astype(np.float32))

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        values, offsets = utf8(text_of(table))
        gram, at, _, order = asked(values, offsets, number(table))
        logp = np.empty(len(gram), dtype=np.float64)
        logp[order] = replied(replies.filter(pa.compute.is_valid(replies.column("logp"))), "logp", np.float32)
        n = np.diff(offsets)
        some = np.flatnonzero(n)
        entropy = np.full(table.num_rows, np.nan)
        if len(some):
            entropy[some] = -np.add.reduceat(logp[at], offsets[:-1][some]) / n[some]
        known = replies.filter(pa.compute.is_valid(replies.column("_id")))
        return pa.table(
            {
                "id": table.column("_id"), "language": table.column("_lang"), "trusted": pa.array(is_trusted(table, known), pa.bool_()),
                "n_bytes": pa.array(n.astype(np.int64)), "cross_entropy": pa.array(entropy, from_pandas=True),
            }
        )

    asks = chunked.groupBy("chunk").applyInArrow(question, ASKED)
    told = asks.groupBy("part").cogroup(model.groupBy("part")).applyInArrow(answer, TOLD)
    both = told.unionByName(trusted, allowMissingColumns=True)
    scored = materialize(
        chunked.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(
            finish, f"id {kind}, language string, trusted boolean, n_bytes long, cross_entropy double"
        ), "quality-scores",
    )
    out = _judged(scored, quantile)
    return out.withColumnRenamed("id", id_column)


def _judged(scored: DataFrame, quantile: float) -> DataFrame:
    """Scores with the threshold of their language, from counts per thousandth of a nat."""
    bins = (
        scored.where("trusted and cross_entropy is not null")
        .groupBy(F.coalesce("language", F.lit("")).alias("key"), F.ceil(F.col("cross_entropy") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    bins = materialize(bins, "entropy-bins")
    every = bins.groupBy(F.lit(None).cast("string").alias("key"), "bin").agg(F.sum("n").alias("n"))
    per_key = bins.union(every).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("b"), F.sum("n").alias("total"))
    cut = F.aggregate(
        "b", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("bin")),
        lambda s, x: F.when(s["bin"].isNotNull(), s).otherwise(
            F.struct((s["seen"] + x["n"]).alias("seen"), F.when(s["seen"] + x["n"] >= F.lit(quantile) * F.col("total"), x["bin"]).alias("bin"))
        ),
    )
    cuts = materialize(per_key.select("key", (cut["bin"] / BINS).alias("threshold")), "entropy-cuts")
    overall = cuts.where("key is null").select("threshold").first()
    overall = F.lit(overall[0] if overall else None).cast("double")
    keyed = scored.withColumn("key", F.coalesce("language", F.lit("")))
    joined = lookup_join(keyed, cuts.where("key is not null"), "key", "id", 64, "left")
    return joined.withColumn("threshold", F.coalesce("threshold", overall)).select(
        "id", "language", "trusted", "n_bytes", "cross_entropy", "threshold",
        F.coalesce(F.col("cross_entropy") <= F.col("threshold"), F.lit(False)).alias("kept"),
    )
