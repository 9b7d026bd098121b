"""The model against a direct computation, thresholds, and separation of odd texts."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tagwright.llm.quality import discounts, score_documents


def grams_of(text):
    b = b"\n\n\n" + (text or "").encode()
    return [tuple(b[i : i + 4]) for i in range(len(b) - 3)]


class Direct:
    """Interpolated modified Kneser-Ney by recursion over dictionaries."""

    def __init__(self, texts):
        self.counts = {4: Counter(g for t in texts for g in grams_of(t))}
        for order in (3, 2, 1):
            self.counts[order] = Counter(g[1:] for g in self.counts[order + 1])
        self.by_history = {o: defaultdict(list) for o in self.counts}
        self.d = {}
        for order, counts in self.counts.items():
            for g, n in counts.items():
                self.by_history[order][g[:-1]].append(n)
            self.d[order] = discounts(*[float(sum(n == k for n in counts.values())) for k in (1, 2, 3, 4)])

    def p(self, gram):
        order = len(gram)
        if not order:
            return 1 / 256
        lower = self.p(gram[1:])
        have = self.by_history[order].get(gram[:-1])
        if not have:
            return lower
        take = lambda n: self.d[order][min(n, 3) - 1] if n else 0.0
        n, total = self.counts[order][gram], sum(have)
        return (n - take(n)) / total + sum(map(take, have)) / total * lower


def test_cross_entropies_equal_direct_computation(spark):
    rows = [
        (1, "the cat sat on the mat, the cat ate", "en"), (2, "un été là-bas, un chat", "fr"), (3, "#### $$$$ 0101", "en"), (4, None, "en"),
        (5, "", None), (6, "a", None), (7, "le chat un été", "fr"), (8, "the mat " * 3000, "en"), (9, "xyz", "de"), (1, "the cat", "en"), (None, "the cat", None),
    ]
    marks = [(1, 1), (2, 1), (7, 1), (3, 0), (2, 1), (99, 1), (None, 1), (6, None), (4, 1)]
    docs = spark.createDataFrame([(*r, 5, 1) for r in rows], "doc_id long, text string, lang string, n_bytes int, chunk int")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    trusted = {1, 2, 7, 4}
    halves = docs.select(
        "doc_id", "text", (F.pmod(F.coalesce(F.xxhash64(F.col("doc_id").cast("string")), F.xxhash64("text")), F.lit(2)) % 2).alias("h")
    )
    half = {(r.doc_id, r.text): r.h for r in halves.collect()}
    models = [Direct([r[1] for r in rows if r[0] in trusted and half[r[:2]] == 1 - h]) for h in (0, 1)]
    model = models[0]
    assert {half[r[:2]] for r in rows if r[0] in trusted and r[1]} == {0, 1}
    assert math.isclose(sum(model.p((0x74, 0x68, 0x65, c)) for c in range(256)), 1.0)
    out = sorted(score_documents(docs, labels).collect(), key=lambda r: (str(r.doc_id), r.n_bytes))
    entropies = defaultdict(list)
    for r, (i, text, lang) in zip(out, sorted(rows, key=lambda r: (str(r[0]), len((r[1] or "").encode()))), strict=True):
        g, model = grams_of(text), models[half[i, text]]
        assert r.doc_id == i and r.n_bytes == len(g) and r.trusted == (i in trusted)
        if not g:
            assert r.cross_entropy is None and not r.kept
            continue
        assert r.cross_entropy == pytest.approx(-sum(math.log(model.p(x)) for x in g) / len(g), rel=1e-5)
        if r.trusted:
            entropies[lang].append(r.cross_entropy)
            entropies[None].append(r.cross_entropy)
    for r in out:
        own = sorted(entropies.get(r.language) or entropies[None])
        at = own[math.ceil(0.99 * len(own)) - 1]
        assert r.threshold == pytest.approx(math.ceil(at * 1000) / 1000)
        assert r.kept == (r.cross_entropy is not None and r.cross_entropy <= r.threshold)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    (row,) = score_documents(docs, labels).collect()
    assert row.threshold is None and not row.kept and row.cross_entropy == pytest.approx(math.log(256))
    assert score_documents(docs.limit(0), labels).count() == 0


def test_held_out_texts(spark):
    """Trained on half of the good labels, other good texts are kept and shuffled bytes are not."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    docs = docs.where("n_chars > 300")
    noise = docs.where("doc_id % 10 = 3").select((F.col("doc_id") + 10**6).alias("doc_id"), F.sha2("text", 512).alias("text"), "lang")
    train = labels.where("quality = 1 and doc_id % 2 = 0")
    out = score_documents(docs.select("doc_id", "text", "lang").union(noise), train)
    held = out.join(labels.where("quality = 1 and doc_id % 2 = 1"), "doc_id")
    assert held.agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.9
    assert out.where("doc_id >= 1000000 and kept").count() == 0
