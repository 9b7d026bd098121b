import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagwright.functions import text as tf
from tagwright.functions.porter import porter_stem
from tagwright.operators import text as tx
from tagwright.plans.features import term_vectors, weighted_terms

DOCS = [
    (1, "The cat, the CAT and 3 dogs!"),
    (2, "cat dog Élan élan x2y"),
    (3, ""),
    (4, "cat bird"),
    (5, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def as_dict(df, key, value):
    return {tuple(r[k] for k in key): r[value] for r in df.collect()}


def test_clean_tokens(docs):
    got = as_dict(tx.tokenize(docs), ["doc_id"], "tokens")
    assert got[(1,)] == ["the", "cat", "the", "cat", "and", "dogs"]
    assert got[(2,)] == ["cat", "dog", "élan", "élan"]
    assert got[(3,)] == [] and got[(5,)] == []


def test_minimum_length(docs):
    got = as_dict(tx.tokenize(docs, min_len=3), ["doc_id"], "tokens")
    assert got[(1,)] == ["dogs"] and got[(2,)] == ["élan", "élan"]


def test_stopwords_keep_repeats_and_order(spark, docs, monkeypatch):
    tokens = tx.tokenize(docs)
    listed = as_dict(tx.remove_stopwords(tokens, ["the", "and"]), ["doc_id"], "tokens")
    assert listed[(1,)] == ["cat", "cat", "dogs"]
    words = spark.createDataFrame([("the",), ("and",)], "word string")
    assert as_dict(tx.remove_stopwords(tokens, words), ["doc_id"], "tokens") == listed
    monkeypatch.setattr(tx, "LITERAL_WORDS", 1)
    assert as_dict(tx.remove_stopwords(tokens, words), ["doc_id"], "tokens") == listed


# Worked examples of the published algorithm.
PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "vietnamization": "vietnam", "operator": "oper", "feudalism": "feudal", "hopefulness": "hope",
    "triplicate": "triplic", "formative": "form", "electrical": "electr", "goodness": "good",
    "revival": "reviv", "adjustment": "adjust", "adoption": "adopt", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
}


def test_porter_examples():
    assert {w: porter_stem(w) for w in PORTER} == PORTER


def test_stemming_in_place_equals_dictionary(docs):
    tokens = tx.tokenize(docs)
    dictionary = as_dict(tx.stem_dictionary(tokens), ["token"], "stem")
    for before, after in zip(tokens.orderBy("doc_id").collect(), tx.stem(tokens).orderBy("doc_id").collect()):
        assert [dictionary[(t,)] for t in before["tokens"]] == after["tokens"]


def test_ngrams(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "t array<string>")
    got = [r[0] for r in rows.select(tf.ngrams(F.col("t"), 2)).collect()]
    assert got == [["a b", "b c"], []]


def test_bag_of_words_and_requested_zeros(spark, docs):
    counts = tx.bag_of_words(tx.tokenize(docs))
    got = as_dict(counts, ["doc_id", "term"], "tf")
    assert got[(1, "cat")] == 2 and got[(2, "élan")] == 2 and (4, "dog") not in got
    pairs = spark.createDataFrame([(4, "dog"), (1, "cat")], "doc_id long, term string")
    assert as_dict(tx.counts_of(pairs, counts), ["doc_id", "term"], "tf") == {(4, "dog"): 0, (1, "cat"): 2}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_tfidf_divides_by_idf(spark, limit):
    # "a" is in N-1 documents (idf 0), "b" in all N (negative idf), "c" in one
    docs = spark.createDataFrame([(1, "aa bb cc cc"), (2, "aa bb"), (3, "bb")], "doc_id long, text string")
    counts = tx.bag_of_words(tx.tokenize(docs))
    got = as_dict(tx.tfidf(counts, docs, broadcast_limit=limit, hot_min_rows=1), ["doc_id", "term"], "weight")
    assert not any(term == "aa" for _, term in got)
    assert got[(1, "cc")] == pytest.approx(math.log(3) / math.log(3 / 2))
    assert got[(2, "bb")] == pytest.approx(math.log(2) / math.log(3 / 4)) and got[(2, "bb")] < 0
    product = as_dict(tx.tfidf(counts, docs, "multiply", broadcast_limit=limit, hot_min_rows=1), ["doc_id", "term"], "weight")
    assert product[(1, "aa")] == 0 and product[(1, "cc")] == pytest.approx(math.log(3) * math.log(3 / 2))


def test_rows_have_unit_length(docs):
    weights = weighted_terms(docs, ["the", "and"])
    norms = weights.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert norms and all(r["s"] == pytest.approx(1.0) for r in norms)


def test_low_ranked_terms_go(docs):
    tokens = tx.tokenize(docs)
    got = as_dict(tx.drop_low_ranked(tokens, 1.3), ["doc_id"], "tokens")
    # "cat": (1 + ln 4) * ln(5/3) = 1.22; "the": (1 + ln 2) * ln 5 = 2.73
    assert got[(4,)] == ["bird"] and "the" in got[(1,)] and "cat" not in got[(1,)]


def test_vocabulary_across_documents(spark):
    rows = [(1, ["a", "b"]), (2, []), (5, ["c"]), (9, ["d", "e", "f"])]
    tokens = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3)
    stream = [t for _, ts in rows for t in ts]
    for n in (2, 3, 4):
        expected = {" ".join(stream[i : i + n]) for i in range(len(stream) - n + 1)}
        assert {r[0] for r in tx.vocabulary(tokens, n, span_documents=True).collect()} == expected
    assert {r[0] for r in tx.vocabulary(tokens, 2).collect()} == {"a b", "d e", "e f"}


def test_stream_offsets_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(tx, "RANGES_PER_BLOCK", 2)
    rows = spark.range(0, 300, 3).select("id", (F.col("id") % 7).alias("size")).repartition(5)
    got = tx.stream_offsets(rows, "size", "id").orderBy("id").collect()
    running = 0
    for r in got:
        assert r["offset"] == running
        running += r["size"]


def test_dictionary_share(spark, docs, monkeypatch):
    words = tx.dictionary_words(spark.createDataFrame([("Cats, the",), ("bird",)], "word string"), ["the"])
    tokens = tx.stem(tx.tokenize(docs))
    got = as_dict(tx.dictionary_share(tokens, words), ["doc_id"], "share")
    assert got[(4,)] == 1.0 and got[(3,)] is None and got[(1,)] == pytest.approx(2 / 6)
    monkeypatch.setattr(tx, "LITERAL_WORDS", 1)
    assert as_dict(tx.dictionary_share(tokens, words), ["doc_id"], "share") == got


def test_term_vectors(docs, spark):
    tokens = tx.tokenize(docs)
    counts = tx.bag_of_words(tokens)
    vocabulary = tx.top_terms(tx.term_rank(counts, docs), 3)
    vectors = term_vectors(tx.tfidf(counts, docs, "multiply"), vocabulary, docs)
    got = as_dict(vectors, ["doc_id"], "vec")
    assert all(len(v) == 3 for v in got.values()) and got[(3,)] == [0.0, 0.0, 0.0]
    assert any(v != [0.0, 0.0, 0.0] for v in got.values())


def test_tokens_are_counted_in_bounded_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array([["a", "b"] * 500] * 500)], names=["doc_id", "tokens"])
    parts = list(tx._slices(batch))
    assert sum(p.num_rows for p, _ in parts) == 500
    assert all(lengths.sum() <= 1 << 17 for _, lengths in parts)


@pytest.mark.parametrize("mode,n", [("divide", 1), ("multiply", 1), ("divide", 2)])
def test_weights_of_chunks_equal_joins(spark, monkeypatch, mode, n):
    """Rows that repeat an id have a length together, whatever the chunks are; counts are not exchanged."""
    monkeypatch.setattr(tx, "TEXT_CHUNK_BYTES", 40)
    monkeypatch.setattr(tx, "CHUNKS_PER_PART", 2)
    texts = ["aa bb cc cc", "aa bb élan", "bb", None, "", "the 12", "aa bb " * 30, "xy aa zz zz", "xy bb aa"]
    rows = list(enumerate(texts * 3)) + [(0, "bb cc"), (None, "aa zz"), (None, "xy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = tx.bag_of_words(tx.remove_stopwords(tx.tokenize(docs), ["the"]), n)
    expected = tx.l2_normalize(tx.tfidf(counts, docs, mode))
    got = weighted_terms(docs, ["the"], n, mode)
    assert got.schema.simpleString() == expected.schema.simpleString()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan

    def cells(df):
        return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["term"], round(r["weight"], 9)) for r in df.collect())

    assert cells(got) == cells(expected)
    packed = weighted_terms(docs, ["the"], n, mode, packed=True)
    assert packed.select("doc_id").distinct().count() == packed.count()
    long = packed.select("doc_id", F.explode(F.arrays_zip("terms", "vals")).alias("z")).select("doc_id", "z.terms", "z.vals")
    assert cells(long.toDF("doc_id", "term", "weight")) == cells(expected)
    assert weighted_terms(docs.limit(0), ["the"], n, mode).count() == 0
