"""Language evidence against a direct computation, and held-out accuracy."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagwright.llm import language as L

SF = "/root/testdata/sf0.01"


def grams(text):
    b = bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())
    b = bytes(x if 97 <= x <= 122 or x >= 128 else 32 for x in b)
    out = []
    for i in range(len(b) - 2):
        if b[i : i + 3] != b"   ":
            value = b[i] << 16 | b[i + 1] << 8 | b[i + 2]
            out.append(value * 0x9E3779B1 % 2**32 >> 32 - L.FEATURE_BITS)
    return out


def brute(train, rows):
    names = sorted({lang for _, lang in train if lang})
    size = 1 << L.FEATURE_BITS
    counts = {x: Counter() for x in names}
    for text, lang in train:
        if lang:
            counts[lang].update(grams(text))
    weight = lambda x, g: math.log((counts[x][g] + 1) / (sum(counts[x].values()) + size))
    scored = []
    for text, declared, host in rows:
        g = grams(text)
        ll = [sum(weight(x, f) for f in g) / len(g) for x in names] if g else None
        scored.append((len(g), ll, declared and declared.split("-")[0].lower(), (host or "").lower()))
    votes = [(h, d, ll.index(max(ll))) for n, ll, d, h in scored if ll]
    known = [(d, v) for _, d, v in votes if d in names]
    reliable = min(0.99, (sum(names[v] == d for d, v in known) + 1) / (len(known) + 2))

    def level(key, wider):
        out = {}
        for h in {h for h, _, _ in votes}:
            c = [sum(key(x) == key(h) and v == i for x, _, v in votes) for i in range(len(names))]
            out[h] = [(a + L.SMOOTHING * p) / (sum(c) + L.SMOOTHING) for a, p in zip(c, wider(h), strict=True)]
        return out

    every = [sum(v == i for _, _, v in votes) for i in range(len(names))]
    base = [(a + 1) / (sum(every) + len(names)) for a in every]
    suffix = level(lambda h: h.rsplit(".", 1)[-1], lambda h: base)
    domain = level(lambda h: ".".join(h.split(".")[-2:]), lambda h: suffix[h])
    prior = level(lambda h: h, lambda h: domain[h])
    out = []
    for n, ll, d, h in scored:
        if not n:
            out.append((None, 0.0, False))
            continue
        post = []
        for i, x in enumerate(names):
            claim = (math.log(reliable) if x == d else math.log((1 - reliable) / (len(names) - 1))) if d in names else 0
            post.append(ll[i] * n * L.EVIDENCE / (n + L.EVIDENCE) + claim + math.log(prior[h][i]))
        top = max(post)
        at, share = post.index(top), 1 / sum(math.exp(p - top) for p in post)
        out.append((names[at], round(share, 6), share >= 0.5 and ll[at] > -math.log(size)))
    return out


def test_equal_to_direct_computation(spark):
    train = [("the cat and the dog", "en"), ("le chat et la été", "fr"), ("der Hund und über", "de"), (None, "de"), ("x", None), ("", "fr")]
    rows = [
        ("the dog", "en", "a.b.com"), ("le chat", "fr-FR", "c.b.com"), ("der Hund ist", None, None), ("and", "de", "www.x.de"),
        (None, "en", "a.b.com"), ("", None, "a.b.com"), ("12 34 !!", "en", "A.B.com"), ("été", "EN", "x.de"), ("the " * 3000, "xx", "x.fr"),
        ("Z" * 20_000, "fr", "q"), ("the dog", "en", "a.b.com"),
    ]
    model = L.fit_text(spark.createDataFrame(train, "text string, lang string"))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_n long, prior string, lang string, language string")
    got = L.identify(df, model, df["prior"], df["lang"], df["language"], ["_n"]).withColumn("confidence", F.round("confidence", 6))
    found = {r["_n"]: (r.language, r.confidence, r.accepted) for r in got.collect()}
    for i, expected in enumerate(brute(train, rows)):
        assert found[i][0] == expected[0] and found[i][2] == expected[2], (i, found[i], expected)
        assert found[i][1] == pytest.approx(expected[1], abs=2e-6)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    one = spark.createDataFrame([(1, "the", "en", "s")], none.schema)
    model = L.fit_text(none)
    assert [tuple(r) for r in L.identify(one, model, one["text"], one["lang"], one["source"], ["doc_id"]).collect()] == [(1, None, 0.0, False)]
    assert L.identify(none, L.fit_text(one), none["text"], none["lang"], none["source"], ["doc_id"]).count() == 0


def test_page_parts(spark):
    html = '<!DOCTYPE html><HTML class=x lang="fr-CA"><style>p{}</style><script>var t="</p>";</script><!-- <b> --><p>Bon<br>jour</p></html>'
    df = spark.createDataFrame([(html, "https://u@WWW.x.fr:80/a?b#c"), ("plain", "nothing"), (None, None)], "h string, u string")
    rows = df.select(L.page_text(df.h), L.page_language(df.h), L.host(df.u)).collect()
    assert rows[0][0].split() == ["Bon", "jour"] and rows[0][1:] == ("fr", "www.x.fr")
    assert tuple(rows[1]) == ("plain", None, None) and tuple(rows[2]) == (None, None, None)


def test_held_out_accuracy(spark):
    """Trained on even ids, judged on odd ones by the text alone."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit_text(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1 and n_chars > 50")
    none = F.lit(None).cast("string")
    found = L.identify(held, model, held["text"], none, none, ["doc_id", "lang"])
    right, total = found.agg(F.sum((F.col("language") == F.col("lang")).cast("int")), F.count("*")).first()
    assert right >= 0.98 * total


def test_rare_languages_have_a_model(spark):
    """A language with less than a thousandth of the rows is found and accepted, declared or not."""
    train = [(f"the house over there and {i} more with the others", "en") for i in range(2500)]
    train += [("la casa della signora che abita nella grande piazza", "it"), ("它们在房子里面看见了很多人", "zh")]
    model = L.fit_text(spark.createDataFrame(train, "text string, lang string"))
    assert model.languages == ("en", "it", "zh")
    rows = [(1, "la casa nella grande piazza", "it"), (2, "它们在房子里面", "zh"), (3, "它们在房子里面看见了", None), (4, "the house", "en")]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    got = L.identify(df, model, df["text"], df["lang"], F.lit(None).cast("string"), ["id"]).collect()
    assert {r.id: (r.language, r.accepted) for r in got} == {1: ("it", True), 2: ("zh", True), 3: ("zh", True), 4: ("en", True)}


def test_spellings_of_a_tag_are_one_language(spark):
    """FR, fr-CA and fr_BE train one model and are known as declarations."""
    french, english = "le chat est sur la table et le chien aussi", "the cat is on the table and so is the dog"
    rows = [(i, french, ["FR", "fr-CA", " fr_BE", "fr"][i % 4], "a") for i in range(40)]
    rows += [(100 + i, english, ["en-US", "EN", "en", "", None][i % 5], "b") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = L.fit_text(docs)
    assert model.languages == ("en", "fr")
    short = spark.createDataFrame([(1001, "table", "FR-ca", "c"), (1002, "table", "en_GB", "d"), (1003, french, "-", None)], docs.schema)
    every = docs.unionByName(short)
    found = L.identify(every, model, every["text"], every["lang"], every["source"], ["doc_id"]).where("doc_id > 1000")
    assert {r.doc_id: r.language for r in found.collect()} == {1001: "fr", 1002: "en", 1003: "fr"}
