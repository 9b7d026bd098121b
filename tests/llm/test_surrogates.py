"""Detection, formats, coreference and distinctness of surrogates."""

import re

from pyspark.sql import functions as F

from tagwright.llm.surrogates import entities, kind_of, replace_entities

TEXTS = {
    1: 'Mail un.34@mail7.example.com or UN.34@MAIL7.EXAMPLE.COM, call +1 (017) 555-7713 or +1 017-555-7713 now.',
    2: 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"!! from 97.51.17.173### card 9807915762804490, 4111 1111 1111 1111.',
    3: "Mr. John Smith met Mrs. Ann Smith; Mr Smith left. Herr Müller blieb. Госпожа Анна Иванова.",
    4: "Version 2.0. released 2024-01-01, pi is 3.14159, 1234 things, a@b, 300.1.2.3, licence CC BY-NC 4.0.",
    5: None,
    6: "",
    7: "x " * 20_000 + "z@y.org",
}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(d[0::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])


def shape(s):
    return re.sub(r"\d", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", s)))


def test_replacements(spark):
    rows = [(i, t, "s", 1) for i, t in TEXTS.items()] + [(1, TEXTS[1], "s", 1), (None, "z@y.org", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kinds string, n int")
    got = replace_entities(docs, "key")
    out = {(r.doc_id, r.text): r for r in got.collect()}
    by_id = {i: r for (i, _), r in out.items()}
    assert len(got.collect()) == len(rows)
    assert by_id[4].text == TEXTS[4] and by_id[4].n_entities == 0
    assert by_id[5].text is None and by_id[6].text == ""

    a = by_id[1].text
    m = re.fullmatch(r"Mail (\S+) or (\S+), call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3})-(\d{3})-(\d{4}) now\.", a)
    assert m and m[1].upper() == m[2] and shape(m[1]) == shape("un.34@mail7.example.aaa") and m[1].endswith(".com")
    assert m[3] + m[4] + m[5] == m[6] + m[7] + m[8] != "0175557713"
    assert by_id[1].kinds == {"email": 2, "phone": 2}

    b = re.fullmatch(r'token = "([0-9a-f]{40})"!! from (\d+\.\d+\.\d+\.\d+)### card (\d{16}), (\d{4} \d{4} \d{4} \d{4})\.', by_id[2].text)
    assert b and luhn(b[4]) % 10 == 0 and b[4] != "4111 1111 1111 1111" and b[3] != "9807915762804490"

    c = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); Mr (\w+) left\. Herr (\w+) blieb\. Госпожа ([А-я]+) ([А-я]+)\.", by_id[3].text)
    assert c and c[2] == c[4] == c[5] != "Smith" and c[6] not in (c[2], "Müller")
    assert c[1].endswith(("o", "us", "in", "er")) and c[3].endswith(("a", "ine", "elle", "ia"))
    assert by_id[7].text.startswith("x " * 20_000) and by_id[7].text.endswith(by_id[None].text)
    assert replace_entities(docs.limit(0), "key").count() == 0


def test_short_forms_stay_distinct(spark):
    """More one-letter addresses than surrogates of that form: all still differ."""
    names = [f"{a}{d}@q.de" for a in "abcdefgh" for d in range(10)] + [f"{a}@{b}.de" for a in "abcdefghij" for b in "abcdefghijklmnop"]
    docs = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "doc_id long, text string")
    found = [r.text for r in replace_entities(docs, "k").collect()]
    assert len(set(found)) == len(names) and not set(found) & set(names)
    assert all(re.fullmatch(r"[a-z]\d*@[a-z]\.de", x) for x in found)
    other = {r.text for r in replace_entities(docs, "other").collect()}
    assert other != set(found)


def test_kinds(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS.values()], "t string")
    rows = df.select(F.explode(entities(F.col("t"))).alias("e")).select("e", kind_of(F.col("e")).alias("k")).collect()
    assert all(r.k for r in rows) and len(rows) == 14


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.de")], "doc_id long, text string")
    text = replace_entities(docs, "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", text)
