"""Licence scan against plain loops over words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tagwright.llm.licenses import BASE, NOTICES, SHARE, SLACK, Template, scan_licenses

SCHEMA = "doc_id long, text string"


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, templates):
    w = words(text)
    places, base, labels, score = [], set(), set(), 0.0
    for x in templates:
        t = x.text.split()
        grams = {tuple(t[i : i + 3]): [j for j in range(len(t) - 2) if t[j : j + 3] == t[i : i + 3]] for i in range(len(t) - 2)}
        if x.base:
            here = [p for p in range(len(w) - len(t) + 1) if w[p : p + len(t)] == t]
            places += here
            if here:
                base.add(x.label)
            votes = {}
            for p in range(len(w) - 2):
                for j in grams.get(tuple(w[p : p + 3]), ()):
                    votes.setdefault(p - j, set()).add(j)
        else:
            votes = {}
            for p in range(len(w) - 2):
                for j in grams.get(tuple(w[p : p + 3]), ()):
                    for band in ((p - j) // SLACK, (p - j) // SLACK - 1):
                        votes.setdefault(band, set()).add(j)
            key = x.key.split()
            first = next((i for i in range(len(t)) if t[i : i + len(key)] == key), 0)
            needed = set(range(first, first + len(key) - 2))
            if any(len(v) / (len(t) - 2) >= SHARE and needed <= v for v in votes.values()):
                labels.add(x.label)
        score = max([score, *(len(v) / (len(t) - 2) for v in votes.values())])
    labels |= base
    return (
        len(w), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9),
    )


def run(spark, rows, templates=BASE + NOTICES):
    found = scan_licenses(spark.createDataFrame(rows, SCHEMA).withColumn("uid", F.lit(7)).withColumn("label", F.lit("x")), templates)
    assert found.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return sorted(((r[0], *r[1:-1], round(r[-1], 9)) for r in found.collect()), key=str)


def make_text(rng):
    parts = []
    for _ in range(rng.randrange(1, 7)):
        kind = rng.randrange(4)
        x = rng.choice(BASE + NOTICES)
        w = x.text.split()
        if kind == 1:
            parts += w
        elif kind == 2:  # words put in, left out, exchanged
            for _ in range(rng.randrange(1, 5)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = [rng.choice(["one", "the", "new"])] * rng.randrange(3) or ["x"]
            parts += w
        elif kind == 3:
            parts += w[rng.randrange(len(w)) :]
        else:
            parts += [rng.choice(["lorem", "the", "license", "Été", "cc", "by", "nc", "2"]) for _ in range(rng.randrange(30))]
    return "".join(p.upper() + rng.choice([" ", ", ", "\n", "-"]) if rng.random() < 0.2 else p + " " for p in parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_loops(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, i, i // 2]), make_text(rng)) for i in range(300)]
    want = sorted(((i, *brute(text, BASE + NOTICES)) for i, text in rows), key=str)
    assert run(spark, rows) == want
    assert sum(bool(x[6]) for x in want) > 50 and sum(not x[6] for x in want) > 20


def test_odd_rows(spark):
    line = "Released under the MIT License."
    rows = [
        (1, None), (2, ""), (2, "."), (3, "under the mit"), (None, line), (5, line), (5, line), (6, "cc by nc by nc cc by nc"),
        (7, "x " * 200_000 + line), (8, " ".join([line] * 3000)), (9, "Under The Kit MIT License under the émit license"),
    ]
    assert run(spark, rows) == sorted(((i, *brute(text, BASE + NOTICES)) for i, text in rows), key=str)
    assert run(spark, []) == []


def test_notices_need_their_key(spark):
    gpl, lgpl = (next(x.text for x in NOTICES if x.label == n) for n in ("gpl", "lgpl"))
    got = {r[0]: r[6] for r in run(spark, [(1, gpl), (2, lgpl), (3, gpl.replace("modify", "alter"))])}
    assert got == {1: "gpl", 2: "lgpl", 3: "gpl"}


def test_templates_are_checked(spark):
    for bad in (Template("a", "two words"), Template("a", "x " * 70), Template("a", "one two three", key="three four five")):
        with pytest.raises(ValueError):
            scan_licenses(spark.createDataFrame([], SCHEMA), [bad])


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([], SCHEMA)
    plan = scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
