"""Benchmark windows in documents against a word-by-word search."""

import random
import re

import pytest

from tagwright.llm.contamination import benchmark_hits

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    windows = set()
    for item, text in items:
        w = split(text)
        for j in range(max(1, len(w) - size + 1) if w else 0):
            windows.add((str(item) if item is not None else "", tuple(w[j : j + size])))
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for item, window in windows:
            for s in range(len(w) - len(window) + 1):
                if tuple(w[s : s + len(window)]) == window:
                    hit.update(range(s, s + len(window)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def cases():
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "gamma", "dé", "1x", "Ünd", "of"]
    text = lambda n: rng.choice([" ", "-", "\n", "_"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 9]))) for i in range(12)] + [(3, text(6)), (None, "lone words here"), (20, None), (21, "!?")]
    docs = [(i, text(rng.randrange(40))) for i in range(60)]
    docs += [(5, docs[5][1]), (None, "some lone words here too"), (90, None), (91, ""), (92, "?? !!"), (93, text(20_000))]
    docs += [(100 + i, text(3) + " " + (items[i][1] or "") + " " + text(3)) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("block", [100_000, 7])
def test_hits_equal_brute_force(spark, block):
    docs, items = cases()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, n_hit int")
    got = benchmark_hits(d, b, size=6, block_windows=block)
    rows = got.collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows], key=str) == brute(docs, items, 6)
    assert all(r.n_hit == sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2], strict=True)) for r in rows)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in benchmark_hits(d, b).collect()] == [(1, 2, 0, [], [])]
    assert benchmark_hits(d.limit(0), b).count() == 0
