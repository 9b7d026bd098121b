"""Groups by shingle similarity and components against brute force."""

import random
import re

from tagwright.llm.graph import components
from tagwright.llm.jaccard import similar_groups


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def closure(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, k=5, share=75):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            p, q = sets[a], sets[b]
            if p and q and 100 * len(p & q) >= share * len(p | q):
                links.append((a, b))
    found = closure(ids, links)
    return sorted((i, len(sets[i]), found[i]) for i in ids)


def make_rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "ÉTÉ", "A", "a"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 9, 40, 120]))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(rng.choice([" ", "\n", "  "]).join(copy))
    chain = [rng.choice(vocabulary) for _ in range(60)]
    for i in range(12):  # each links with the next ones only
        chain = chain[2:] + [f"c{i}", f"d{i}"]
        rows.append(" ".join(chain))
    rows += [None, "", "  \n", "one", "one", "ONE", "x" * 50_000, "many " * 5_000, "many " * 6_000]
    rng.shuffle(rows)
    return [(7 * i + 3, t) for i, t in enumerate(rows)]


def test_groups_equal_brute_force(spark):
    rows = make_rows()
    docs = spark.createDataFrame([(i, t, 0, "n") for i, t in rows], "doc_id long, text string, n int, id string")
    got = sorted(tuple(r) for r in similar_groups(docs).collect())
    assert got == brute(rows)


def test_edge_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c"), (None, None), (4, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, similar_groups(docs).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 1, 1), (2, 1, 1), (None, 1, 1), (None, 0, None), (4, 1, 4)], key=str)
    assert similar_groups(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000)]
    edges = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == closure({x for e in links for x in e}, links)
    assert components(edges.limit(0)).count() == 0
