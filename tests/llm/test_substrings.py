"""Repeated strings against a search over all starts."""

import random

import pytest

from tagwright.llm.substrings import remove_repeats


def brute(rows, length):
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for b in texts:
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = []
    for (i, _), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        edges = [k for k in range(len(b) + 1) if (gone[k - 1] if k else 0) != (gone[k] if k < len(b) else 0)]
        out.append((i, len(b), sum(gone), tuple(edges), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def make_rows(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    parts = [text(rng.randrange(5, 90)) for _ in range(6)]
    rows = []
    for i in range(120):
        rows.append((i, "".join(rng.choice([text(rng.randrange(30)), rng.choice(parts)]) for _ in range(rng.randrange(6)))))
    rows += [(200, None), (201, ""), (202, "a" * 300), (203, "ab" * 200), (203, "x"), (204, rows[3][1]), (204, rows[3][1]), (None, text(60)), (205, text(39)), (206, "q" * 41)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr("tagwright.llm.substrings.CHUNK_BYTES", 2_000)
    monkeypatch.setattr("tagwright.llm.substrings.PART_BYTES", 3_000)
    rows = make_rows(seed)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, chunk int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, tuple(r.spans), bytes(r.kept)) for r in remove_repeats(docs, 40).collect()), key=str)
    assert got == brute(rows, 40)


def test_large_and_empty(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(1, passage * 2 + "z" * 100_000), (2, "y" + passage), (3, passage[:199])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in remove_repeats(docs).collect())
    assert got == [(1, 100_800), (2, 400), (3, 0)]
    assert remove_repeats(docs.limit(0)).count() == 0
