"""Line removal against a comparison of all lines."""

import random
import re

import pytest

from tagwright.llm.lines import deduplicate_lines


def near(a, b):
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    lines = []
    for row, (i, text) in enumerate(rows):
        for no, line in enumerate(text.split("\n") if text is not None else []):
            w = re.findall(r"[^\x20\x09-\x0D]+", line)
            lines.append((row, (1 if i is None else 0, i or 0, no), no, w))
    judged = [x for x in lines if len(x[3]) >= 5]
    gone = {(x[0], x[2]) for x in judged if any(y[1] < x[1] and near(x[3], y[3]) for y in judged)}
    out = []
    for row, (i, text) in enumerate(rows):
        parts = text.split("\n") if text is not None else []
        kept = [x for no, x in enumerate(parts) if (row, no) not in gone]
        out.append((i, None if text is None else "\n".join(kept), len(parts), tuple(no for no in range(len(parts)) if (row, no) in gone)))
    return sorted(out, key=str)


def make_rows(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "dé", "e", "f"])
    pool = [[word() for _ in range(rng.randrange(3, 12))] for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(7)):
            line = list(rng.choice(pool)) if rng.random() < 0.7 else [word() for _ in range(rng.randrange(14))]
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
            lines.append(rng.choice([" ", "  ", "\t"]).join(line) + rng.choice(["", "\r", " "]))
        rows.append((i * 2, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "\n"), (None, "a b c d e f"), (None, None), (504, "w " * 20_000), (505, "w " * 20_001)]
    rows += [(7, rows[3][1]), (506, " ".join(["a"] * 8)), (507, " ".join(["a"] * 7)), (508, "x\n" * 3 + "q r s t u\nq r s t u")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_brute_force(spark, seed, monkeypatch):
    if seed > 1:
        monkeypatch.setattr("tagwright.llm.rounds.CHUNK_BYTES", 1_000)
        monkeypatch.setattr("tagwright.llm.rounds.PART_BYTES", 10_000)
    rows = make_rows(seed)
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, n_lines int, removed string")
    got = deduplicate_lines(docs)
    assert sorted(((r.doc_id, r.text, r.n_lines, tuple(r.removed)) for r in got.collect()), key=str) == brute(rows)


def test_carried_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "en"), (2, "a b c d e\nz", None)], "doc_id long, text string, lang string")
    got = sorted((r.doc_id, r.text, r.lang) for r in deduplicate_lines(docs, carry=("lang",)).collect())
    assert got == [(1, "a b c d e", "en"), (2, "z", None)]
    assert deduplicate_lines(docs.limit(0)).count() == 0
