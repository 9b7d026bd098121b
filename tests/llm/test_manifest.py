"""Merkle manifest and audit against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tagwright.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    doc_id, _, lang, source, n_chars = row
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def lowered(row):
    doc_id, text = row[:2]
    if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 3:
        return text
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fold(nodes):
    """(top, proof of each node): a proof lists (siblings before, siblings after)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            first = k // 8 * 8
            run = nodes[first : first + 8]
            proofs[i].append((run[: k - first], run[k - first + 1 :]))
        at = [k // 8 for k in at]
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = []
    for lang in langs:
        own = [(r, leaf_of(r, r[1]), leaf_of(r, lowered(r))) for r in rows if r[2] == lang]
        groups.append(sorted(own, key=lambda x: (x[0][0] is not None, x[0][0] or 0, bytes.fromhex(x[1]))))
    tops = [fold([x[1] for x in g]) for g in groups]
    root, upper = fold([t[0] for t in tops])
    out = []
    for group, (subroot, proofs), above in zip(groups, tops, upper, strict=True):
        for (row, leaf, changed), proof in zip(group, proofs, strict=True):
            path, folded = proof + above, changed
            for before, after in path:
                folded = sha("".join([*before, folded, *after]))
            siblings = "".join("".join(b) + "".join(a) for b, a in path)
            out.append((row[0], leaf, subroot, root, sha(siblings), folded, folded == root))
    return sorted(out, key=str)


def run(spark, rows, more=""):
    docs = spark.createDataFrame(rows, SCHEMA) if not more else spark.createDataFrame(rows, SCHEMA).withColumn(more, F.lit(1))
    found = manifest.audit(manifest.build_manifest(docs, manifest.lower_text(docs)))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def make_rows(seed, n, langs):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        doc_id = rng.choice([None, rng.randrange(-n, 2 * n), rng.randrange(10**12)])
        text = rng.choice([None, "", "Été Ab cD", "plain", "Z" * rng.randrange(300)])
        rows.append((doc_id, text, rng.choice(langs), rng.choice([None, "", "site:1"]), rng.choice([None, 0, -7, 12])))
    return rows + rows[: n // 10]


@pytest.mark.parametrize(
    ("n", "langs"),
    [(1, ["en"]), (2, [None]), (9, ["a", "b"]), (65, ["en"]), (600, ["en", "de", None, "", "é", "zz"]), (300, [f"l{i}" for i in range(90)])],
)
def test_against_plain_tree(spark, n, langs):
    rows = make_rows(n, n, langs)
    assert run(spark, rows) == brute(rows)


def test_more_than_one_block(spark, monkeypatch):
    """Runs over more than a block are repeated for each block beneath them."""
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK_BITS", 3)
    rows = make_rows(5, 700, ["en"] * 6 + ["de", "fr", None])
    assert run(spark, rows) == brute(rows)


def test_empty_and_odd_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, "x" * 300_000, "en", "s", 1)] * 20, "tree") == brute([(3, "x" * 300_000, "en", "s", 1)] * 20)
    only_null = [(None,) * 5] * 10
    assert run(spark, only_null, "idx") == brute(only_null)


def test_tampering_is_found(spark):
    rows = [(i, "Text A" if i % 2 else "text", "en", "s", 6) for i in range(100)]
    verified = {r[0]: r[-1] for r in run(spark, rows)}
    assert verified == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 3 == 0) for i in range(100)}
    assert 0 < sum(verified.values()) < 100


def test_limits_of_the_session_stay(spark):
    names = ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit")
    before = [spark.conf.get(n, None) for n in names]
    run(spark, make_rows(1, 20, ["en"]))
    assert [spark.conf.get(n, None) for n in names] == before
