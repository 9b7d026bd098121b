"""The stages and the whole pipeline against brute force on a small fixture."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import test_contamination, test_jaccard, test_language, test_lines

sentencepiece = pytest.importorskip("sentencepiece")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    rng = random.Random(4)
    vocabulary = {"en": ["the", "and", "with", "house", "over"], "fr": ["été", "une", "leur", "chez", "où"]}
    items = [(i, " ".join(rng.choice(vocabulary["en"]) for _ in range(20))) for i in range(3)]
    rows = []
    for i in range(40):
        lang = rng.choice(["en", "fr"])
        line = lambda: " ".join(rng.choice(vocabulary[lang]) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 14)))  # noqa: E731, B023
        rows.append([i, "\n".join(line() for _ in range(rng.randrange(1, 6))), lang, f"s{i % 3}"])
    for i in range(40, 60):
        base = rows[rng.randrange(40)]
        rows.append([i, base[1].replace(" ", "  ", 1) + " tail" * rng.randrange(3), base[2], "s0"])
    rows += [[60 + i, "lead in " + t + " end", "en", "s1"] for i, (_, t) in enumerate(items)]
    rows += [[70, None, "en", "s1"], [71, "", None, None], [72, "123 !!", "en", "s9"], [73, rows[5][1], None, None], [74, "word " * 9000, "en", "s2"]]
    return [tuple(r) + (len(r[1] or ""),) for r in rows], items


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, items = fixture()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    found = test_language.brute([(r[1], r[2]) for r in rows], [(r[1], r[2], r[3]) for r in rows])
    kept = [(r[0], r[1]) for r, f in zip(rows, found, strict=True) if f[2]]
    assert 0 < len(kept) < len(rows)
    kept = [(r[0], r[1]) for r in test_lines.brute(kept)]
    kept = [r for r in kept if dict((i, c) for i, _, c in test_jaccard.brute(kept))[r[0]] == r[0]]
    hits = {i: (w, h) for i, w, h, _ in test_contamination.brute(kept, items, 13)}
    kept = [r for r in kept if not (hits[r[0]][1] > 0 and 20 * hits[r[0]][1] >= hits[r[0]][0])]
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.tokenizer_path("piece_bpe_32k.model"))
    expected = []
    for i, text in kept:
        ids = library.encode(text, add_bos=True, add_eos=True)
        expected.append((i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(expected)


def test_stages_on_empty_and_odd_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    extra = ", row string, id int, n_lines int, language string, accepted string"
    more = [(1, "the old house over there", "en", None, 24, None, 1, 2, "x", "y"), (None, "a second house over here", None, "s", None, "r", 1, 2, None, "z")]
    docs = spark.createDataFrame(more, SCHEMA + extra)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        out = stage(spark, docs, sf_dir)
        assert out.count() == 2, name
        if name != "encoding":
            assert out.columns == docs.columns
            assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect())) or name == "lines"
