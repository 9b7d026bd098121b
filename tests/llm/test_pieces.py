"""Prefix-table encoding against the sentencepiece library, text by text."""

import hashlib
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402

from tagwright.llm.pieces import Pieces, encode_documents  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    rng = random.Random(5)
    texts = ["", " ", "  a", "a  b   c", " leading", "trailing  ", "\n\n x\ty", "a▁b", "<s> </s> <unk> <0x41>", "日本語と\U0001f600‍", "é�\x00z", "naïve façade 12345 2024-01-01", "x" * 3000, "ab" * 2000, " " * 50, "é" * 500]
    letters = "abcdefghij ABC  .,\n'12▁éßñ漢\U0001f600"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    syllables = ["th", "er", "on", "tion", " the ", " ", "ing", "Qu", "!", "  ", "http://", "\n", "éa"]
    texts += ["".join(rng.choice(syllables) for _ in range(rng.randrange(40))) for _ in range(2000)]
    return texts


def test_ids_and_text_equal_the_library(library):
    texts = odd_texts()
    pieces = Pieces(PATH)
    ids, offsets = pieces.encode(texts)
    values, ends = pieces.decode(ids, offsets)
    for i, text in enumerate(texts):
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert ids[offsets[i] : offsets[i + 1]].tolist() == expected, repr(text)
        assert values[ends[i] : ends[i + 1]].tobytes().decode() == library.decode(expected), repr(text)


def test_rows(spark, library):
    text = "Some words,  and more.\n" * 30_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "ab", "x"), (3, "ab", "y"), (None, "c", "z"), (5, text, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in encode_documents(docs, PATH).collect()}
    want = set()
    for doc_id, value, _ in rows:
        ids = library.encode(value or "", add_bos=True, add_eos=True)
        want.add((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), library.decode(ids)))
    assert got == want
    assert encode_documents(docs.limit(0), PATH).count() == 0
