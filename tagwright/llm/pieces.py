"""SentencePiece BPE encoding and decoding of whole texts by a table of last tokens per prefix.

A prefix of a text has exactly one encoding, so it has one last token.  A token that ends a
prefix is that last token when it is compatible with the last token of what stands before it:
merging the characters of the two tokens alone must give back those two tokens.  An automaton
names the tokens that end at each place; the ids are read off backwards.

Vocabularies in which no piece has a word-begin mark after another character can be encoded
between such places one by one, so each distinct word is worked out once per worker.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import blocks, frees, ranges, text_column

MARK = "▁"
# Words and pairs of pieces that a worker remembers; a little more memory or a little more work.
KEPT = (200_000, 1 << 20)
KEPT_LEAN = (150_000, 1 << 17)
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the file format (fixed values)
BPE = 2  # model type of the file format (fixed value)


class Pieces:
    """A BPE model with byte fallback, no text normalisation and no user-defined pieces."""

    def __init__(self, path: str, kept: tuple[int, int] = KEPT):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if model.trainer_spec.model_type != BPE or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: only BPE models without user-defined pieces can be used")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError(f"{path}: models that rewrite the text can't be used")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: models with word-end marks can't be used")
        self.dummy = MARK if spec.add_dummy_prefix else ""
        names = [p.piece for p in model.pieces]
        self.begin, self.end = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_id = [0] * 256
        plain: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_id[value] = i
                plain.append(bytes([value]))
            elif p.type == NORMAL:
                plain.append(p.piece.replace(MARK, " ").encode())
            else:
                plain.append(b"" if p.type == CONTROL else " ⁇ ".encode())
        lengths = np.array([len(x) for x in plain], dtype=np.int64)
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_start, self.plain_length = np.cumsum(lengths) - lengths, lengths
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.names, self.kept = names, kept
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id_of)
        self.parts = re.compile(r"(?s).+" if inner else f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.known_alone = bytearray(len(names))  # 0: not known, 1: no, 2: yes
        self.known_fits: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.row_of: dict[str, int] = {}
        self.flat, self.start, self.length = array("i"), array("q"), array("q")

    def alone(self, token: int) -> bool:
        """Whether merging the characters of a piece gives the piece."""
        if not self.known_alone[token]:
            name = self.names[token]
            self.known_alone[token] = 1 + (self.merged(name) == [name])
        return self.known_alone[token] == 2

    def fits(self, pair: int) -> bool:
        """Whether two pieces, as first * vocabulary + second, stay apart side by side."""
        a, b = divmod(pair, len(self.names))
        left, right = self.names[a], self.names[b]
        if len(self.known_fits) >= self.kept[1]:
            self.known_fits.clear()
        found = self.known_fits[pair] = self.merged(left + right) == [left, right]
        return found

    def merged(self, text: str) -> list[str]:
        """The pieces that merging the characters of a short text leads to."""
        symbols = list(text)
        while True:
            best = None
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = (score, i)
            if best is None:
                return symbols
            i = best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    def tokens(self, text: str) -> list[int]:
        """Ids of one part by its prefix table; -1-c in the table marks a character without piece."""
        if text in self.id_of and self.alone(self.id_of[text]):
            return [self.id_of[text]]
        last, width = [0] * len(text), [0] * len(text)
        known, many = self.known_fits, len(self.names)
        for end, (token, size) in self.automaton.iter(text):
            if width[end]:
                continue
            before = end - size
            if before < 0 or not width[before] or last[before] < 0:
                right = before < 0 or width[before] < 0 or last[before] < 0
                right = (right or text[before] not in self.id_of) and self.alone(token)
            else:
                pair = last[before] * many + token
                right = known.get(pair)
                if right is None:
                    right = self.fits(pair)
            if right:
                last[end], width[end] = token, size
        out: list[int] = []
        end = len(text) - 1
        while end >= 0:
            if width[end]:
                out.append(last[end])
                end -= width[end]
            else:
                out.extend(self.byte_id[b] for b in reversed(text[end].encode()))
                end -= 1
        out.reverse()
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of the texts in them), begin and end ids included."""
        if len(self.row_of) > self.kept[0]:
            self._forget()
        parts, count = [], np.zeros(len(texts) + 1, dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                parts += self.parts(self.dummy + text.replace(" ", MARK))
            count[i + 1] = len(parts)
        for part in set(parts).difference(self.row_of):
            ids = self.tokens(part)
            self.row_of[part] = len(self.start)
            self.start.append(len(self.flat))
            self.length.append(len(ids))
            self.flat.extend(ids)
        rows = np.fromiter(map(self.row_of.__getitem__, parts), np.int64, len(parts))
        length = np.array(self.length, dtype=np.int64)[rows]
        inner = np.array(self.flat, dtype=np.int32)[ranges(np.array(self.start, dtype=np.int64)[rows], length)]
        ends = np.concatenate([[0], np.cumsum(length)])[count]
        offsets = ends + 2 * np.arange(len(texts) + 1)
        ids = np.empty(offsets[-1], dtype=np.int32)
        body = np.ones(len(ids), dtype=bool)
        body[offsets[:-1]] = body[offsets[1:] - 1] = False
        ids[offsets[:-1]], ids[offsets[1:] - 1], ids[body] = self.begin, self.end, inner
        return ids, offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, offsets) of the texts of id lists; the added first blank goes again."""
        length = self.plain_length[ids]
        values = self.plain[ranges(self.plain_start[ids], length)]
        ends = np.concatenate([[0], np.cumsum(length)])[offsets]
        if self.dummy:
            some = np.flatnonzero(ends[1:] > ends[:-1])
            first = ends[some]
            blank = values[first] == 0x20
            keep = np.ones(len(values), dtype=bool)
            keep[first[blank]] = False
            lost = np.zeros(len(ends), dtype=np.int64)
            lost[some[blank] + 1] = 1
            values, ends = values[keep], ends - np.cumsum(lost)
        return values, ends


_models: dict[tuple, Pieces] = {}


def model(path: str, kept: tuple[int, int] = KEPT) -> Pieces:
    if (path, kept) not in _models:
        _models[path, kept] = Pieces(path, kept)
    return _models[path, kept]


def encode_documents(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text: str = "text", kept: tuple[int, int] = KEPT
) -> DataFrame:
    """(id, n_tokens, ids, decoded) for each row: the ids with begin and end id as
    little-endian 32-bit integers, and the text that they decode to.

    A null text counts as empty: its ids are the begin and the end id.  Rows with equal ids
    stay apart, other columns (whatever their names) are not read, an empty table gives no
    row, and texts of any length are encoded whole.  ``model_path`` must be readable on
    every worker.  ``kept`` bounds what a worker remembers and changes no result."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(model_path, kept)
        for block in blocks(batches, "_text"):
            texts = block.column("_text").to_pylist()
            ids, offsets = pieces.encode(texts)
            values, ends = pieces.decode(ids, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("_id"),
                    pa.array(np.diff(offsets)),
                    text_column(ids.astype("<i4").view(np.uint8), offsets * 4, pa.binary()),
                    text_column(values, ends),
                ],
                names=[id_column, "n_tokens", "ids", "decoded"],
            )

    source = docs.select(docs[id_column].alias("_id"), docs[text].alias("_text"))
    return source.mapInArrow(frees(run), f"`{id_column}` {kind}, n_tokens long, ids binary, decoded string")
