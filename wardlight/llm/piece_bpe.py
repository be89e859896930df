"""Piece encoding and decoding: a prefix table of last tokens, read backwards.

The encoding by merges of every beginning of a text is unique, and so is its last token. That token is found among the
pieces which an automaton finds to end there: it is the one that is compatible with the last token of the beginning
before it. Two tokens are compatible if the merges leave their concatenation as just these two. The table has one entry
for each character; from its end the tokens of the text are read backwards.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
#: words kept with their ids by a worker, and the longest of them; others are encoded anew each time
CACHED_WORDS, CACHED_CHARS = 60_000, 64
#: pairs of tokens whose compatibility a worker keeps
CACHED_PAIRS = 500_000
#: rows that a worker encodes or decodes together
ROWS = 1000


class Recent:
    """A bounded map: when it is full, what was used since it last was full stays within reach for as long again."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value


class PieceModel:
    """Pieces, scores and byte ids of a merge model with byte fallback, identity normalisation and a leading space."""

    def __init__(self, model: bytes):
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = own.get_piece_size()
        if own.normalize(" ﬁ  x ") != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("only models with identity normalisation, a leading space and all white space are known")
        self.byte_ids = {int(own.id_to_piece(i)[3:5], 16): i for i in range(size) if own.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("only models with byte fallback are known")
        special = {i for i in range(size) if own.is_byte(i) or own.is_control(i) or own.is_unknown(i) or own.is_unused(i)}
        #: pieces that merges may make, and their scores: the higher, the earlier
        self.scores = {own.id_to_piece(i): own.get_score(i) for i in range(size) if i not in special}
        self.ids = {own.id_to_piece(i): i for i in range(size) if i not in special}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece may hold spaces at its beginning only")
        self.automaton = ahocorasick.Automaton()
        #: by token: what is known of the tokens before it
        self._followers: dict[str, dict[str, bool]] = {}
        self._pairs = 0
        for piece in self.ids:
            # a piece that merges never make whole is never a token
            if self.merged(piece) == [piece]:
                self._followers[piece] = {}
                self.automaton.add_word(piece, (piece, len(piece), self._followers[piece]))
        self.automaton.make_automaton()
        #: characters that stand next to each other in some piece
        self.neighbours = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        if any("\n" in pair for pair in self.neighbours):
            raise ValueError("a piece may not reach over the end of a line")
        self._words, self._parts = Recent(CACHED_WORDS), Recent(CACHED_WORDS)
        byte_values = {i: bytes([value]) for value, i in self.byte_ids.items()}
        texts = {i: piece.replace(SPACE, " ").encode() for piece, i in self.ids.items()}
        #: bytes that each id stands for; control ids stand for none
        self.decoded = pa.array(
            [byte_values.get(i, texts.get(i, b" \xe2\x81\x87 " if own.is_unknown(i) else b"")) for i in range(size)],
            pa.large_binary(),
        )

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: always the pair of the highest score, of equal ones the leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, first: str, second: str) -> bool:
        """Whether merges leave two tokens that follow each other as they are; nothing stands before a text's first."""
        known = self._followers[second]
        fits = known.get(first)
        if fits is None:
            if self._pairs >= CACHED_PAIRS:
                for each in self._followers.values():
                    each.clear()
                self._pairs = 0
            fits = known[first] = not first or self.merged(first + second) == [first, second]
            self._pairs += 1
        return fits

    def tokens(self, text: str) -> list[str]:
        """The pieces of a text; a character without a piece is a token of its own."""
        #: by the length of a beginning of the text: the last token of its encoding
        last = ["", *text]
        settled = -1
        for end, (piece, size, followers) in self.automaton.iter(text):  # by end: shorter beginnings are settled
            if end != settled:
                before = last[end + 1 - size]
                fits = followers.get(before)
                if fits is None:
                    fits = self.compatible(before, piece)
                if fits:
                    last[end + 1] = piece
                    settled = end
        out, at = [], len(text)
        while at:
            piece = last[at]
            out.append(piece)
            at -= len(piece)
        out.reverse()
        return out

    def parts(self, word: str) -> list[str]:
        """A word cut between characters that stand next to each other in no piece: no token reaches over such a cut."""
        if word[1:].isalpha():
            return [word]  # hardly ever cut, and right without
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.neighbours]
        return [word[a:z] for a, z in zip([0, *cuts], [*cuts, len(word)])]

    def _encoded(self, text: str) -> bytes:
        pieces = self.tokens(text)
        try:
            ids = [self.ids[piece] for piece in pieces]
        except KeyError:
            ids = []
            for piece in pieces:
                own = self.ids.get(piece)
                ids += [own] if own is not None else [self.byte_ids[b] for b in piece.encode()]
        return struct.pack(f"<{len(ids)}i", *ids)

    def word_ids(self, word: str) -> bytes:
        """The ids of a word, its spaces in front, as 32-bit integers."""
        found = self._words.get(word)
        if found is None:
            parts = self.parts(word.replace(" ", SPACE))
            if len(parts) == 1:
                found = self._encoded(parts[0])
            else:
                found = b"".join([self._parts.get(part) or self._part(part) for part in parts])
            if len(word) <= CACHED_CHARS:
                self._words.put(word, found)
        return found

    def _part(self, part: str) -> bytes:
        found = self._encoded(part)
        if len(part) <= CACHED_CHARS:
            self._parts.put(part, found)
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers. No piece reaches over the beginning of a run of spaces, nor a line."""
        if not text:
            return b""
        words = re.findall("\n| +[^ \n]*|[^ \n]+", " " + text.replace(SPACE, " "))
        known = self._words.new.get
        return b"".join([known(word) or self.word_ids(word) for word in words])

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        out = self._decode(np.asarray(ids, np.int64), np.array([0, len(ids)]))
        return out[0]

    def _decode(self, values: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ids; the space that encoding puts in front goes."""
        pieces = self.decoded.take(pa.array(values, pa.int64()))
        _, at, data = pieces.buffers()
        at = np.frombuffer(at, np.int64)[: len(values) + 1]
        data = memoryview(data) if data is not None else memoryview(b"")
        bounds = at[offsets].tolist()
        out = []
        for i, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False)):
            text = bytes(data[first:last])
            if text.startswith(b" ") and self.decoded[int(values[offsets[i]])].as_py().startswith(b" "):
                text = text[1:]
            out.append(text.decode("utf-8", "replace"))
        return out


@cache
def _model(content: bytes) -> PieceModel:
    return PieceModel(content)


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _ddl(frame: DataFrame, names: Sequence[str]) -> str:
    return "".join(f"`{name}` {frame.schema[name].dataType.simpleString()}, " for name in names)


def encode(documents: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and ``ids``, the ids of its text (array of int).

    The ids are those that the sentencepiece library gives without begin and end ids and without sampling. A null or
    empty text has none, whole texts are encoded however long, and a character that the model lacks becomes its bytes.
    Repeated rows stay. Of the other columns none is read, whatever its name; a column ``ids`` cannot be kept. No rows
    give none. The model is read by the driver and travels with the function; its size is that of its vocabulary.
    """
    content = _content(model_path)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(content)
        for batch in _small(batches):
            packed = [model.encode(value.as_py() or "") for value in batch.column(len(names))]
            sizes = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.frombuffer(b"".join(packed), "<i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], ids], [*names, "ids"])

    return documents.select(*names, text).mapInArrow(run, _ddl(documents, names) + "ids array<int>")


def decode(encoded: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id", "ids")) -> DataFrame:
    """The columns ``keep`` of every row and ``decoded``, the text of its ``ids``.

    Ids that stand for bytes are put together; bytes that are no UTF-8 become U+FFFD. Null or empty ids are the empty
    text. A column ``decoded`` cannot be kept. No rows give none.
    """
    content = _content(model_path)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(content)
        for batch in _small(batches):
            ids = batch.column(len(names))
            if ids.null_count:
                ids = ids.fill_null([])
            offsets = ids.offsets.to_numpy().astype(np.int64)
            values = ids.values.to_numpy()[offsets[0] : offsets[-1]]
            texts = model._decode(values, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string())], [*names, "decoded"])

    rows = encoded.select(*names, encoded["ids"].alias("_ids"))
    return rows.mapInArrow(run, _ddl(encoded, names) + "decoded string")
