"""Words and their 64-bit hashes for whole Arrow batches.

Python workers receive texts as Arrow buffers. Words are found and hashed on the UTF-8 bytes of many texts at once, in
slices of bounded size, so the memory of a worker follows the slice and not the batch. A slice holds whole texts; only
a text that is larger than a slice makes a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def separators(spec: str) -> np.ndarray:
    """True at the bytes that separate words: ``space`` is \\x20 and \\x09-\\x0D, ``symbol`` all ASCII but 0-9A-Za-z."""
    table = np.zeros(256, bool)
    if spec == "space":
        table[[0x20, *range(0x09, 0x0E)]] = True
    else:
        table[:128] = True
        for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
            table[first : last + 1] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(size, base, _U)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(1 << 16, 1 << (length - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@dataclass
class Words:
    """The words of several texts: byte spans in ``data``, hashes, and the rows of the batch they belong to."""

    first_row: int
    rows: int
    data: np.ndarray  # bytes of all texts, lower-cased if asked for
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    row: np.ndarray  # index of the text, from 0
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]
    offsets: np.ndarray  # bytes of text i: offsets[i] to offsets[i + 1]

    def prefixes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``length`` bytes of the words that are longer, and which words those are."""
        long = np.flatnonzero(self.ends - self.starts > length)
        first = self.starts[long]
        acc = np.full(len(long), length, _U)
        for j in range(length):
            acc = acc * _U(0x9FB21C651E98DF25) + self.data[first + j].astype(_U)
        return mix(acc), long

    def rolled(self, size: int) -> np.ndarray:
        """Hashes of ``size`` words from every word on, also across the end of a text."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, _U)
        acc = np.zeros(n - size + 1, _U)
        for j in range(size):
            acc = acc * _U(0xD6E8FEB86659FD93) + self.hashes[j : n - size + 1 + j]
        return mix(acc + _U(size))

    def shingles(self, size: int, whole_if_shorter: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` consecutive words of one text, and the index of each one's first word.

        With ``whole_if_shorter`` a text of fewer words, but not none, has one shingle of all its words.
        """
        rolled = self.rolled(size)
        long = np.flatnonzero(self.row[: len(rolled)] == self.row[size - 1 :]) if len(rolled) else np.zeros(0, np.int64)
        hashes = rolled[long]
        if whole_if_shorter:
            counts = np.diff(self.bounds)
            short = np.flatnonzero((counts > 0) & (counts < size))
            extra = np.zeros(len(short), _U)
            for k, i in enumerate(short):
                acc = 0
                for h in self.hashes[self.bounds[i] : self.bounds[i + 1]].tolist():
                    acc = (acc * 0xD6E8FEB86659FD93 + h) & 0xFFFFFFFFFFFFFFFF
                extra[k] = (acc + int(counts[i])) & 0xFFFFFFFFFFFFFFFF
            if len(short):
                hashes = np.concatenate([hashes, mix(extra)])
                long = np.concatenate([long, self.bounds[short]])
                order = np.argsort(long, kind="stable")
                hashes, long = hashes[order], long[order]
        return hashes, long


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at, (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8))


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of a single larger row."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def words_of(column: pa.Array, kind: str, lower: bool, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a string column, a slice of its rows at a time."""
    table = separators(kind)
    offsets, data = _binary(column)
    for first, last in slices(offsets, limit):
        at = offsets[first : last + 1]
        raw = data[at[0] : at[-1]]
        at = at - at[0]
        yield _words(raw, at, table, lower, first, last)


def _words(raw: np.ndarray, at: np.ndarray, table: np.ndarray, lower: bool, first: int, last: int) -> Words:
    text = LOWER[raw] if lower else raw
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not(table[text], out=inside[1:-1])
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    # a word does not run on into the next text
    cuts = at[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(raw))])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    hashes = np.zeros(0, _U)
    if len(starts):
        up, down = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, _U)
        np.cumsum((text.astype(_U) + _U(1)) * up[: len(raw)], out=total[1:])
        hashes = (total[ends] - total[starts]) * down[starts]
        hashes = mix(hashes + (ends - starts).astype(_U))
    bounds = np.searchsorted(starts, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(bounds))
    return Words(first, last - first, text, starts, ends, hashes, row, bounds, at)
