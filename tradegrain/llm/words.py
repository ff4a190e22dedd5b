"""Words and their 64-bit hashes, for a whole batch of texts at once, in numpy.

A text is handled as its UTF-8 bytes. Both kinds of word used here are sets of bytes: all bytes
of a character outside ASCII belong to words, so that no character is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh64_intdigest

PIECE_BYTES = 2 << 20  # texts are hashed in pieces of about this size; a longer text is one piece

_ALL = np.arange(256)
_LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower-cased, and [^\x20\x09-\x0D]+
LETTERS = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
NON_SPACE = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))

_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_HALF = np.uint64(32)
_LONG_WORD = 512         # bytes
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    x = a * _A + b
    x ^= x >> _HALF
    x *= _B
    x ^= x >> _HALF
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts or binary values (null: empty), and where each begins and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `limit` bytes each; at least one row in each."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high
        low = high


class Words:
    """The words of a piece: byte ranges, and the first word of each text (`first`, one more)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool):
        self.data, self.offsets = _LOWER[data] if lower else data, offsets
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = kind[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begins[edges] |= inside[edges]
        # A word ends before a byte that is outside or begins another word (of the next text).
        ends = np.zeros(len(data) + 1, bool)
        ends[1:] = inside[:-1] & (~inside[1:] | begins[1:])
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends)
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """64 bits of each word: its length, mixed with eight bytes after eight; long words, of
        which there are few, by XXH64. Words of one length up to eight bytes never share them."""
        lengths = self.ends - self.starts
        data = np.append(self.data, np.zeros(8, np.uint8))
        eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        found = lengths.astype(np.uint64)
        live = np.flatnonzero(lengths <= _LONG_WORD)
        for at in range(0, _LONG_WORD, 8):
            live = live[lengths[live] > at]
            if not len(live):
                break
            rest = np.minimum(lengths[live] - at, 8)
            found[live] = mix(found[live], eights[self.starts[live] + at] & _FIRST_BYTES[rest])
        for i in np.flatnonzero(lengths > _LONG_WORD):
            found[i] = xxh64_intdigest(self.word(i))
        return found

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def lengths(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)


def each_piece(texts: pa.Array, kind: np.ndarray, lower: bool,
               limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, words) of each piece of a column of texts."""
    data, offsets = buffers(texts)
    for low, high in pieces(offsets, limit):
        part = offsets[low:high + 1]
        yield low, high, Words(data[part[0]:part[-1]], part - part[0], kind, lower)


def same_text(first: np.ndarray, length: int) -> np.ndarray:
    """For each word, whether the `length` words from it on lie within its text."""
    n = int(first[-1])
    ok = np.zeros(n, bool)
    if n:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        ok = np.arange(n) + length <= first[1:][text]
    return ok
