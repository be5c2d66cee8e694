"""Words of a column of texts as numpy arrays: places, hashes and window hashes without a loop over words.

A word is a run of bytes other than space and 0x09-0x0D (or other than the
bytes that the caller marks). Texts are taken from the Arrow buffers in blocks of a few
megabytes, so the memory stays bounded however many rows a batch has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 2 << 20  # bytes of text handled at a time (more only for one longer text)

_M = (1 << 64) - 1
#: Fixed odd multipliers of the polynomial hashes (bytes in a word, words in a window) and their inverses.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Bytes between words; NOT_ALNUM also cuts at ASCII punctuation and control bytes.
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Code points (first, last) of scripts written without blanks: Thai and Lao, Myanmar, Khmer, kana, Han.
SINGLES = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
           (0xF900, 0xFAFF), (0x20000, 0x33FFF))


class _Powers:
    """base**k modulo 2**64, grown when needed."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), _M + 1))
            self.table = np.concatenate([self.table, self.table * step])
        return self.table[:n]


_POW = {b: (_Powers(b), _Powers(pow(b, -1, _M + 1))) for b in (BYTE_BASE, WORD_BASE)}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:stop] for each pair of places; equal runs of values give equal hashes."""
    power, inverse = _POW[base]
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power.upto(len(values)), out=total[1:])
    h = (total[stop] - total[start]) * inverse.upto(len(values) + 1)[start]
    return mix(h + mix((stop - start).astype(np.uint64)))


@dataclass
class Words:
    """Words of ``n`` texts: bytes ``data[start:stop]``; text i has the words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    text_bounds: np.ndarray

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(word number, hash) of every window of so many words that lies within one text."""
        if len(self.hashes) < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(len(self.hashes) - length + 1)
        doc_end = np.repeat(self.first[1:], np.diff(self.first))[:len(at)]
        at = at[at + length <= doc_end]
        return at, span_hash(self.hashes, at, at + length, WORD_BASE)


def _singles(data: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(places, bytes each) of the characters of ``SINGLES`` in valid UTF-8."""
    for width, lead, mask in ((3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        at = np.flatnonzero((data >= lead) & (data <= (lead | mask)))
        code = data[at].astype(np.int64) & mask
        for k in range(1, width):
            code = code << 6 | data[at + k] & 63
        alone = np.zeros(len(at), bool)
        for first, last in SINGLES:
            alone |= (code >= first) & (code <= last)
        yield at[alone], width


def _split(data: np.ndarray, bounds: np.ndarray, between: np.ndarray, singles: bool = False) -> Words:
    blank = between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True  # words end at the end of their text
    if singles and len(data) and data.max() >= 0xE0:
        for at, width in _singles(data):
            edge[at] = edge[at + width] = True
    word = ~blank
    before = np.concatenate([[False], word[:-1]]) if len(data) else word
    start = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate([word[1:], [False]]) if len(data) else word
    stop = np.flatnonzero(word & (~after | edge[1:])) + 1
    h = span_hash(data.astype(np.uint64) + np.uint64(1), start, stop, BYTE_BASE)
    return Words(data, start, stop, np.searchsorted(start, bounds), h, bounds)


def blocks(texts: pa.Array, between: np.ndarray = BLANK, block: int = BLOCK,
           singles: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, words) over blocks of rows; ``between`` marks the bytes between words, and with
    ``singles`` every character of ``SINGLES`` is a word. A null text has no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    body = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block, "right")) - 1)
        to = min(to, n)
        data = body[offsets[at]:offsets[to]]
        yield at, to, _split(data, offsets[at:to + 1] - offsets[at], between, singles)
        at = to
