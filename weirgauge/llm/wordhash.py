"""Vectorised word and n-gram hashing over one contiguous UTF-8 buffer.

A word is a maximal run of bytes other than space and 0x09-0x0D; UTF-8 never uses those bytes inside a character, so
splitting bytes and splitting characters agree. All hashes are 64-bit polynomials modulo 2**64 over random byte values,
finished by a mixing step; equal words give equal hashes in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SEPARATORS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)


def _byte_values(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64, 256, dtype=np.uint64)


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 2**64))


_BLOCK = 1 << 17
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each; kept for blocks of the usual length."""
    found = _TABLES.get(int(base))
    if found is None or len(found[0]) < n:
        found = powers(base, max(n, 2 * _BLOCK)), powers(_inverse(base), max(n, 2 * _BLOCK))
        if n <= 2 * _BLOCK:
            _TABLES[int(base)] = found
    return found[0][:n], found[1][:n]


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher, so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the n + 1 offsets of the texts; a null text is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch of texts: start and end byte of each, and for each text its range of words."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.bytes, self.offsets = text_buffer(texts)
        if lower:
            self.bytes = LOWER[self.bytes]
        inside = np.zeros(len(self.bytes) + 2, dtype=bool)
        inside[1:-1] = _IS_WORD[self.bytes]
        begins = inside[1:] & ~inside[:-1]
        ends = inside[:-1] & ~inside[1:]
        if len(self.bytes):  # a word never runs over the end of its text
            cut = self.offsets[1:-1]
            cut = cut[cut < len(self.bytes)]
            both = inside[cut] & inside[cut + 1]
            begins[cut[both]] = True
            ends[cut[both]] = True
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends)
        self.first = np.searchsorted(self.starts, self.offsets)  # words first[i] .. first[i + 1] are text i's

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """One hash for each word."""
        out = np.zeros(len(self.starts), np.uint64)
        values = _byte_values(seed)
        i = 0
        while i < len(out):  # blocks of whole words, small enough for the processor's cache
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + _BLOCK, side="right")))
            low, high = self.starts[i], self.ends[j - 1]
            n = int(high - low)
            forth, back = _tables(_BASE, n + 1)
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(values[self.bytes[low:high]] * forth[:n], out=total[1:])
            start = self.starts[i:j] - low
            out[i:j] = (total[self.ends[i:j] - low] - total[start]) * back[start]
            i = j
        return mix(out)


def windows(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the words i .. i + width - 1 for every i; those that run over a text's end are the caller's to leave out."""
    n = len(word_hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(0, len(out), _BLOCK):
        part = word_hashes[i : i + _BLOCK + width - 1]
        forth, back = _tables(_WORD_BASE, len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * forth, out=total[1:])
        out[i : i + _BLOCK] = (total[width:] - total[:-width]) * back[: len(part) - width + 1]
    return mix(out)


def inside(first: np.ndarray, width: int) -> np.ndarray:
    """Mask of the windows that stay within one text, given each text's first word."""
    n = int(first[-1])
    ok = np.ones(max(n - width + 1, 0), dtype=bool)
    for back in range(1, width):  # a window that starts so many words before a text's end is too long for it
        at = first[1:] - back
        at = at[(at >= first[:-1]) & (at < len(ok))]
        ok[at] = False
    return ok
