"""Hashed word and character n-grams of a batch of texts, as arrays.

Every feature belongs to a group (an order of character n-gram, words, word pairs, repeats); a text's features of one
group weigh 1 / their number, so a group is an average and long texts weigh as much as short ones. Hashes are fixed, so
a model trained in one place is applied in another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from weirgauge.llm.wordhash import Words, mix

_STEP = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)


class Groups:
    """Bucket numbers per group: each (buckets, bounds), where text i's are buckets[bounds[i]:bounds[i + 1]]."""

    def __init__(self, texts: pa.Array, bits: int, orders: tuple[int, ...], words: bool = True, pairs: bool = False, repeats: bool = False):
        self.n = len(texts)
        self.groups: list[tuple[np.ndarray, np.ndarray]] = []
        self._characters(texts, bits, orders)
        if words or pairs or repeats:
            found = Words(texts)
            hashes, first = found.hashes(), found.first
            if words:
                self._add(self._bucket64(hashes, bits, 1), first)
            if pairs:
                both = mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
                last = first[1:][np.diff(first) > 0] - 1  # the last word of a text begins no pair in it
                keep = np.ones(len(both), bool)
                keep[last[last < len(both)]] = False
                counts = np.maximum(np.diff(first) - 1, 0)
                self._add(self._bucket64(both[keep], bits, 2), np.concatenate([[0], np.cumsum(counts)]))
            if repeats:
                self._add(self._bucket64(self._distances(hashes, first), bits, 3), first)

    def _add(self, buckets: np.ndarray, bounds: np.ndarray) -> None:
        self.groups.append((buckets, bounds))

    @staticmethod
    def _bucket64(hashes: np.ndarray, bits: int, kind: int) -> np.ndarray:
        return (mix(hashes ^ np.uint64(kind)) >> np.uint64(64 - bits)).astype(np.int64)

    @staticmethod
    def _distances(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each word, how far back in its text it last stood: 0 if never, else 1 + the distance's power of two."""
        text = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
        order = np.argsort(hashes ^ mix(text), kind="stable")
        same = (hashes[order[1:]] == hashes[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        out = np.zeros(len(hashes), np.uint64)
        gap = (order[1:] - order[:-1])[same]
        out[order[1:][same]] = 1 + np.floor(np.log2(gap)).astype(np.uint64)
        return out

    def _characters(self, texts: pa.Array, bits: int, orders: tuple[int, ...]) -> None:
        strings = [t or "" for t in texts.to_pylist()]
        code = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
        rolled = code * np.uint32(1)
        for order in range(1, max(orders, default=0) + 1):
            if order > 1:
                rolled = rolled[:-1] * _STEP + code[order - 1 :] if len(rolled) > 1 else rolled[:0]
            if order not in orders:
                continue
            buckets = ((rolled ^ np.uint32(order * 0x5BD1E995 & 0xFFFFFFFF)) * _SPREAD) >> np.uint32(32 - bits)
            keep = np.ones(len(buckets), bool)
            for back in range(1, order):
                at = bounds[1:] - back
                at = at[(at >= bounds[:-1]) & (at < len(keep))]
                keep[at] = False
            counts = np.maximum(np.diff(bounds) - order + 1, 0)
            self._add(buckets[keep].astype(np.int64), np.concatenate([[0], np.cumsum(counts)]))

    def means(self, table: np.ndarray) -> np.ndarray:
        """For each text, the sum over groups of the average of its features' rows in ``table``."""
        out = np.zeros((self.n, *table.shape[1:]), np.float64)
        for buckets, bounds in self.groups:
            counts = np.diff(bounds)
            some = np.flatnonzero(counts)
            if len(some):
                sums = np.add.reduceat(table[buckets], bounds[some], axis=0)
                out[some] += sums / counts[some].reshape(-1, *[1] * (table.ndim - 1))
        return out

    def sparse(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, its distinct buckets and their weights (float32), summed over groups."""
        out = []
        for i in range(self.n):
            parts = [b[x[i] : x[i + 1]] for b, x in self.groups]
            weights = [np.full(len(p), 1 / len(p)) for p in parts if len(p)]
            parts = [p for p in parts if len(p)]
            if not parts:
                out.append((np.zeros(0, np.uint32), np.zeros(0, np.float32)))
                continue
            buckets, where = np.unique(np.concatenate(parts), return_inverse=True)
            out.append((buckets.astype(np.uint32), np.bincount(where, np.concatenate(weights)).astype(np.float32)))
        return out
