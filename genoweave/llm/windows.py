"""What decontamination and licence scans share: known passages, and the windows of a text that are worth a fingerprint."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

from genoweave.llm.common import WordHashes, mix, windows_hash, words_of

SHINGLE = 5
#: Shingles of which the bits are counted at a time, so that a very long text needs little memory.
PART = 1 << 14


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Shingle hashes of a passage; one of all words if there are fewer than `size`; none of none."""
    return windows_hash(hashes, min(size, len(hashes))) if len(hashes) else np.zeros(0, np.uint64)


def in_parts(starts: np.ndarray, span: int = PART) -> Iterator[np.ndarray]:
    """Sorted starts in runs that lie within so many places."""
    while len(starts):
        n = int(np.searchsorted(starts, starts[0] + span))
        yield starts[:n]
        starts = starts[n:]


def simhash(hashes: np.ndarray) -> np.uint64:
    return simhashes(hashes, np.array([0]), len(hashes))[0]


def simhashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the runs of `size` shingles at each start (near each other): repeats weigh as often as they occur."""
    lo = int(starts.min())
    part = hashes[lo : int(starts.max()) + size]
    bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)))
    ones = sums[starts - lo + size] - sums[starts - lo]
    return np.packbits(2 * ones > size, axis=1, bitorder="little").view("<u8")[:, 0]


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the least over the sum of the largest count of each shingle."""
    if not len(a) or not len(b):
        return 0.0
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[i], m[j]).sum())
    return shared / (len(a) + len(b) - shared)


@dataclass
class Passage:
    key: object
    words: int
    shingles: np.ndarray
    distinct: np.ndarray


class Passages:
    """Known passages, of bounded number and size, as each task holds all: by the words of their shingles and by their length."""

    def __init__(self, rows: list[tuple[object, str | None]], plain: Callable[[bytes], bytes] | None = None):
        known = WordHashes(plain=plain)
        self.items: list[Passage] = []
        for key, text in rows:
            h = known.of(words_of(text, lower=True))
            h = h[h != 0] if plain else h
            if len(h):
                s = shingles(h)
                self.items.append(Passage(key, len(h), s, np.unique(s)))
        #: words of a shingle -> all shingles of the passages
        self.known: dict[int, np.ndarray] = {}
        #: words of a shingle -> shingles of a passage -> passages
        self.by_size: dict[int, dict[int, np.ndarray]] = {}
        for words in sorted({min(SHINGLE, p.words) for p in self.items}):
            own = [(len(p.shingles), i) for i, p in enumerate(self.items) if min(SHINGLE, p.words) == words]
            self.known[words] = np.unique(np.concatenate([self.items[i].distinct for _, i in own]))
            self.by_size[words] = {n: np.array([i for m, i in own if m == n]) for n in sorted({m for m, _ in own})}

    def windows(self, h: np.ndarray, need: Callable[[int, int], float], longest: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
        """(words of a shingle, length of the passages, the text's shingles, starts, shingles of a window): for each length of
        passages the windows of the text's words h that hold at least need(length, window) shingles of any passages.

        This only leaves out windows that no passage can be like; which passages a window is like is not looked at. A text
        shorter than a passage is one window, if the passage is at most `longest` times as long."""
        for words, lengths in self.by_size.items():
            if len(h) < words:
                continue
            s, known = windows_hash(h, words), self.known[words]
            at = np.searchsorted(known, s)
            at[at == len(known)] = 0
            here = known[at] == s
            total = int(here.sum())
            if not total:
                continue
            sums = np.concatenate(([0], np.cumsum(here, dtype=np.int64)))
            for n in lengths:
                size = min(n, len(s))
                if n > longest * size + 1e-9:
                    break
                least = math.ceil(need(n, size) - 1e-9)
                if total >= least:
                    starts = np.flatnonzero(sums[size:] - sums[:-size] >= least)
                    if len(starts):
                        yield words, n, s, starts, size


def permuted(hashes: np.ndarray, n: int) -> np.ndarray:
    """n hash functions of each hash: rows of functions."""
    keys = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mix(hashes[None, :] ^ keys[:, None])
