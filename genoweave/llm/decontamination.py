"""Operator 8: benchmark decontamination by SimHash of item-sized windows.

Windows with as many words as a benchmark item (a shorter document as a whole) have a SimHash of their word shingles. A
multi-index of four blocks of 16 bits retrieves, among the items of that length, every one whose fingerprint lies within the radius
of 15 bits: if each block had four or more, there would be 16. Only what the index retrieves is compared, on the weighted
Jaccard similarity of shingles, each weighing as often as it occurs. Windows without enough shingles of the benchmark at
all (whichever item they are of) are not fingerprinted: no item could reach the similarity there, so none is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import WordHashes, mapped, slices, union_all, words_of
from genoweave.llm.windows import Passages, in_parts, simhash, simhashes, weighted_jaccard

#: Bits by which a window's fingerprint may differ from an item's; blocks and their bits.
RADIUS, BLOCKS, WIDTH = 15, 4, 16
#: Items, and characters of items, that a task holds at a time; larger benchmarks are searched in blocks of as many.
ITEMS, CHARS = 20_000, 16 << 20


def _flips(bits: int) -> np.ndarray:
    """All values of a block with at most so many bits."""
    return np.array([sum(1 << b for b in c) for r in range(bits + 1) for c in combinations(range(WIDTH), r)], np.uint32)


#: Of the three bits that a block may differ by, two are turned when an item is indexed and one when a window is looked up.
TURNED, ASKED = _flips(2), _flips(1)
assert RADIUS < BLOCKS * (2 + 1 + 1)


def _blocks(fingerprints: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """Keys (block and value) within the flips of each fingerprint: a row for each."""
    parts = [((fingerprints >> np.uint64(WIDTH * k)) & np.uint64((1 << WIDTH) - 1)).astype(np.uint32)[:, None] ^ flips | np.uint32(k << WIDTH) for k in range(BLOCKS)]
    return np.concatenate(parts, axis=1)


class BlockIndex:
    """Fingerprints by the values near those of their blocks."""

    def __init__(self, fingerprints: np.ndarray):
        self.fp = fingerprints
        keys = _blocks(fingerprints, TURNED)
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys, self.owner = keys.ravel()[order], (order // keys.shape[1]).astype(np.int32)

    def near(self, fingerprints: np.ndarray, chunk: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """(row, item): all items within the radius of each fingerprint."""
        rows, items = [], []
        for i in range(0, len(fingerprints), chunk):
            f = fingerprints[i : i + chunk]
            keys = _blocks(f, ASKED)
            lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
            n = (hi - lo).ravel()
            if not n.any():
                continue
            at = np.repeat(lo.ravel(), n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            met = np.unique(np.repeat(np.arange(n.size) // keys.shape[1], n) * len(self.fp) + self.owner[at])
            row, item = met // len(self.fp), met % len(self.fp)
            close = np.bitwise_count(f[row] ^ self.fp[item]) <= RADIUS
            rows.append(row[close] + i), items.append(item[close])
        none = np.zeros(0, np.int64)
        return (np.concatenate(rows), np.concatenate(items)) if rows else (none, none)


class Finder:
    def __init__(self, rows: list[tuple[object, str | None]], threshold: float):
        self.passages, self.threshold = Passages(rows), threshold
        items = self.passages.items
        self.index = {(words, n): BlockIndex(np.array([simhash(items[i].shingles) for i in own], np.uint64)) for words, lengths in self.passages.by_size.items() for n, own in lengths.items()}
        self.known = WordHashes()

    def need(self, length: int, window: int) -> float:
        """Shingles that a window must share with an item for the similarity."""
        return self.threshold / (1 + self.threshold) * (length + window)

    def find(self, text: str | None) -> list[tuple[object, int, int, float]]:
        """(item, start word, words, similarity) of the best window of each item found in the text, the first of equals."""
        h = self.known.of(words_of(text, lower=True))
        best: dict[int, tuple[float, int]] = {}
        for words, n, s, starts, size in self.passages.windows(h, self.need, 1 / self.threshold):
            own = self.passages.by_size[words][n]
            for part in in_parts(starts):
                rows, found = self.index[words, n].near(simhashes(s, part, size))
                for at, i in zip(part[rows].tolist(), own[found].tolist(), strict=True):
                    if i in best and best[i][0] >= 1:
                        continue
                    sim = weighted_jaccard(s[at : at + size], self.passages.items[i].shingles)
                    if sim >= self.threshold and sim > best.get(i, (0.0, 0))[0]:
                        best[i] = (sim, at)
        return [(self.passages.items[i].key, at, min(self.passages.items[i].words, len(h)), sim) for i, (sim, at) in sorted(best.items())]


def blocks(benchmark: DataFrame, key: str, column: str) -> Iterator[list[tuple]]:
    """The different items in lists of at most ITEMS, and of about CHARS characters."""
    rows: list[tuple] = []
    chars = 0
    for r in benchmark.select(key, F.col(column).cast("string")).where(F.col(key).isNotNull()).distinct().toLocalIterator():
        rows.append((r[0], r[1]))
        chars += len(r[1] or "")
        if len(rows) == ITEMS or chars > CHARS:
            yield rows
            rows, chars = [], 0
    if rows:
        yield rows


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, start, words, similarity): each document and item of which it has a window at the threshold, with the
    best of the windows that were retrieved, the first of equals.

    Texts and items are lower-cased (A-Z) and cut at white space; shingles have five words (all, if an item has fewer).
    A document shorter than an item is one window. Items without words or item_id and null or blank texts give nothing.
    Repeated documents each give rows, and so do different texts under one item_id; a repeated item counts once. Very long
    texts are searched whole, in parts. Other columns, of any names, take no part.
    """

    def search(items: list[tuple]) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(items, threshold)
            for batch in batches:
                for part in slices(batch):
                    rows = [(d, *m) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for m in finder.find(t)]
                    kinds = (("key", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("similarity", pa.float64()))
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)], [n for n, _ in kinds])

        source = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
        return source.mapInArrow(run, "key long, item_id long, start int, words int, similarity double").withColumnRenamed("key", key)

    found = [search(items) for items in blocks(benchmark, "item_id", "text")]
    return union_all(found) if found else docs.sparkSession.createDataFrame([], f"{key} long, item_id long, start int, words int, similarity double")


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of docs that hold no window of an item (see `matches`), with all their columns, of any names; no exchange.

    Null and blank texts stay; repeated rows are judged alike; without items all stay."""
    at = docs.columns.index("text")
    for items in blocks(benchmark, "item_id", "text"):

        def run(batches: Iterable[pa.RecordBatch], items: list[tuple] = items) -> Iterator[pa.RecordBatch]:
            finder = Finder(items, threshold)
            for batch in batches:
                for part in slices(batch):
                    texts = part.column(at).to_pylist()
                    yield part.filter(pa.array([not finder.find(t) for t in texts], pa.bool_()))

        docs = mapped(docs, run)
    return docs
