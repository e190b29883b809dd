"""Operator 4: removal of repeated token windows by De Bruijn compaction.

Runs of 12 tokens are the nodes and windows of 13 tokens the edges of a De Bruijn graph. Neighbouring edges that share
their least 7-token seed (a minimiser) form a path without branches: it is compacted into one row, so a long repeat
takes one row for every few tokens. Seeds that occur in one text only leave the graph first. Paths are then joined on
their content: a path that a smaller document has too is settled as a whole, by source coordinates; only the paths of
the smallest documents, and those at the ends of repeats, are opened into edges and joined once more. Each task settles
what it can among its own rows before the exchange, so that a frequent passage sends a few rows from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import WordHashes, cut, drop_cut, mix, signed, slices, windows_hash, words_of

SECOND = 0xC2B2AE3D27D4EB4F
#: Rows that a task holds to settle among themselves.
HELD = 1_000_000


def _pack(text: str | None, with_text: bool) -> tuple[int, int, bytes | None]:
    import xxhash
    import zstandard

    words = words_of(text)
    joined = b" ".join(words)
    return len(words), xxhash.xxh3_64_intdigest(joined), zstandard.ZstdCompressor(level=3).compress(joined) if with_text else None


def _unpack(blob: bytes) -> list[bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob).split()


def packed(docs: DataFrame, key: str, with_text: bool = True) -> DataFrame:
    """(key, th, n_words, blob): th is a hash of the words, blob the compressed words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [_pack(t, with_text) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(signed(np.array([r[1] for r in rows], np.uint64))), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                    ["key", "th", "n_words", "blob"],
                )

    return docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, th long, n_words long, blob binary")


class Paths:
    """The edges and compacted paths of one text."""

    def __init__(self, words: np.ndarray, window: int, seed: int):
        n = len(words) - window + 1
        self.n = max(n, 0)
        if n <= 0:
            return
        self.seeds = windows_hash(words, seed)
        low, least = self.seeds[:n].copy(), np.arange(n)
        for j in range(1, window - seed + 1):  # the leftmost of the least seeds in each window
            next_seed = self.seeds[j : j + n]
            less = next_seed < low
            least[less] = np.flatnonzero(less) + j
            np.minimum(low, next_seed, out=low)
        self.start = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        self.size = np.diff(np.append(self.start, n))
        self.at = least[self.start]
        self.words, self.window = words, window

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return windows_hash(self.words, self.window), windows_hash(self.words, self.window, SECOND)

    def hashes(self, edges: np.ndarray, base: int) -> np.ndarray:
        powers = np.array([pow(base, k, 1 << 64) for k in range(int(self.size.max()))], np.uint64)
        offset = np.arange(self.n) - np.repeat(self.start, self.size)
        return mix(np.add.reduceat(edges * powers[offset], self.start) + self.size.astype(np.uint64))


def _runs_of(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For rows in `order`, sorted by keys: the number of the run of equal keys each belongs to."""
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return np.cumsum(new)


def shared_seeds(docs: DataFrame, key: str, window: int, seed: int) -> DataFrame:
    """(th, at): the seeds of each text that occur in another text as well."""

    def settle(h: np.ndarray, th: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((th, h))
        run = _runs_of(order, h)
        s = th[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1))
        last = np.append(first[1:], len(s)) - 1
        known = (s[first] != s[last])[run]
        keep = ~known
        keep[first] = keep[last] = True  # two witnesses tell the other tasks
        flag = np.concatenate((np.ones(int(known.sum()), bool), np.zeros(int(keep.sum()), bool)))
        take = np.concatenate((order[known], order[keep]))
        k = np.where(flag, mix(th[take] + pos[take].astype(np.uint64)), h[take])
        return pa.RecordBatch.from_arrays([pa.array(signed(k)), pa.array(flag), pa.array(signed(th[take])), pa.array(pos[take].astype(np.int32))], ["h", "flag", "th", "at"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known, seen = WordHashes(), set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    words = words_of(text)
                    th = xxhash.xxh3_64_intdigest(b" ".join(words))
                    if len(words) < window or th in seen:
                        continue
                    if len(seen) < HELD:
                        seen.add(th)
                    paths = Paths(known.of(words), window, seed)
                    held.append((paths.seeds[paths.at], np.full(len(paths.at), th, np.uint64), paths.at))
                    rows += len(paths.at)
                    if rows > HELD:
                        yield settle(*map(np.concatenate, zip(*held, strict=True)))
                        held, rows = [], 0
        if held:
            yield settle(*map(np.concatenate, zip(*held, strict=True)))

    rows = docs.where(F.col(key).isNotNull()).select(F.col("text").cast("string")).mapInArrow(run, "h long, flag boolean, th long, at int")
    every = Window.partitionBy("h", "flag")
    rows = rows.withColumn("lo", F.min("th").over(every)).withColumn("hi", F.max("th").over(every))
    return rows.where("flag or lo <> hi").select("th", "at")


def repeated_windows(docs: DataFrame, window: int = 13, seed: int = 7, key: str = "doc_id") -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(key, th, n_words, copy) of each row, (key, th, start, size): runs of window starts that a smaller key has too, and
    the written tables that both read."""
    known = cut(packed(docs, key, False).select("key", "th", "n_words"), "ids")
    reps = cut(known.where("key is not null").groupBy("th").agg(F.min("key").alias("rep")), "reps")
    ids = known.join(reps, "th", "left").select("key", "th", "n_words", F.coalesce(F.col("key") > F.col("rep"), F.lit(False)).alias("copy"))
    seeds = shared_seeds(docs, key, window, seed).groupBy("th").agg(F.collect_set("at").alias("ats"))
    wanted = cut(seeds.join(reps, "th").select(F.col("rep").alias("key"), F.col("th").alias("want"), "ats"), "seeds")
    texts = packed(docs, key).join(wanted, "key").where("th = want").select("key", "th", "blob", "ats").dropDuplicates(["key", "th"])

    def open_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        held: list[list] = []
        count = 0

        def settle() -> pa.RecordBatch:
            """One row for each path that a smaller document has too, and one for all equal paths of any other document."""
            h, g, doc, th, start, size = (np.concatenate([x[i] for x in held]) for i in range(6))
            edges, second = (np.concatenate([x[i] for x in held]) for i in (6, 7))
            order = np.lexsort((start, th, doc, g, h))
            run, own = _runs_of(order, h, g), _runs_of(order, h, g, doc)
            d = doc[order]
            first = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1))
            done = d > d[first][run]
            head = done.copy()
            head[0] = True
            head[1:] |= own[1:] != own[:-1]
            rows, done = order[head], done[head]
            places = np.append(np.flatnonzero(head), len(order)).astype(np.int32)
            kept = np.where(done, 0, size[rows])
            offsets = np.concatenate(([0], np.cumsum(kept))).astype(np.int32)
            inside = np.arange(int(offsets[-1])) + np.repeat((np.cumsum(size) - size)[rows] - offsets[:-1], kept)
            salt = mix(doc[rows].astype(np.uint64) + start[rows].astype(np.uint64) * np.uint64(SECOND))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.where(done, salt, h[rows]))), pa.array(g[rows]), pa.array(done), pa.array(doc[rows]), pa.array(size[rows].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(places), pa.array(th[order])), pa.ListArray.from_arrays(pa.array(places), pa.array(start[order].astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(edges[inside]))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(second[inside])),
                ],
                ["h", "g", "done", "key", "size", "ths", "starts", "edges", "second"],
            )

        for batch in batches:
            for part in slices(batch, 256):
                for doc, th, blob, ats in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    paths = Paths(known.of(_unpack(blob)), window, seed)
                    if not paths.n:
                        continue
                    take = np.isin(paths.at, np.array(ats))
                    one, two = paths.edges()
                    inside = np.repeat(take, paths.size)
                    h, g = paths.hashes(one, SECOND)[take], (paths.hashes(two, 0x9E3779B97F4A7C15)[take] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    m = len(h)
                    held.append([h, g, np.full(m, doc, np.int64), np.full(m, th, np.int64), paths.start[take], paths.size[take], one[inside], (two[inside] >> np.uint64(32)).astype(np.uint32).view(np.int32)])
                    count += m
                    if count > HELD // 8:
                        yield settle()
                        held.clear()
                        count = 0
        if held:
            yield settle()

    schema = "h long, g int, done boolean, key long, size int, ths array<long>, starts array<int>, edges array<long>, second array<int>"
    paths = texts.mapInArrow(open_paths, schema)
    least = Window.partitionBy("h", "g", "done")
    paths = paths.withColumn("done", F.col("done") | (F.col("key") > F.min("key").over(least)))
    paths = cut(paths.withColumn("edges", F.when(~F.col("done"), F.col("edges"))).withColumn("second", F.when(~F.col("done"), F.col("second"))), "paths")
    # edges meet once for each document and path; what is found holds for all places of the path
    opened = paths.where("not done").withColumn("path", F.monotonically_increasing_id())
    edges = opened.select("key", "path", F.posexplode(F.arrays_zip("edges", "second")).alias("i", "e")).select(F.col("e.edges").alias("h"), F.col("e.second").alias("g"), "key", "path", "i")
    met = edges.groupBy("h", "g").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("h", "g", "lo")
    late = edges.join(met, ["h", "g"]).where("key > lo").groupBy("path").agg(F.collect_list("i").alias("found"))
    each = F.explode(F.arrays_zip("ths", "starts")).alias("at")
    late = opened.join(late, "path").select("key", each, "found").select("key", "at.ths", "at.starts", F.explode("found").alias("i"))
    late = late.select("key", F.col("ths").alias("th"), (F.col("starts") + F.col("i")).alias("start"), F.lit(1).alias("size"))
    done = paths.where("done").select("key", each, "size").select("key", F.col("at.ths").alias("th"), F.col("at.starts").alias("start"), "size")
    return ids, done.unionByName(late), [known, reps, wanted, paths]


def remove_repeats(docs: DataFrame, window: int = 13, seed: int = 7, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): each text without the words of windows that also start in a
    document with a smaller doc_id.

    Windows are judged on the input, whole and of any length. Null and blank texts have no words (the digest is that of the empty string).
    Rows with a null doc_id lose nothing and take nothing from others. Repeated rows, and rows with the same doc_id, do
    not remove each other's words; a text equal word for word to one with a smaller doc_id goes whole, if it holds a window.
    Several texts under one doc_id are judged each. An empty table gives none. Other columns, of any names, take no part.
    """
    ids, runs, written = repeated_windows(docs, window, seed, key)
    runs = runs.groupBy("key", "th").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    info = ids.where("key is not null").groupBy("key", "th").agg(F.max("copy").alias("copy")).join(runs, ["key", "th"], "left")
    info = info.where("copy or runs is not null").select("key", "th", "copy", "runs")
    info = cut(info, "info")
    for table in written:
        drop_cut(table)
    texts = packed(docs, key).join(info, ["key", "th"], "left").select("key", "n_words", "blob", "copy", "runs.start", "runs.size")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: tuple[list, list, list, list, list] = ([], [], [], [], [])
                for doc, n, blob, copy, start, size in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = _unpack(blob)
                    if copy and n >= window:
                        kept = []
                    elif start:
                        step = np.zeros(n + 1, np.int64)
                        np.add.at(step, start, 1)
                        np.add.at(step, np.array(start) + np.array(size) + (window - 1), -1)
                        kept = [w for w, c in zip(words, np.cumsum(step)[:n].tolist(), strict=True) if not c]
                    else:
                        kept = words
                    text = b" ".join(kept)
                    for col, v in zip(out, (doc, n, n - len(kept), hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace")), strict=True):
                        col.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return texts.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string").withColumnRenamed("doc_id", key)
