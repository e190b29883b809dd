"""Operator 12: centroid clustering by kd-tree filtering.

Each task turns the vectors that it reads into kd-trees of bounded size, once; nodes hold counts, integer sums and boxes, and the trees are
written. A round goes down every tree with the candidates of a node: a centroid that is strictly farther than the one nearest the
box's middle from every point of the box goes; a node with one candidate is assigned whole, by its count and sums; leaves are
resolved point by point. All arithmetic is on integers. Only k rows of sums a task cross an exchange, and k centroids reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import cut, drop_cut, finite_rows

#: Components are held as 32-bit integers of at most this size, so that a squared distance of 64 of them fits into 63 bits.
LARGEST = 1 << 26


@dataclass
class Tree:
    """Nodes in preorder over permuted points; a node's first child is the next node, `other` the second, -1 at a leaf."""

    points: np.ndarray
    other: np.ndarray
    span: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray


def build(points: np.ndarray, leaf: int) -> tuple[Tree, np.ndarray]:
    """The tree of integer points, and the order of the points in it. Nodes are halved at the median of their widest dimension."""
    order = np.arange(len(points))
    other, span, low, high, sums = [], [], [], [], []
    todo = [(0, len(points), -1)] if len(points) else []
    while todo:
        lo, hi, parent = todo.pop()
        at = len(other)
        if parent >= 0:
            other[parent] = at
        own = points[order[lo:hi]]
        least, most = own.min(0), own.max(0)
        other.append(-1), span.append((lo, hi)), low.append(least), high.append(most), sums.append(own.sum(0, dtype=np.int64))
        wide = int(np.argmax(most - least))
        if hi - lo <= leaf or most[wide] == least[wide]:
            continue  # small, or all alike
        half = (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(own[:, wide], half)]
        todo += [(lo + half, hi, at), (lo, lo + half, -1)]
    d = points.shape[1]
    return Tree(points[order], np.array(other, np.int64), np.array(span, np.int64).reshape(-1, 2), *(np.array(x, np.int64).reshape(-1, d) for x in (low, high, sums))), order


def squared(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points and centroids: by floating products where every term is under 2^53, else by integers."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(z).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < 1 << 53:
        a, b = x.astype(np.float64), z.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
    out = np.empty((len(x), len(z)), np.int64)
    for i, c in enumerate(z):
        out[:, i] = ((x - c) ** 2).sum(1)
    return out


def filtered(tree: Tree, centroids: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(node, first point, last point + 1, candidates) of the nodes at which the descent ends: one candidate is left, or a leaf is reached."""
    todo = [(0, np.arange(len(centroids)))] if len(tree.other) else []
    while todo:
        node, left = todo.pop()
        if len(left) > 1:
            z, lo, hi = centroids[left], tree.low[node], tree.high[node]
            near = int(np.argmin(((2 * z - lo - hi) ** 2).sum(1)))
            apart = z - z[near]
            corner = np.where(apart > 0, hi, lo)  # where z does best against the nearest
            # |z - corner|^2 - |nearest - corner|^2; over 0: strictly farther from the whole box
            left = left[(apart * (z + z[near] - 2 * corner)).sum(1) <= 0]
        if len(left) == 1 or tree.other[node] < 0:
            yield node, int(tree.span[node, 0]), int(tree.span[node, 1]), left
        else:
            todo += [(int(tree.other[node]), left), (node + 1, left)]


def gather(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) of the points by their nearest centroid, ties to the smaller number."""
    counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for node, lo, hi, left in filtered(tree, centroids):
        if len(left) == 1:
            counts[left[0]] += hi - lo
            sums[left[0]] += tree.sums[node]
            continue
        own = left[np.argmin(squared(tree.points[lo:hi], centroids[left]), 1)]
        np.add.at(counts, own, 1)
        np.add.at(sums, own, tree.points[lo:hi])
    return counts, sums


def label(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each point of the tree."""
    own, far = np.zeros(len(tree.points), np.int64), np.zeros(len(tree.points), np.int64)
    for _, lo, hi, left in filtered(tree, centroids):
        d = squared(tree.points[lo:hi], centroids[left])
        k = np.argmin(d, 1)
        own[lo:hi], far[lo:hi] = left[k], d[np.arange(hi - lo), k]
    return own, far


#: A tree's arrays as columns of bytes.
COLUMNS = {"points": "<i4", "other": "<i4", "span": "<i4", "low": "<i4", "high": "<i4", "sums": "<i8"}


def _trees(vectors: DataFrame, dim: int, scale: float, size: int, leaf: int) -> DataFrame:
    """A row for each tree: the ids in its order, and its arrays."""

    def row(ids: list[pa.Array], points: list[np.ndarray]) -> pa.RecordBatch:
        tree, order = build(np.concatenate(points), leaf)
        named = pa.concat_arrays(ids).take(pa.array(order))
        data = {c: pa.array([np.ascontiguousarray(getattr(tree, c), t).tobytes()], pa.binary()) for c, t in COLUMNS.items()}
        return pa.RecordBatch.from_pydict({"ids": pa.array([named], pa.list_(pa.int64()))} | data)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points, held = [], [], 0
        for batch in batches:
            kept, x = finite_rows(batch.column(1), dim)
            x = np.floor(x * scale)
            small = (np.abs(x) <= LARGEST).all(1)
            named, x = batch.column(0).take(pa.array(kept[small])), x[small].astype(np.int64)
            while len(x):
                part = size - held
                ids.append(named[:part]), points.append(x[:part])
                held, named, x = held + len(points[-1]), named[part:], x[part:]
                if held == size:
                    yield row(ids, points)
                    ids, points, held = [], [], 0
        if held:
            yield row(ids, points)

    return vectors.mapInArrow(run, ", ".join(["ids array<long>", *(f"{c} binary" for c in COLUMNS)]))


def _read(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.Array, Tree]]:
    for i in range(batch.num_rows):
        x = {c: np.frombuffer(batch.column(c)[i].as_buffer(), t).astype(np.int64) for c, t in COLUMNS.items()}
        yield batch.column("ids")[i].values, Tree(x["points"].reshape(-1, dim), x["other"], x["span"].reshape(-1, 2), *(x[c].reshape(-1, dim) for c in ("low", "high", "sums")))


def _start(vectors: DataFrame, dim: int, scale: float, k: int, seed: int) -> np.ndarray:
    """The k vectors with the least hash of their id; k * dim numbers reach the driver."""
    c = F.col("vec")
    fits = c.isNotNull() & (F.size(c) == dim) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.floor(x * scale)) <= LARGEST) & (F.abs(x) < float("inf")))
    chosen = vectors.where(fits & F.col("id").isNotNull()).select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("mark"), "vec").orderBy("mark", "vec").limit(k)
    return np.array([np.floor(np.array(r["vec"]) * scale) for r in chosen.collect()], np.int64).reshape(-1, dim)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, seed: int = 2, size: int = 4096, leaf: int = 32, key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) for each vector, the final centroids).

    Vectors of exactly `dim` components, none null or not finite, take part, each component as floor(scale * x). Components of over 2^26 after that
    (beyond them squared distances may need over 63 bits) take no part. A vector with null id takes part but gives no first centroid. Repeated
    rows count each, also among the first centroids, in the order of their components. Fewer than k vectors give fewer centroids; none
    give no rows. An empty cluster keeps its centroid. Other columns, of any names, take no part.
    """
    flat = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{column}`").cast("array<double>").alias("vec"))
    trees = cut(_trees(flat, dim, scale, size, leaf), "trees")
    centroids = _start(flat, dim, scale, k, seed)
    if not len(centroids):
        # vectors without ids only: nothing to start from
        drop_cut(trees)
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        counts, sums = _round(trees, centroids)
        centroids = np.array([[s // n for s in row] if n else list(old) for n, row, old in zip(counts, sums, centroids.tolist(), strict=True)], np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tree in _read(batch, dim):
                own, far = label(tree, centroids)
                yield pa.RecordBatch.from_pydict({"vec_id": ids, "cluster": pa.array(own, pa.int32()), "distance": pa.array(far)})

    found = cut(trees.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    drop_cut(trees)
    return found, centroids


def _round(trees: DataFrame, centroids: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Counts and exact sums of all vectors by centroid. A task sends one row for each number that it has summed, k * (dim + 1) in all."""
    k, dim = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for _, tree in _read(batch, dim):
                n, s = gather(tree, centroids)
                counts += n
                sums += s
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(k * (dim + 1)), pa.int32()), "total": pa.array(np.concatenate((counts, sums.ravel())))})

    # task's sums fit into 63 bits; theirs together may not
    rows = trees.mapInArrow(run, "place int, total long").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = [0] * (k * (dim + 1))
    for r in rows:
        total[r["place"]] = int(r["total"])
    return total[:k], [total[k + i * dim : k + (i + 1) * dim] for i in range(k)]


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assigned vectors with their cluster's inertia, that of all, and a digest of the cluster's centroid: k rows, joined by broadcast."""
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    about = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
