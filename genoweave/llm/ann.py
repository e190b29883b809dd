"""Operator 2: nearest neighbours by a vantage-point tree for each shard.

Vectors are dealt by hash into shards of bounded size. Each shard's tree is built once and written: its points are halved again and
again by their distance to a vantage point. A search goes down the nearer halves first, then through the tree, and leaves out a half whose least
possible distance, by the triangle inequality, times `relax` is over the distance of the k-th neighbour so far: 1 is
exact, more is faster. Queries are searched in blocks of bounded size; a shard's task takes several blocks, one after the other, and
the shards' answers are merged. What crosses an exchange is the queries, once for each shard, and a tree once for each
`held` blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import cut, drop_cut

LEAF = 64


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of q and x in double precision, coordinates added in order."""
    total = np.zeros((len(q), len(x)))
    for j in range(q.shape[1]):
        d = q[:, j, None] - x[None, :, j]
        total += d * d
    return np.sqrt(total)


@dataclass
class Tree:
    """Nodes in preorder; points are permuted so that each leaf's are neighbours."""

    points: np.ndarray
    ids: np.ndarray
    vantage: np.ndarray  # index of a node's vantage point
    radius: np.ndarray  # points within go to the first child; negative for a leaf
    outer: np.ndarray  # index of the second child; the first is the next node
    span: np.ndarray  # first and last+1 point of a node


def build(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> Tree:
    order = np.lexsort((ids,))
    points, ids = points[order], ids[order]
    perm = np.arange(len(ids))
    vantage, radius, outer, span = [], [], [], []
    todo = [(0, len(ids), -1)]
    while todo:
        lo, hi, parent = todo.pop()
        at = len(vantage)
        if parent >= 0:
            outer[parent] = at
        vantage.append(int(perm[lo]) if hi > lo else 0), radius.append(-1.0), outer.append(-1), span.append((lo, hi))
        if hi - lo <= leaf:
            continue
        own = perm[lo:hi]
        with np.errstate(over="ignore", invalid="ignore"):
            d = distances(points[own[:1]], points[own])[0]
            mu = float(np.median(d))
        inside = d <= mu
        if inside.all():
            continue  # most points are alike: one leaf
        perm[lo:hi] = np.concatenate((own[inside], own[~inside]))
        mid = lo + int(inside.sum())
        radius[at] = mu
        todo += [(mid, hi, at), (lo, mid, -1)]  # the inner child is built next
    place = np.empty(len(perm), np.int64)
    place[perm] = np.arange(len(perm))
    return Tree(points[perm], ids[perm], place[np.array(vantage, np.int64)], np.array(radius), np.array(outer, np.int64), np.array(span, np.int64).reshape(-1, 2))


def search(tree: Tree, queries: np.ndarray, own: np.ndarray, k: int, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(distances, ids) of the k nearest points of each query but those with its own id; missing ones are not a number and
    have the largest id. Distances that overflow are infinite and count."""
    best_d = np.full((len(queries), k), np.nan)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    home = np.full(len(queries), -1)  # the leaf that a query was in first

    def scan(node: int, act: np.ndarray) -> None:
        lo, hi = tree.span[node]
        for a in range(lo, hi, 4096):
            b = min(hi, a + 4096)
            ids = np.broadcast_to(tree.ids[a:b], (len(act), b - a))
            self = ids == own[act, None]
            d = np.where(self, np.nan, distances(queries[act], tree.points[a:b]))
            all_d, all_id = np.concatenate((best_d[act], d), 1), np.concatenate((best_id[act], np.where(self, np.iinfo(np.int64).max, ids)), 1)
            order = np.lexsort((all_id, all_d), axis=-1)[:, :k]  # what is not a number comes last
            best_d[act], best_id[act] = np.take_along_axis(all_d, order, 1), np.take_along_axis(all_id, order, 1)

    def to_vantage(node: int, act: np.ndarray) -> np.ndarray:
        return distances(queries[act], tree.points[tree.vantage[node]][None])[:, 0]

    def descend(node: int, act: np.ndarray) -> None:
        """Each query to the leaf of its nearer halves."""
        if not len(act):
            return
        if tree.radius[node] < 0:
            home[act] = node
            scan(node, act)
            return
        near = to_vantage(node, act) <= tree.radius[node]
        descend(node + 1, act[near])
        descend(int(tree.outer[node]), act[~near])

    def visit(node: int, act: np.ndarray) -> None:
        """Both halves, but a query's farther one only if it can hold a nearer point. A leaf is scanned once, for all its queries."""
        if not len(act):
            return
        if tree.radius[node] < 0:
            rest = act[home[act] != node]
            if len(rest):
                scan(node, rest)
            return
        to, mu = to_vantage(node, act), tree.radius[node]
        with np.errstate(invalid="ignore"):
            gap = np.maximum(0, np.abs(to - mu) - 1e-12 * (to + mu))  # less what rounding can add
        near = to <= mu
        for child, own_side in ((node + 1, near), (int(tree.outer[node]), ~near)):
            visit(child, act[own_side | ~(gap * relax > best_d[act, -1])])

    with np.errstate(over="ignore"):
        every = np.arange(len(queries))
        descend(0, every)
        visit(0, every)
    return best_d, best_id


def usable(column: str) -> Column:
    c = F.col(column)
    return c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(c, lambda x: x != 0)


def _grouped(df: DataFrame, n: int, schema: str, pack: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> DataFrame:
    """One row (dim, part, *schema) for each group of about the same number of vectors of one dimension."""
    dealt = df.select("id", "vec", F.size("vec").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("part"))

    def run(key: tuple, found: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        data = found.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, dim)
        out = pack(data, found.column("id").to_numpy().astype("<i8"))
        return pa.table({"dim": pa.array([dim], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32())} | {c: pa.array([x.tobytes()], pa.binary()) for c, x in out.items()})

    return dealt.groupBy("dim", "part").applyInArrow(run, f"dim int, part int, {schema}")


def _tree(points: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray]:
    t = build(points, ids)
    return {"points": t.points, "ids": t.ids, "vantage": t.vantage, "radius": t.radius, "outer": t.outer, "span": t.span}


#: The bytes of a tree's arrays, as columns.
COLUMNS = {"points": "<f8", "ids": "<i8", "vantage": "<i8", "radius": "<f8", "outer": "<i8", "span": "<i8"}


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, relax: float = 1.0, shard: int = 16_384, block: int = 2048, held: int = 16, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of each query, ties to the smaller id.

    Rows whose vector is null, empty, zero or not finite, or whose id is null, take no part; vectors of one dimension are
    searched among themselves. A query's own id is no candidate. Distances that overflow are infinite and rank last, by id. Repeated
    rows of vectors are candidates each, a query's own repeats are one query. Fewer than k candidates give fewer rows. Empty
    tables give none. Other columns, of any names, take no part.
    """
    clean = lambda df: df.where(usable(column) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vec"))
    written = [cut(clean(vectors), "points"), cut(clean(queries).dropDuplicates(["id"]), "asked")]
    points, asked = (x.withColumn("row", F.monotonically_increasing_id()) for x in written)
    shards = max(1, -(-points.count() // shard))
    blocks = max(1, -(-asked.count() // block))
    turns = -(-blocks // held)
    written.append(cut(_grouped(points, shards, ", ".join(f"{c} binary" for c in COLUMNS), _tree), "trees"))
    trees = written[-1].withColumnRenamed("part", "shard")
    trees = trees.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    asks = _grouped(asked, blocks, "own binary, asks binary", lambda x, ids: {"own": ids, "asks": x})
    asks = asks.withColumn("turn", F.col("part") % turns).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(key: tuple, tree: pa.Table, asks: pa.Table) -> pa.Table:
        out = [pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})]
        if tree.num_rows and asks.num_rows:
            dim = key[0].as_py()
            x = {c: np.frombuffer(tree.column(c)[0].as_py(), t) for c, t in COLUMNS.items()}
            built = Tree(x["points"].reshape(-1, dim), x["ids"], x["vantage"], x["radius"], x["outer"], x["span"].reshape(-1, 2))
            for own, data in zip(asks.column("own").to_pylist(), asks.column("asks").to_pylist(), strict=True):
                own = np.frombuffer(own, "<i8")
                d, found = search(built, np.frombuffer(data, "<f8").reshape(-1, dim), own, k, relax)
                real = ~np.isnan(d)
                out.append(pa.table({"query_id": np.repeat(own, k)[real.ravel()], "vec_id": found[real], "score": d[real]}))
        return pa.concat_tables(out)

    # one task's rows: a tree of `shard` vectors and at most `held` blocks of queries
    deal = ("dim", "shard", "turn")
    hits = trees.groupBy(*deal).cogroup(asks.groupBy(*deal)).applyInArrow(run, "query_id long, vec_id long, score double")
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    out = cut(ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")
    for used in written:
        drop_cut(used)
    return out
