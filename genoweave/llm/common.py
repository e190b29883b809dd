"""What the operators of this subpackage share: written cut points, words, shingles and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset (local tests) a new one."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="genoweave-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/genoweave/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once as Parquet in the shared folder: cuts lineage and survives a lost executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a cut that no later plan reads."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        folder = f.rsplit("/", 1)[0]
        if "/genoweave/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Maximal runs of bytes other than 0x20 and 0x09-0x0D; bytes.split() cuts at exactly these."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), so that sums of word hashes spread over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def windows_hash(words: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each run of `size` word hashes, position-dependent; empty if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    b = np.uint64(base)
    for k in range(size):
        h = h * b + words[k : k + n]
    return mix(h)


class WordHashes:
    """XXH64 of words, remembered up to a bound."""

    def __init__(self, bound: int = 300_000, seed: int = 0, plain: Callable[[bytes], bytes] | None = None):
        import xxhash

        self.known: dict[bytes, int] = {}
        self.bound, self.seed = bound, seed
        digest = xxhash.xxh64_intdigest
        # words that `plain` leaves nothing of have the hash 0
        self.hash = (lambda w, s: digest(x, s) if (x := plain(w)) else 0) if plain else digest

    def of(self, words: list[bytes]) -> np.ndarray:
        known, seed, digest = self.known, self.seed, self.hash
        if len(known) > self.bound:
            known.clear()
        out = list(map(known.get, words))
        if None in out:
            for i, (w, h) in enumerate(zip(words, out, strict=True)):
                if h is None:
                    out[i] = known[w] = digest(w, seed)
        return np.array(out, dtype=np.uint64)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def slices(batch, rows: int = 512) -> Iterator:
    """An Arrow batch in parts, so that Python objects of few rows exist at a time."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def finite_rows(lists: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, matrix) of the lists of exactly `dim` numbers, none null or not finite."""
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    kept = np.flatnonzero(lengths == dim)
    data = lists.take(pa.array(kept)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # null becomes not a number
    fine = np.isfinite(data).all(1)
    return kept[fine], data[fine]


def mapped(docs: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """docs with each Arrow batch put through `run`, which keeps the columns; their names may be any, as they do not take part."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*plain)

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(b.rename_columns(names) for b in batches):
            yield out.rename_columns(plain)

    names = docs.columns
    return inner.mapInArrow(named, inner.schema).toDF(*names)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b): a row (node, root) for each node, root its component's least node.

    Alternates large-star and small-star steps as joins and min aggregates: each keeps connectivity, and the edge
    set ends as stars around the least node. Every round is written to the shared folder. Loops and repeated edges are
    fine; no edges give no rows.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    pairs = cut(pairs, "edges")
    seen = None
    for _ in range(rounds):
        # large-star: each larger neighbour of a node goes to the least of its neighbourhood
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(pairs.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        star = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        star = star.where("hi <> lo").distinct()
        # small-star: each smaller neighbour of a node, and the node, go to the least of them
        low = star.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("c"), "m")
        joined = star.join(low, F.col("hi") == F.col("c"))
        small = joined.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(low.select(F.col("c").alias("hi"), F.col("m").alias("lo")))
        new = cut(small.where("hi <> lo").distinct(), "edges")
        sums = [F.sum(F.xxhash64("hi", "lo", F.lit(i)).cast("decimal(38,0)")) for i in (1, 2)]
        state = tuple(new.agg(F.count("*"), *sums).first())  # 128 bits of hashes: equal only for equal pairs
        drop_cut(pairs)
        pairs = new
        if seen == state:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(pairs.select(F.col("lo"), F.col("lo")).distinct())


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
