"""Operator 13: embeddings whitened by their principal components, found by a randomised range finder.

A random basis of more columns than components asked for goes through the covariance of all centred rows again and again; each pass is one job
in which every task multiplies its own centred rows and sends dim * columns sums. Rayleigh-Ritz within the basis gives components; if
their residuals are still too large after the passes, the basis is expanded to the full dimension, in which Rayleigh-Ritz is
complete. Counts and sums are exact integers; rows are centred before they are multiplied. Nothing but sums of at most dim * dim numbers reaches the
driver, and rows cross no exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import finite_rows

#: Entries beyond this have no exact integer form in double precision.
LARGEST = 1 << 52
#: A component whose eigenvalue is under this share of the largest is rounding, not variance.
RANK = 1e-10
#: A residual under this share of the largest eigenvalue cannot be told from rounding.
RESIDUAL = 1e-13


@dataclass(frozen=True)
class Integers:
    """How a vector's entries become integers: floor(scale * c) + shift."""

    dim: int
    scale: float = 1024.0
    shift: int = 100_000

    def rows(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        places, c = finite_rows(lists, self.dim)
        x = np.floor(c * self.scale)
        small = (np.abs(x) < LARGEST - self.shift).all(1)
        return places[small], x[small].astype(np.int64) + self.shift


@dataclass(frozen=True)
class Fit:
    """The fit list's count and exact sums, and the components found."""

    integers: Integers
    n: int
    sums: list[int]
    basis: np.ndarray  # dim * components, unit columns
    values: np.ndarray  # eigenvalues, falling
    trace: float
    passes: int
    full: bool  # whether the basis had to be expanded


def _summed(vectors: DataFrame, lists: Callable[[pa.ListArray], np.ndarray], kind: str, size: int) -> list:
    """The sums over all rows of `size` numbers that each task sums over its own batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((lists(b.column(1)) for b in batches), np.zeros(size, np.int64 if kind == "long" else np.float64))
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(size), pa.int32()), "total": pa.array(total)})

    whole = F.col("total").cast("decimal(38,0)") if kind == "long" else F.col("total")
    rows = vectors.mapInArrow(run, f"place int, total {kind}").groupBy("place").agg(F.sum(whole).alias("total")).collect()
    out: list = [0] * size
    for r in rows:
        out[r["place"]] = int(r["total"]) if kind == "long" else r["total"]
    return out


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less the mean, rounded once: the mean's whole part goes first, in integers."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """For each row the exact sum over dimensions of (n * x - sums)^2."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        d = n * x - np.array(sums, np.int64)
        most = int(np.abs(d).max(initial=0))
        if most * most * x.shape[1] < 1 << 63:
            return (d * d).sum(1).tolist()
    d = n * x.astype(object) - np.array(sums, object)
    return (d * d).sum(1).tolist()


def _rows(vectors: DataFrame, key: str, column: str) -> DataFrame:
    return vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("vec"))


def common_size(vectors: DataFrame, column: str = "vec") -> int:
    """The commonest length of the vectors without null or non-finite entries, the smaller of equally common ones; 0 if there are none."""
    c = F.col(column)
    fine = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = vectors.where(fine).groupBy(F.size(c).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return most["d"] if most else 0


def fit(vectors: DataFrame, integers: Integers, k: int = 8, oversample: int = 10, power: int = 4, seed: int = 13) -> Fit | None:
    """Components of all rows of (vec_id, vec); None if there are no vectors of the right length. Repeated rows count each."""
    dim = integers.dim
    low = (1 << 26) - 1

    def exact(lists: pa.ListArray) -> np.ndarray:
        _, x = integers.rows(lists)
        return np.concatenate(([len(x)], (x >> 26).sum(0), (x & low).sum(0)))  # in two parts, so that no task's sum overflows

    n, *parts = _summed(vectors, exact, "long", 1 + 2 * dim)
    if not n:
        return None
    sums = [(parts[j] << 26) + parts[dim + j] for j in range(dim)]

    def image(q: np.ndarray) -> tuple[np.ndarray, float]:
        """The covariance times q, and its trace, in one pass."""

        def run(lists: pa.ListArray) -> np.ndarray:
            a = centred(integers.rows(lists)[1], n, sums)
            return np.concatenate(((a.T @ (a @ q)).ravel(), [(a * a).sum()]))

        *z, trace = _summed(vectors, run, "double", q.size + 1)
        return np.array(z).reshape(q.shape) / n, trace / n

    def ritz(q: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(values, vectors, largest residual norm) of the leading components within q; z is the covariance times q."""
        b = q.T @ z
        e, w = np.linalg.eigh((b + b.T) / 2)
        e, w = e[::-1][:k], w[:, ::-1][:, :k]
        return e, q @ w, float(np.linalg.norm(z @ w - (q @ w) * e, axis=0).max(initial=0))

    random = np.random.default_rng(seed)
    columns = min(dim, k + oversample)
    q = np.linalg.qr(random.standard_normal((dim, columns)))[0]
    passes, whole = 0, columns == dim
    while True:
        z, trace = image(q)
        passes += 1
        values, basis, residual = ritz(q, z)
        if whole or residual <= RESIDUAL * max(values[0], 0):
            break
        if passes <= power:
            q = np.linalg.qr(z)[0]
        else:  # not settled: all dimensions
            q, whole = np.linalg.qr(np.concatenate((q, random.standard_normal((dim, dim - columns))), 1))[0], True
    kept = (values > RANK * values[0]) & (values > 0)
    return Fit(integers, n, sums, basis[:, kept], values[kept], trace, passes, whole and columns < dim)


def whitened(x: np.ndarray, found: Fit) -> np.ndarray:
    return (centred(x, found.n, found.sums) @ found.basis) / np.sqrt(found.values)


def identity_error(vectors: DataFrame, found: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity; the rows' mean is taken off first."""
    k = len(found.values)
    mean = np.array(_summed(vectors, lambda lists: whitened(found.integers.rows(lists)[1], found).sum(0), "double", k)) / found.n

    def products(lists: pa.ListArray) -> np.ndarray:
        w = whitened(found.integers.rows(lists)[1], found) - mean
        return (w.T @ w).ravel()

    v = np.array(_summed(vectors, products, "double", k * k)).reshape(k, k) / found.n
    return float(np.abs(v - np.eye(k)).max(initial=0))


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, k: int = 8, scale: float = 1024.0, shift: int = 100_000, oversample: int = 10, power: int = 4, seed: int = 13, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row (vec_id, component, n, deviation, whitened, explained, identity_error) for each vector and component up to k.

    Vectors that are null or hold null or non-finite entries take no part, nor do those of another length than the commonest, empty ones or those with
    entries beyond 2^52 after scaling. There are fewer components if the dimension or the rank is less than k (one vector, or equal ones, give none, so
    no rows). Zero vectors and repeated rows are vectors each; null ids stay. A deviation beyond 63 bits is null. Empty tables give no rows. Other
    columns, of any names, take no part.
    """
    flat = _rows(vectors, key, column)
    dim = common_size(flat)
    found = fit(flat, Integers(dim, scale, shift), k, oversample, power, seed) if dim else None
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    error, many = identity_error(flat, found), len(found.values)
    explained = found.values / found.trace

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, x = found.integers.rows(b.column(1))
            m = len(x)
            far = [d if d < 1 << 63 else None for d in deviations(x, found.n, found.sums)]
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column(0).take(pa.array(np.repeat(places, many))), "component": pa.array(np.tile(np.arange(1, many + 1), m), pa.int32()), "n": pa.array(np.full(m * many, found.n)),
                "deviation": pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(m), many))), "whitened": pa.array(whitened(x, found).ravel()), "explained": pa.array(np.tile(explained, m)),
                "identity_error": pa.array(np.full(m * many, error)),
            })

    return flat.mapInArrow(run, SCHEMA)
