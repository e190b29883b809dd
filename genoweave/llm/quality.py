"""Operator 7: a quality classifier by co-training.

Two views of a document, its text and the metadata of its page (language, source, length), each have a logistic
classifier. In rounds, each adds its most confident pseudo-labels on a pool of unlabelled documents to the other's
rows. Each view is then calibrated on labelled rows that neither was fitted to, and both are combined there.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import mapped, slices
from genoweave.llm.samples import labelled, one_each

VIEWS = ("text", "lang", "source", "n_chars")
META = 16 + 64 + 16
MARKS = np.zeros(256, bool)
MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def text_view(text: str | None) -> list[float]:
    """Shares of kinds of characters and words in the whole text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [1.0] + [0.0] * 15
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(raw)
    marks = int(hist[MARKS].sum())
    upper = int(hist[65:91].sum())
    letters = upper + int(hist[97:123].sum()) + int(hist[128:].sum())
    stops = int(hist[46] + hist[44])
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    marked = sum(w[-1:] in b"#$%&*" for w in words)
    return [
        0.0, marks / chars, (marks - stops) / chars, upper / max(1, letters), int(hist[48:58].sum()) / chars, letters / chars, (chars - n) / n / 20,
        len(set(words)) / n, same / n, marked / n, sum(w.endswith(b"!!") for w in words) / n, int(hist[124]) / n, int(hist[10]) / n,
        math.log1p(n) / 10, max(map(len, words)) / 100, sum(w.isupper() and len(w) > 1 for w in words) / n,
    ]


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """Indices of the set features: language, source and length, each hashed or cut into bins."""
    of = lambda s, m: zlib.crc32((s or "").encode("utf-8", "replace")) % m
    return [of(lang, 16), 16 + of(source, 64), 80 + min(15, int(math.log1p(max(0, n_chars or 0))))]


def one_hot(rows: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(rows), META))
    for i, r in enumerate(rows):
        out[i, r] = 1
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the bias last

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return z @ self.weights[:-1] + self.weights[-1]


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25) -> Logistic:
    """Newton's method; the bias is not shrunk."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + ridge * w
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(h + 1e-9 * np.eye(len(w)), g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, w)


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    calibrated: tuple[tuple[float, float], tuple[float, float]] = ((1.0, 0.0), (1.0, 0.0))
    stack: tuple[float, float, float] = (1.0, 1.0, 0.0)
    pseudo: list[int] = field(default_factory=list)

    def scores(self, texts: np.ndarray, metas: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of label 1: of the text, of the metadata, and of both."""
        z = [a * v.raw(x) + b for v, x, (a, b) in zip((self.text, self.meta), (texts, metas), self.calibrated, strict=True)]
        both = self.stack[0] * z[0] + self.stack[1] * z[1] + self.stack[2]
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (*z, both))


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray], rounds: int = 4, share: float = 0.1, sure: float = 0.95) -> CoTrained:
    """Fits on two thirds of the labelled rows, calibrates on the rest (rows come in hash order)."""
    held = np.arange(len(y)) % 3 == 0
    if min(y[~held].sum(), (1 - y[~held]).sum()) < 2 or min(y[held].sum(), (1 - y[held]).sum()) < 2:
        held = np.zeros(len(y), bool)
    x = [[v[~held]] for v in views]
    t = [[y[~held]], [y[~held]]]
    left = np.ones(len(pool[0]), bool)
    added = []
    fitted = [logistic(np.concatenate(a), np.concatenate(b)) for a, b in zip(x, t, strict=True)]
    for _ in range(rounds):
        count, taken = 0, np.zeros(len(left), bool)
        for k in (0, 1):
            p = 1 / (1 + np.exp(-np.clip(fitted[k].raw(pool[k]), -30, 30))) if len(left) else np.zeros(0)
            for label, conf in ((1, p), (0, 1 - p)):
                rate = float((y[~held] == label).mean())
                order = np.flatnonzero(left & (conf >= sure))
                order = order[np.argsort(-conf[order], kind="stable")][: int(share * rate * len(left))]
                x[1 - k].append(pool[1 - k][order])
                t[1 - k].append(np.full(len(order), float(label)))
                taken[order] = True
                count += len(order)
        left &= ~taken
        added.append(count)
        if not count:
            break
        fitted = [logistic(np.concatenate(a), np.concatenate(b)) for a, b in zip(x, t, strict=True)]
    model = CoTrained(*fitted, pseudo=added)
    if held.any():
        sides = []
        for v, view in zip(fitted, views, strict=True):
            platt = logistic(v.raw(view[held])[:, None], y[held])
            a = float(platt.weights[0] / platt.scale[0])
            sides.append((a, float(platt.weights[1] - a * platt.mean[0])))
        model.calibrated = tuple(sides)
        z = np.stack([a * v.raw(view[held]) + b for v, view, (a, b) in zip(fitted, views, sides, strict=True)], 1)
        both = logistic(z, y[held])
        w = both.weights[:2] / both.scale
        model.stack = (float(w[0]), float(w[1]), float(both.weights[2] - w @ both.mean))
    return model


def _both(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """rows: (text, lang, source, n_chars)."""
    return np.array([text_view(r[0]) for r in rows]).reshape(len(rows), 16), one_hot([meta_view(*r[1:]) for r in rows])


def train(docs: DataFrame, labels: DataFrame, size: int = 1500, pool: int = 2500, key: str = "doc_id") -> CoTrained | None:
    """Fitted on at most `size` labelled documents of each class and `pool` others, chosen by hash; None without both labels.

    The texts of each class and of the others are at most samples.BYTES bytes in all. Of several rows of a doc_id one counts; rows without doc_id
    and labels other than 0 and 1 take no part. Null and blank texts and nulls in metadata are values like others."""
    rows = labelled(docs, labels, "quality", size, None, key, VIEWS)
    y = np.array([r[1] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    rows.sort(key=lambda r: zlib.crc32(str(r[0]).encode()))
    y = np.array([r[1] for r in rows], float)
    others = docs.select(key).where(F.col(key).isNotNull()).join(labels.select(key).distinct(), key, "left_anti")
    others = others.distinct().orderBy(F.xxhash64(F.col(key).cast("string"), F.lit("pool")), key).limit(pool)
    free = one_each(docs, others.withColumn("y", F.lit(0)), VIEWS, key)
    return co_train(_both([r[2:] for r in rows]), y, _both(sorted((r[2:] for r in free), key=str)))


def _columns(batch: pa.RecordBatch, at: list[int]) -> list[tuple]:
    return list(zip(*(batch.column(i).to_pylist() for i in at), strict=True))


def score(docs: DataFrame, model: CoTrained | None, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    """(doc_id, text_score, meta_score, score, predicted) of each row; without a model all scores are 1.

    Null and blank texts have a view of their own; nulls in metadata count as a value; very long texts are read whole. Repeated rows are scored alike.
    An empty table gives no rows. Other columns, of any names, take no part.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                s = model.scores(*_both(_columns(part, [1, 2, 3, 4]))) if model and n else (np.ones(n),) * 3
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, s), pa.array((s[2] >= threshold).astype(np.int32))], ["key", "text_score", "meta_score", "score", "predicted"])

    source = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    return source.mapInArrow(run, "key long, text_score double, meta_score double, score double, predicted int").withColumnRenamed("key", key)


def keep_good(docs: DataFrame, model: CoTrained | None, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score at least the threshold, with all their columns, of any names; no exchange.

    Rows are judged one by one: nulls, empty and very long texts as in `score`, repeated rows alike. Without a model all stay."""
    at = [docs.columns.index(c) for c in VIEWS]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if model and part.num_rows:
                    part = part.filter(pa.array(model.scores(*_both(_columns(part, at)))[2] >= threshold))
                yield part

    return mapped(docs, run)
