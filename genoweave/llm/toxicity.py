"""Operator 5: toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of the weights of its words and of their
first letters; the document's is the noisy-or of its sentences'. Only document labels are known, so the weights are
fitted through the noisy-or; the sentence scores then tell which sentences are toxic.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import slices
from genoweave.llm.samples import counts, labelled

ENDS = re.compile(r"[.!?]+(?=\s|$)|\n+")
LETTERS = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, stop) of each sentence with more than white space; ends are . ! ? before white space, and line breaks."""
    text = text or ""
    out, at = [], 0
    for m in ENDS.finditer(text):
        out.append((at, m.end()))
        at = m.end()
    out.append((at, len(text)))
    return [(a, b) for a, b in out if not text[a:b].isspace() and b > a]


def features(token: str) -> list[str]:
    """A token's lower-case letter runs, and the first three to five letters of longer ones."""
    out = []
    for w in LETTERS.findall(token.lower()):
        out.append(w)
        out += [f"^{w[:k]}" for k in (3, 4, 5) if len(w) > k]
    return out


@dataclass
class Model:
    bias: float
    weights: dict[str, float]

    def scorer(self, bound: int = 300_000):
        known: dict[str, float] = {}
        weights = self.weights

        def weigh(token: str) -> float:
            if len(known) > bound:
                known.clear()
            w = known[token] = sum(weights.get(f, 0.0) for f in features(token))
            return w

        def score(text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
            """The document's score and (start, stop, score) of its sentences."""
            found, spans = [], sentences(text)
            for a, b in spans:
                z = self.bias
                for t in set(text[a:b].split()):
                    w = known.get(t)
                    z += weigh(t) if w is None else w
                found.append(z)
            p = 1 / (1 + np.exp(-np.clip(found, -30, 30))) if found else np.zeros(0)
            return float(1 - np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), [(a, b, float(q)) for (a, b), q in zip(spans, p, strict=True)]

        return score


def fit(rows: list[tuple[str | None, int]], odds: float = 1.0, least: int = 5, apart: float = 3.0, steps: int = 400, rate: float = 0.3, l2: float = 2e-5) -> Model | None:
    """rows: (text, label). odds: how many times as many negatives there are in the population as in the sample.
    Features in fewer than `least` documents are left out, and those whose shares of the two classes' documents differ by
    less than `apart` standard errors. AdaGrad on the noisy-or likelihood, all rows in each step. None if a class has no rows or no feature is kept: there is
    nothing to learn then, and a bias alone would tell documents by their number of sentences."""
    if {r[1] for r in rows} != {0, 1}:
        return None
    # only counts are held: features are made again for those that are kept
    seen: dict[str, int] = {}
    for text, label in rows:
        for f in set().union(*map(features, set((text or "").split()))):
            seen[f] = seen.get(f, 0) + (1 << 20 if label else 1)
    n = [sum(1 for r in rows if r[1] == k) for k in (0, 1)]

    def told(f: str) -> bool:
        a, b = seen[f] & 0xFFFFF, seen[f] >> 20
        p = (a + b) / (n[0] + n[1])
        return a + b >= least and abs(a / max(1, n[0]) - b / max(1, n[1])) >= apart * (p * (1 - p) * (1 / max(1, n[0]) + 1 / max(1, n[1]))) ** 0.5 > 0

    index = {f: i for i, f in enumerate(sorted(f for f in seen if told(f)))}
    if not index:
        return None
    del seen
    feat, sent, doc = array("i"), array("i"), array("i")
    known: dict[str, list[int]] = {}
    for d, (text, _) in enumerate(rows):
        for a, b in sentences(text):
            ids: set[int] = set()
            for t in text[a:b].split():
                own = known.get(t)
                if own is None:
                    own = [index[f] for f in features(t) if f in index]
                    if len(known) < 200_000:
                        known[t] = own
                ids.update(own)
            feat.extend(ids)
            sent.extend([len(doc)] * len(ids))
            doc.append(d)
    feat, sent, doc = (np.frombuffer(x, np.int32) if len(x) else np.zeros(0, np.int32) for x in (feat, sent, doc))
    y = np.array([r[1] for r in rows], float)
    weight = np.where(y > 0, 1.0, odds)
    weight /= weight.sum()
    w, b = np.zeros(len(index)), -7.0
    gw, gb = np.full(len(index), 1e-8), 1e-8
    for _ in range(steps):
        z = np.clip(b + np.bincount(sent, w[feat], len(doc)), -30, 30)
        s = 1 / (1 + np.exp(-z))
        keep = np.bincount(doc, np.log1p(-np.minimum(s, 1 - 1e-12)), len(rows))
        p = np.clip(1 - np.exp(keep), 1e-9, 1 - 1e-9)
        slope = np.where(y > 0, -(1 - p) / p, 1.0) * weight
        g = slope[doc] * s
        dw = np.bincount(feat, g[sent], len(index)) + l2 * w
        db = g.sum()
        gw += dw * dw
        gb += db * db
        w -= rate * dw / np.sqrt(gw)
        b -= rate * db / np.sqrt(gb)
    return Model(float(b), {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4})


def train(docs: DataFrame, labels: DataFrame, size: int = 2000, where: Column | None = None, key: str = "doc_id") -> Model | None:
    """Fitted on at most `size` labelled documents of each class, chosen by a hash of their key; None without both classes (see `fit`).

    The texts of each class are at most samples.BYTES bytes in all. Of several rows of a doc_id one counts. Null and blank texts are documents without
    sentences; rows without doc_id and labels other than 0 and 1 take no part."""
    rows = labelled(docs, labels, "toxic", size, where, key)
    n = counts(labels, "toxic", key, where)
    own = Counter(r[1] for r in rows)
    odds = (n.get(0, 0) / max(1, own[0])) / max(n.get(1, 0) / max(1, own[1]), 1e-9) if own[0] and own[1] else 1.0
    return fit([(r[2], r[1]) for r in rows], odds)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """(doc_id, score, worst_start, worst_stop, worst_score): the whole text's score and its most toxic sentence.

    Null and blank texts score 0 and have no worst sentence. Without a model every document does. Very long texts are read whole. Repeated rows and null
    keys are scored like others. An empty table gives no rows. Other columns, of any names, take no part.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer() if model else lambda text: (0.0, [])
        for batch in batches:
            for part in slices(batch):
                out: tuple[list, ...] = ([], [], [], [])
                for text in part.column(1).to_pylist():
                    total, each = of(text)
                    worst = max(each, key=lambda x: x[2], default=(None, None, None))
                    for col, v in zip(out, (total, *worst), strict=True):
                        col.append(v)
                kinds = (pa.float64(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["key", "score", "worst_start", "worst_stop", "worst_score"])

    source = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "key long, score double, worst_start int, worst_stop int, worst_score double").withColumnRenamed("key", key)
