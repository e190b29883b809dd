"""The quality score worked out anew from its formula, odd rows of its stage, and passages that the pipeline must find."""

import math
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from genoweave.llm import quality, queries

SMALL = Path("/root/testdata/sf0.001")
KIND = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [None, "", " \n ", "One two, three. FOUR five!! 66 # word#", "a | b\nc | c c", "Ünïcode wörds é" * 3, "x" * 300, "same same same same", "!!! ??? $$$ %%% &&&", "Plain words follow one another. They end."]


def by_hand(text):
    """The text's view from its definition: shares of kinds of bytes and words."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [1.0] + [0.0] * 15
    n, size = len(words), len(raw)
    marks = [b for b in raw if 33 <= b <= 126 and not chr(b).isalnum()]
    letters = [b for b in raw if chr(b).isalpha() and b < 128 or b >= 128]
    return [
        0.0, len(marks) / size, (len(marks) - raw.count(b".") - raw.count(b",")) / size, sum(65 <= b <= 90 for b in raw) / max(1, len(letters)), sum(48 <= b <= 57 for b in raw) / size,
        len(letters) / size, (size - n) / n / 20, len(set(words)) / n, sum(words[i] == words[i + 1] for i in range(n - 1)) / n, sum(w.endswith((b"#", b"$", b"%", b"&", b"*")) for w in words) / n,
        sum(w.endswith(b"!!") for w in words) / n, raw.count(b"|") / n, raw.count(b"\n") / n, math.log(n + 1) / 10, max(len(w) for w in words) / 100, sum(len(w) > 1 and w.isupper() for w in words) / n,
    ]


def test_quality_scores_are_the_formula(spark):
    own = np.random.default_rng(4)
    side = lambda d: quality.Logistic(own.normal(size=d), own.uniform(0.5, 2, d), own.normal(size=d + 1))
    model = quality.CoTrained(side(16), side(quality.META), ((1.5, -0.2), (0.7, 0.1)), (0.8, 0.6, -0.3))
    rows = [(i, t, ("en", None, "de")[i % 3], f"s{i % 4}" if i % 4 else None, (None, 0, 5, 90, 10**6)[i % 5]) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in quality.score(spark.createDataFrame(rows, KIND), model, threshold=0.5).collect()}
    half = lambda z: 1 / (1 + math.exp(-min(max(z, -30), 30)))
    hashed = lambda s, m: zlib.crc32((s or "").encode()) % m
    for i, text, lang, source, n in rows:
        meta = [0.0] * quality.META
        for k in (hashed(lang, 16), 16 + hashed(source, 64), 80 + min(15, int(math.log(max(0, n or 0) + 1)))):
            meta[k] = 1.0
        z = []
        for part, x, (a, b) in ((model.text, by_hand(text), (1.5, -0.2)), (model.meta, meta, (0.7, 0.1))):
            raw = sum((v - m) / s * w for v, m, s, w in zip(x, part.mean, part.scale, part.weights[:-1], strict=True)) + part.weights[-1]
            z.append(a * raw + b)
        both = half(0.8 * z[0] + 0.6 * z[1] - 0.3)
        assert abs(got[i]["text_score"] - half(z[0])) < 1e-9 and abs(got[i]["meta_score"] - half(z[1])) < 1e-9
        assert abs(got[i]["score"] - both) < 1e-9 and got[i]["predicted"] == int(both >= 0.5)


def test_quality_of_odd_rows(spark):
    """Nulls, empties, repeats, a very long text, and columns of other names stay with their rows."""
    own = np.random.default_rng(5)
    side = lambda d: quality.Logistic(np.zeros(d), np.ones(d), own.normal(size=d + 1))
    model = quality.CoTrained(side(16), side(quality.META))
    rows = [(i, t, "en", "s", 5) for i, t in enumerate(TEXTS)] * 2 + [(None, None, None, None, None), (99, "word " * 300_000, "en", "s", 1)]
    df = spark.createDataFrame(rows, KIND).withColumn("key", F.lit("k")).withColumn("a.b", F.lit(1)).withColumn("score", F.lit("x"))
    kept = quality.keep_good(df, model)
    good = {(r["doc_id"], r["predicted"]) for r in quality.score(df, model).collect()}
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {d for d, p in good if p}
    assert all(kept.where(F.col("doc_id") == d).count() == 2 for d, p in good if p and d is not None and d < 50)
    assert quality.keep_good(df, None).count() == len(rows) and quality.keep_good(df.where("false"), model).count() == 0
    assert quality.train(df, spark.createDataFrame([], "doc_id long, quality int")) is None


@pytest.mark.skipif(not SMALL.is_dir(), reason="no tables here")
def test_the_pipeline_finds_every_planted_passage(spark):
    """Each benchmark item inside a clean text: the stage drops all of them, and none of the texts without."""
    sf = str(SMALL)
    items = [r["text"] for r in queries.table(spark, sf, "benchmark").collect()]
    filler = [" ".join(f"word{k}x{j}" for j in range(120)) for k in range(2 * len(items))]
    rows = [(k, f"{filler[k]} {t} {filler[k][::-1]}", "en", "s", 1) for k, t in enumerate(items)] + [(1000 + k, filler[k], "en", "s", 1) for k in range(len(items), 2 * len(items))]
    stage = dict(corpus_pipeline.STAGES)["decontamination"]
    assert {r["doc_id"] for r in stage(spark, spark.createDataFrame(rows, KIND), sf).collect()} == {1000 + k for k in range(len(items), 2 * len(items))}
