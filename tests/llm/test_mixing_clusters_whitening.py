"""Mixing, centroid clustering and whitening against plain walks, full matrices and odd rows."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoweave.llm import centroids, mixing, whitening

rnd = random.Random(23)


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


# ---- mixing


def levels(sizes, weights, share, most):
    """Targets by sharing again and again what is above."""
    left, open_ = Fraction(share) * sum(sizes), set(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if level * weights[i] >= Fraction(most) * sizes[i]]
        if not above:
            for i in open_:
                out[i] = level * weights[i]
            break
        for i in above:
            out[i] = Fraction(most) * sizes[i]
            left -= out[i]
            open_.remove(i)
    return out


KIND = "doc_id long, text string, source string, size string, row int"


@pytest.fixture(scope="module")
def mix_rows():
    rows = [(i, " ".join(["wé"] * rnd.choice((0, 1, 3, 3, 3, 40, 400))), rnd.choice(("a", "a", "a", "a", "b", "é", "Z", None, "")), "x", i) for i in range(600)]
    rows += [(7, "same words", "a", "x", 0)] * 200 + [(None, "no id", "b", None, 1), (None, None, None, None, 2), (601, "\t \n", "empty", None, 3)]
    return rows


def test_mix_is_the_walk(spark, mix_rows):
    df = spark.createDataFrame(mix_rows, KIND).repartition(5)
    found = mixing.sampled(df, weights=(5, 2, 1), share=1.5, most=2.0, seed=11, carry=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "copies").collect()
    assert len(found) == len(mix_rows)
    names = sorted({r[2] for r in mix_rows if r[2] is not None}, key=lambda s: s.encode()) + [None]
    sizes = [sum(words(r[1]) for r in mix_rows if r[2] == n) for n in names]
    want = levels(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)
    for n, size, target in zip(names, sizes, want, strict=True):
        own = [r for r in found if r["source"] == n]
        assert {r["source_size"] for r in own} == {size} and all(abs(r["target"] - float(target)) < 1e-6 for r in own)
        assert abs(sum(r["size"] * r["copies"] for r in own) - float(target)) <= max(r["size"] for r in own) + 1e-6
        assert all(0 <= r["copies"] <= 2 for r in own)
        # copies by the running sum in order of size, by exact fractions
        each = int(np.floor(float(target) / size * mixing.UNIT + 0.5)) if size else 0
        offset = int(hashlib.sha256(f"11:{str(n is None).lower()}:{n or ''}".encode()).hexdigest()[:6], 16)
        order = sorted(own, key=lambda r: (r["size"], hashlib.sha256(f"11:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:16]))
        at = Fraction(offset, mixing.UNIT)
        copies = []
        for _ in order:
            after = at + Fraction(each, mixing.UNIT)
            copies.append(after.__floor__() - at.__floor__())
            at = after
        key = lambda r, c: (r["size"], str(r["doc_id"]), c)
        assert sorted(key(r, c) for r, c in zip(order, copies, strict=True)) == sorted(key(r, r["copies"]) for r in own)
    assert abs(float(sum(want)) - 1.5 * sum(sizes)) < 1e-6


def test_mix_gives_the_rows_and_the_same_ones_again(spark, mix_rows):
    df = spark.createDataFrame(mix_rows, KIND)
    one, two = (mixing.mixed(d, weights=(1, 3), share=0.5) for d in (df, df.repartition(7)))
    assert one.columns == df.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    drawn = mixing.sampled(df, weights=(1, 3), share=0.5)
    assert one.count() == drawn.agg(F.sum("copies")).first()[0]


def test_mix_of_nothing_and_of_everything(spark):
    empty = spark.createDataFrame([], KIND)
    assert mixing.sampled(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a", None, 1), (2, "", None, None, 1)], KIND)
    assert [(r["target"], r["copies"]) for r in mixing.sampled(blank).collect()] == [(0.0, 0)] * 2
    some = spark.createDataFrame([(i, "a b", f"s{i % 2}", None, 1) for i in range(9)], KIND)
    assert {r["copies"] for r in mixing.sampled(some, share=9.0, most=3.0).collect()} == {3}
    one = spark.createDataFrame([(1, "a b c", "s", None, 1)], KIND)
    assert mixing.sampled(one, share=1.0, most=2.0).first()["copies"] == 1


# ---- centroids


def plain_clusters(rows, k, rounds, dim, scale, seed):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [v for _, v in first]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cents)):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if members:
                cents[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    return sorted((str(i), near(v)[1], near(v)[0]) for i, v in kept), cents


EMB = "vec_id long, embedding array<float>, label int, cluster int, id string"


@pytest.mark.parametrize("size,leaf", [(4096, 32), (16, 2), (7, 1)])
def test_clusters_are_those_of_all_distances(spark, size, leaf):
    own = random.Random(size)
    middle = [[own.uniform(-1, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [x + own.gauss(0, 0.05) for x in own.choice(middle)]) for i in range(300)]
    rows += [(i, [round(x * 2) / 2 for x in own.choice(middle)]) for i in range(300, 380)]  # ties
    rows += [(400, [0.25] * 8)] * 120 + [(401, [1.0] * 7), (402, None), (403, [1.0] * 7 + [None]), (404, [1.0] * 7 + [float("nan")]), (405, [float("inf")] * 8), (None, [0.5] * 8), (406, [0.0] * 8), (407, [])]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], EMB).repartition(4)
    want, cents = plain_clusters(rows, 12, 3, 8, 256.0, 2)
    found, last = centroids.cluster(df, k=12, rounds=3, dim=8, size=size, leaf=leaf)
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"]) for r in found.collect()) == want
    assert last.tolist() == cents
    told = centroids.report(found, last).collect()
    assert {r["inertia"] for r in told} == {sum(w[2] for w in want)}
    for r in told:
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest()


def test_trees_prune_whole_nodes_and_large_numbers_stay_exact():
    own = np.random.default_rng(5)
    for large in (1 << 9, 1 << 26):
        middle = own.integers(-large // 2, large // 2, (5, 6))
        points = np.clip(middle[own.integers(0, 5, 500)] + own.integers(-large // 64, large // 64, (500, 6)), -large, large)
        cents = np.concatenate((middle, middle[:1], own.integers(-large, large, (4, 6))))  # one twice: ties
        tree, order = centroids.build(points, 8)
        ends = list(centroids.filtered(tree, cents))
        assert sorted(p for _, lo, hi, _ in ends for p in range(lo, hi)) == list(range(500))
        assert any(len(left) == 1 and hi - lo > 8 for _, lo, hi, left in ends) or large < 1 << 10
        far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c, strict=True)) for c in cents] for p in points[order]]
        own_, dist = centroids.label(tree, cents)
        assert own_.tolist() == [f.index(min(f)) for f in far] and dist.tolist() == [min(f) for f in far]
        counts, sums = centroids.gather(tree, cents)
        for j in range(len(cents)):
            assert counts[j] == (own_ == j).sum() and (sums[j] == points[order][own_ == j].sum(0)).all()


def test_clusters_of_few_and_none(spark):
    none = spark.createDataFrame([], EMB)
    found, last = centroids.cluster(none, dim=4)
    assert found.count() == 0 and len(last) == 0 and centroids.report(found, last).count() == 0
    few = spark.createDataFrame([(1, [1.0, 2.0], 0, 0, ""), (2, [5.0, 5.0], 0, 0, "")], EMB)
    found, last = centroids.cluster(few, k=40, dim=2)
    assert len(last) == 2 and sorted(r["distance"] for r in found.collect()) == [0, 0]
    bare = spark.createDataFrame([(None, [1.0, 2.0], 0, 0, "")], EMB)
    assert centroids.cluster(bare, k=2, dim=2)[0].count() == 0


# ---- whitening


def plain_whitening(x, k):
    n, s = len(x), x.sum(0)
    a = np.array([[float(Fraction(int(n * v - t), n)) for v, t in zip(r, s, strict=True)] for r in x])
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    deviation = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(r, s, strict=True)) for r in x]
    return a @ u / np.sqrt(e), e / np.trace(a.T @ a / n), deviation


def whitened_rows(df, **options):
    rows = whitening.whiten(df, **options).collect()
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    return rows, by


@pytest.mark.parametrize("spread", ["flat", "falling", "steep"])
def test_whitening_by_the_full_covariance(spark, spread):
    own = np.random.default_rng(9)
    scale = {"flat": np.ones(30), "falling": 0.8 ** np.arange(30), "steep": 10.0 ** -np.arange(30)}[spread]
    c = (own.standard_normal((400, 30)) * scale @ np.linalg.qr(own.standard_normal((30, 30)))[0]).astype(np.float32)
    rows = [(i, v.tolist(), 0, 0, "") for i, v in enumerate(c)]
    odd = [(900, None, 0, 0, ""), (901, [1.0] * 29 + [None], 0, 0, ""), (902, [1.0] * 29 + [float("nan")], 0, 0, ""), (903, [1.0, 2.0], 0, 0, ""), (904, [], 0, 0, "")]
    x = np.floor(c.astype(float) * 1024).astype(np.int64) + 100_000
    want, explained, deviation = plain_whitening(x, 8)
    found, by = whitened_rows(spark.createDataFrame(rows + odd, EMB).repartition(3))
    assert set(by) == set(range(400)) and {r["n"] for r in found} == {400}
    many = len(by[0])
    assert many == (8 if spread != "steep" else sum(whitening.RANK < explained / explained[0]))
    assert all(by[i][1]["deviation"] == deviation[i] for i in by)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-4
    for k in range(1, many + 1):
        got = np.array([by[i][k]["whitened"] for i in range(400)])
        assert abs(by[0][k]["explained"] / explained[k - 1] - 1) < 1e-6
        if spread != "steep" or k < 4:
            sign = np.sign(got @ want[:, k - 1])
            assert np.abs(sign * got - want[:, k - 1]).max() < 1e-6


def test_basis_is_expanded_only_where_residuals_fail(spark):
    own = np.random.default_rng(3)
    for scale, full in ((np.ones(40), True), (10.0 ** -np.arange(40), False)):
        c = own.standard_normal((300, 40)) * scale * 100
        df = whitening._rows(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "vec_id long, embedding array<double>"), "vec_id", "embedding")
        found = whitening.fit(df, whitening.Integers(40), 3, 5, 4)
        assert found.full is full and found.passes <= 6
        assert np.abs(found.basis.T @ found.basis - np.eye(len(found.values))).max() < 1e-12


def test_rank_and_large_numbers(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(one).count() == 0 and whitening.whiten(one.where("false")).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)] + [(4, [4.0, 8.0, 0.0])], "vec_id long, embedding array<float>")
    rows = whitening.whiten(line).collect()
    assert {r["component"] for r in rows} == {1} and len(rows) == 10 and abs(rows[0]["explained"] - 1) < 1e-12
    x = np.array([[1 << 50, 3], [-(1 << 50), 5], [7, 9]])
    want = [sum((3 * int(v) - int(t)) ** 2 for v, t in zip(r, x.sum(0), strict=True)) for r in x]
    assert whitening.deviations(x, 3, [int(s) for s in x.sum(0)]) == want
    far = spark.createDataFrame([(1, [2.0**39, 0.0]), (2, [-(2.0**39), 1.0]), (3, [2.0**60, 1.0])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(far).collect()
    assert {r["vec_id"] for r in rows} == {1, 2} and {r["deviation"] for r in rows} == {None}
