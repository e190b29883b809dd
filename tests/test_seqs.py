"""Ranges by chunks, windows by tiles, and evaluations, against plain walks."""

import random

from pyspark.sql import functions as F

from genoweave.operators import seqs
from genoweave.operators.tiles import beside
from genoweave.plans import assess, calls
from genoweave.sources import readers


def test_ranges_by_chunks(spark):
    rnd = random.Random(1)
    text = {c: "".join(rnd.choice("ACGTN") for _ in range(n)) for c, n in (("a", 100), ("b", 33), ("c", 0))}
    parts = seqs.chunked(spark.createDataFrame(list(text.items()), "contig string, seq string"), size=16)
    rows = [(i, rnd.choice("abcd"), rnd.randrange(-20, 110), rnd.randrange(-20, 130)) for i in range(200)] + [(200, None, 1, 2), (201, "a", None, 3), (202, "a", 5, 90), (203, "a", 5, 90)]
    df = spark.createDataFrame(rows, "id int, contig string, st int, en int")
    got = {r["id"]: r["s"] for r in seqs.letters(df, parts, "s", "st", "en", size=16).collect()}
    assert got == {i: (text.get(c, "")[max(0, a) : max(0, b)] or None) if c and a is not None else None for i, c, a, b in rows}
    whole = spark.createDataFrame(list(text.items()), "contig string, seq string").withColumn("length", F.length("seq"))
    soft = spark.createDataFrame([("a", 2, 5), ("a", 4, 9), ("b", 0, 3)], "contig string, st long, en long")
    got = {r["contig"]: r["seq"] for r in readers.fasta_range(whole, "[2,20]", soft).collect()}
    low = lambda c, lo, hi: text[c][:lo] + text[c][lo:hi].lower() + text[c][hi:]
    assert got == {"a": low("a", 2, 9)[1:20], "b": low("b", 0, 3)[1:20], "c": ""}
    assert {r["header"] for r in readers.contig_headers(whole).collect()} == {">a:1-100:+:100", ">b:1-33:+:33", ">c:1-0:+:0"}
    bad = spark.createDataFrame([("x/1ab.fa", ">1ab.c", "AC"), ("x/ab.fa", ">ab.c1", "ACgn"), ("x/ab.fa", ">other", "AC"), ("x/ab.fa", "ab.c", "AC"), ("x/ab.fa", ">ab.c", "A!")], "path string, header string, seq string")
    assert sorted(r["problem"] for r in readers.check_names(bad).collect()) == ["begins with a digit", "name without the genome", "not FASTA", "not FASTA"]


def test_windows_by_tiles(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(("a", "b", None)), rnd.randrange(100), rnd.randrange(50)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, contig string, pos int, v int")
    values = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "n": ("min", F.struct("pos", "id"))}
    for before in (True, False):
        got = {r["id"]: (r["s"], r["m"], tuple(r["n"]) if r["n"] else None) for r in beside(df, ("contig",), "pos", ["pos", "id"], values, before, tile=7).collect()}
        for i, c, p, _ in rows:
            side = [r for r in rows if r[1] == c and ((r[2], r[0]) < (p, i) if before else (r[2], r[0]) > (p, i))]
            assert got[i] == (sum(r[3] for r in side), max((r[3] for r in side), default=None), min(((r[2], r[0]) for r in side), default=None))


def test_map_eval_modes(spark):
    kind = "qname string, contig string, st long, en long, strand string, mapq int, score int, no int"
    rows = [
        ("r!c!0!100!+", "c", 0, 100, "+", 60, 90, 1), ("r!c!0!100!+", "d", 0, 100, "+", 70, 10, 2),
        ("s!c!0!100!-", "c", 0, 100, "+", 30, 50, 3), ("s!c!0!100!-", "c", 50, 150, "-", 20, 60, 4),
        ("t!c!10_300!80_400!+-/2", "c", 300, 390, "-", 5, 9, 5), ("u!c!0!100!+", "c", 95, 200, "+", 5, 9, 6),
    ]
    df = spark.createDataFrame(rows, kind).withColumn("truth", assess.true_place(F.col("qname")))
    of = lambda **o: [tuple(r)[:3] + (r["total"],) for r in assess.map_eval(df, **o).orderBy(F.desc("mapq")).collect()]
    assert of(mode=0) == [(60, 2, 0, 2), (5, 2, 1, 4)]
    assert of(mode=1) == [(60, 1, 0, 1), (30, 1, 1, 2), (5, 2, 1, 4)]
    assert of(mode=2) == [(60, 1, 1, 1), (30, 1, 1, 2), (5, 2, 1, 4)]
    assert of(mode=2, cap=True) == [(60, 1, 1, 1), (20, 1, 1, 2), (5, 2, 1, 4)]


def test_misjoins_skip_every_second_of_a_run(spark):
    rnd = random.Random(3)
    rows = [(i, f"q{i % 12}", i * 10, i * 10 + 100, rnd.choice("+-"), rnd.choice(("c", "c", "c", "d")), i * 10, i * 10 + 100, 100) for i in range(400)]
    want = []
    for q in range(12):
        a, i = [r for r in rows if r[1] == f"q{q}"], 1
        while i < len(a):
            x, y = a[i - 1], a[i]
            if x[5] != y[5]:
                want.append((y[0], "contig"))
            elif x[4] == y[4]:
                dr = y[6] - x[7] if y[4] == "+" else x[6] - y[7]
                if abs(dr - (y[2] - x[3])) > 50:
                    want.append((y[0], "gap"))
            elif i + 1 < len(a) and a[i + 1][4] == x[4]:
                want.append((y[0], "inversion"))
                i += 1
            else:
                want.append((y[0], "end"))
            i += 1
    df = spark.createDataFrame(rows, "id int, qname string, qs long, qe long, strand string, tname string, ts long, te long, blen long")
    assert sorted((r["id"], r["kind"]) for r in assess.misjoins(df, least=1, far=50).collect()) == sorted(want)


def test_sv_eval_is_by_sign_and_size(spark):
    kind = "id int, contig string, st long, en long, change long"
    base = spark.createDataFrame([(1, "c", 1000, 1001, 100), (2, "c", 5000, 5100, -100), (3, "c", 9000, 9001, 300), (4, "c", 20_000, 20_001, 60), (5, "c", 1, 2, 10)], kind)
    call = spark.createDataFrame([(1, "c", 1400, 1401, 120), (2, "c", 5000, 5001, 100), (3, "c", 9000, 9001, 100), (4, "c", 20_100, 20_101, 500), (5, "c", 20_200, 20_201, 900)], kind)
    assert tuple(assess.sv_counts(base, call).first()) == (4, 2, 5, 1)
    assert [round(x, 6) for x in assess.sv_scores(assess.sv_counts(base, call)).first()] == [0.5, 0.2, 0.35]


def test_pseudoautosomal_limits(spark):
    kind = "chrom string, pos long, ref string, genotypes array<string>"
    rows = [("chrX", 154_931_043, "A", ["./.:1", "0/0:1"]), ("chrX", 154_931_042, "A", ["./.:1", "0/0:1"])]
    got = [r["filter"] for r in calls.pair_haplotypes(spark.createDataFrame(rows, kind), male=True, assembly="37").orderBy(F.desc("pos")).collect()]
    assert got == ["GAP1", "."]
