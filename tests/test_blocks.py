"""Block algebra, lifted regions, calls and paired haplotypes, on small inputs worked by hand; open genotypes."""

import pytest
from pyspark.sql import functions as F

from genoweave.functions import seq
from genoweave.functions.seq import SUBSTITUTION
from genoweave.operators import aligners, blocks, kernels, posmap
from genoweave.plans import calls, genotype
from genoweave.sources.readers import ROW


def row(*v):
    return dict(zip(("src", "start", "size", "strand", "src_size", "text"), v, strict=True))


@pytest.fixture
def frame(spark):
    rows = [row("a.1", 10, 5, "+", 100, "AC-GTA"), row("b.1", 20, 4, "-", 50, "A--GTC"), row("c.1", 0, 2, "+", 9, "--T--G")]
    return spark.createDataFrame([(1, rows)], f"id int, rows array<{ROW}>")


def texts(df, c):
    return [(r["src"], r["start"], r["size"], r["strand"], r["text"]) for r in df.select(c.alias("x")).first()["x"]]


def test_slices_drop_empty_rows_and_dash_columns(frame):
    got = texts(frame, blocks.slice_columns(F.col("rows"), F.lit(1), F.lit(4)))
    assert got == [("a.1", 11, 2, "+", "C-G"), ("b.1", 21, 1, "-", "--G"), ("c.1", 0, 1, "+", "-T-")]
    assert texts(frame, blocks.slice_columns(F.col("rows"), F.lit(3), F.lit(5))) == [("a.1", 12, 2, "+", "GT"), ("b.1", 21, 2, "-", "GT")]
    assert [t[4] for t in texts(frame, blocks.slice_positions(F.col("rows"), F.lit(11), F.lit(13)))] == ["C-G", "--G", "-T-"]
    assert texts(frame, blocks.slice_positions(F.col("rows"), F.lit(90), F.lit(95))) == []


def test_row_order_and_flip(frame):
    got = texts(frame, blocks.order_rows(F.col("rows"), ["b", "a", "none"]))
    assert got == [("b.1", 26, 4, "+", "GAC-T"), ("a.1", 85, 5, "-", "TACGT")]
    assert [t[0] for t in texts(frame, blocks.flip(F.col("rows")))] == ["b.1", "a.1", "c.1"]
    assert texts(frame, blocks.drop_top(F.col("rows")))[0][4] == "A-GTC"
    assert blocks.find(frame, "c.", 1, 5).count() == 1 and blocks.find(frame, "a.", 15, 20).count() == 0
    assert blocks.find(frame, "a.", 12, 13, cut=True).first()["rows"][0]["text"] == "GT"


def test_two_rows_of_a_genome_are_an_error(spark):
    df = spark.createDataFrame([([row("a.1", 0, 1, "+", 9, "A"), row("a.2", 0, 1, "+", 9, "C")],)], f"rows array<{ROW}>")
    with pytest.raises(Exception, match="two rows of"):
        df.select(blocks.order_rows(F.col("rows"), ["a"]).alias("x")).collect()


def test_threads(spark):
    iv = spark.createDataFrame([("c", 2, 4), ("c", 3, 6)], "contig string, st long, en long")
    seqs = spark.createDataFrame([("c", "AACCGGTT"), ("d", "AC")], "contig string, seq string")
    assert {(r["rows"][0]["src"], r["rows"][0]["start"], r["rows"][0]["text"]) for r in blocks.threads(iv, seqs).collect()} == {("c", 0, "AA"), ("c", 6, "TT"), ("d", 0, "AC")}


def test_lift(spark):
    paf = spark.createDataFrame([("q", 100, 10, 25, "+", "t", 200, 50, 67, 15, 17, 60, "5M2D5M3I2M3D"), ("q", 100, 60, 70, "-", "t", 200, 100, 110, 10, 10, 60, "10M")], "qname string, qlen long, qs long, qe long, strand string, tname string, tlen long, ts long, te long, nmatch long, blen long, mapq int, cg string")
    regions = spark.createDataFrame([("q", 12, 18), ("q", 5, 12), ("q", 21, 30), ("q", 62, 65)], "contig string, st long, en long")
    got = {r["name"]: (r["st"], r["en"]) for r in calls.lift_regions(paf, regions, length=1).collect()}
    assert got == {"q_12_18": (52, 60), "q_5_12_t5": (50, 52), "q_21_30_t3": (62, 67), "q_62_65": (105, 108)}


def test_calls_and_lines(spark):
    rows = [(1, "q", 0, 30, "+", "t", 10, 40, 30, 60, "P", ":4*ag:5-ac:6+gg:12"), (2, "p", 0, 9, "+", "t", 18, 27, 9, 60, "P", ":9"), (3, "s", 0, 30, "+", "t", 10, 40, 30, 60, "S", ":30")]
    paf = spark.createDataFrame(rows, "id long, qname string, qs long, qe long, strand string, tname string, ts long, te long, blen long, mapq int, type string, cs string")
    found = {(r["st"], r["en"], r["ref"], r["alt"]): r["depth"] for r in calls.call_variants(paf, cover=5, long=20).collect()}
    assert found == {(14, 15, "a", "g"): 1, (20, 22, "ac", "-"): 2, (28, 28, "-", "gg"): 1}
    refs = spark.createDataFrame([("t", "T" * 27 + "C" + "T" * 30)], "contig string, seq string")
    lines = sorted(r["line"].split("\t")[1:5] for r in calls.call_lines(calls.call_variants(paf, cover=5, long=20), refs).collect())
    assert lines == [["15", ".", "A", "G"], ["28", ".", "C", "CGG"]]
    assert {(r["st"], r["en"]) for r in calls.covered_once(calls.primary(paf, 5, 5), long=20).collect()} == {(10, 18), (27, 40)}


def test_haplotypes(spark):
    df = spark.createDataFrame([("chr1", 5, "A", ["0/0:3,1", "1/1:0,4"]), ("chr1", 6, "A", ["0/1:3,1", "./.:0,0"]), ("chrX", 3_000_000, "A", ["./.:0,0", "1/1:0,4"]), ("chrX", 100, "A", ["./.:0,0", "1/1:0,4"]), ("other", 1, "A", ["0/0:1", "0/0:1"])], "chrom string, pos long, ref string, genotypes array<string>")
    got = {(r["chrom"], r["pos"]): (r["filter"], r["genotype"]) for r in calls.pair_haplotypes(df, male=True, assembly="38").collect()}
    assert got == {("chr1", 5): (".", "0|1:3,5"), ("chr1", 6): ("HET1;GAP2", ".|.:3,1"), ("chrX", 3_000_000): (".", ".|1:0,4"), ("chrX", 100): ("GAP1", ".|1:0,4")}


BLOCK = "block long, contig string, sample string, q_contig string, q_strand string, q_size long, t_start long, t_text string, q_start long, q_text string"


def test_pieces_keep_positions(spark):
    import random

    rnd = random.Random(9)
    t, q = ("".join(rnd.choice("ACGT-") for _ in range(95)) for _ in range(2))
    df = spark.createDataFrame([(1, "c", "S", "q", "+", 1000, 7, t, 30, q)], BLOCK)
    want, t_at, q_at = set(), 7, 30
    for x, y in zip(t, q, strict=True):
        if x != "-" and y != "-":
            want.add((t_at, q_at, x, y))
        t_at, q_at = t_at + (x != "-"), q_at + (y != "-")
    assert posmap.pieces(df, 16).count() == 6
    for width in (1, 16, 512):
        got = [(r["t_from"] + i, r["q_own"] + i, r["t_seq"][i], r["q_seq"][i]) for r in posmap.aligned_runs(df, width).collect() for i in range(r["t_to"] - r["t_from"] + 1)]
        assert len(got) == len(want) and set(got) == want
    long = df.withColumn("t_text", F.repeat("t_text", 40)).withColumn("q_text", F.repeat("q_text", 40))
    assert posmap.position_runs(long).agg(F.sum(F.col("t_to") - F.col("t_from") + 1)).first()[0] == 40 * len(want)


def test_open_deletion_is_decided_by_the_alignment(spark):
    import random

    rnd = random.Random(4)
    ref = "".join(rnd.choice("ACGT") for _ in range(400))
    # S1 lacks 101..160 but for ten letters, so its span is neither; S2 has all of it with an insertion of 30
    lack = ref[:100] + "-" * 25 + ref[125:130] + "-" * 30 + ref[160:]
    more_t, more_q = ref[:130] + "-" * 30 + ref[130:], ref[:130] + "A" * 30 + ref[130:]
    df = spark.createDataFrame([(1, "c", "S1", "q", "+", 9999, 0, ref, 0, lack), (2, "c", "S2", "q", "+", 9999, 0, more_t, 0, more_q)], BLOCK)
    v = spark.createDataFrame([("c", 101, 160, 60, "DEL", 50, 50)], "contig string, beg long, fin long, len long, kind string, five long, three long")
    open_calls = {r["sample"]: r["gt"] for r in genotype.genotype_del(v, posmap.position_runs(df), slack=3).collect()}
    assert open_calls == {"S1": "window", "S2": "window"}
    assert {r["sample"]: r["gt"] for r in genotype.genotype_deletions(v, df, slack=3).collect()} == {"S1": "1|1", "S2": "0|0"}


def test_open_insertion_is_decided_by_its_sequence(spark):
    import random

    rnd = random.Random(6)
    ref, new = ("".join(rnd.choice("ACGT") for _ in range(n)) for n in (400, 60))
    have = ref[:200] + new + ref[200:]
    other = ref[:200] + "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] for c in reversed(new)) + ref[200:]
    t = ref[:200] + "-" * 60 + ref[200:]
    df = spark.createDataFrame([(i, "c", f"S{i}", f"S{i}.q", "+", len(x), 0, y, 0, x) for i, (y, x) in enumerate(((t, have), (t, other), (ref, ref)), 1)], BLOCK)
    variant = "contig string, beg long, fin long, len long, kind string, five long, three long, query string, q_st long, q_en long"
    v = spark.createDataFrame([("c", 200, 200, 60, "INS", 150, 150, "S1.q", 201, 260)], variant)
    own = spark.createDataFrame([(f"S{i}", f"S{i}.q", x) for i, x in enumerate((have, other, ref), 1)], "sample string, contig string, seq string")
    runs = posmap.position_runs(df)
    got = {r["sample"]: r["gt"] for r in genotype.genotype_insertions(v, runs, own).collect()}
    assert got["S1"] == "1|1" and got["S3"] == "0|0"
    # S2 holds other letters of the same length: the rule looks at both flanks and at the letter before the insertion, so it is walked here
    a, b, identity = aligners.align_pair(have[100:360], other[99:360])
    assert identity <= 95
    at, n, h, m = 0, [0, 0, 0], [0, 0, 0], [0, 0, 0]
    for x, y in zip(a, b, strict=True):
        k = 0 if at < 99 else 1 if at < 100 else 2
        if x != "-":
            n[k], h[k], m[k], at = n[k] + 1, h[k] + (y != "-"), m[k] + (x == y), at + 1
    flanks = all(m[k] / (h[k] + 1) >= 0.75 and h[k] / (n[k] + 1) >= 0.2 for k in (0, 2))
    region = m[1] / (n[1] + 1)
    want = "1|1" if flanks and region >= 0.4 else "0|0" if flanks and region < 0.1 else ".|."
    assert got["S2"] == want
    # genomes among the members carry it, whatever their sequence
    held = v.withColumn("members", F.array(F.lit("S3.x"), F.lit("S9.y")))
    assert {r["sample"]: r["gt"] for r in genotype.genotype_insertions(held, runs, own).collect()} == {"S1": got["S1"], "S2": got["S2"], "S3": "1|1", "S9": "1|1"}
    none = own.where("sample <> 'S1'")  # without the sequence of the genome that gave it
    assert {r["sample"]: r["gt"] for r in genotype.genotype_insertions(v, runs, none).collect()} == {"S1": ".|.", "S2": ".|.", "S3": "0|0"}


def test_insertions_merge_as_a_plain_walk_does(spark):
    import random

    from genoweave.operators import folds

    rnd = random.Random(8)
    seeds = ["".join(rnd.choice("ACGT") for _ in range(n)) for n in (8, 20, 60)]
    rows = []
    for i in range(160):
        s = rnd.choice(seeds)
        s = "".join(c if rnd.random() > 0.1 else rnd.choice("ACGT") for c in s)
        beg = rnd.randrange(200)
        rows.append((f"{i:03d}", f"c{i % 2}", beg, beg, len(s), "s", s, s[:3], s[-3:]))
    df = spark.createDataFrame(rows, "id string, contig string, beg long, end long, len long, sample string, seq string, five string, three string")
    want = {}
    for contig in ("c0", "c1"):
        reps, count = [], 0
        for r in sorted((r for r in rows if r[1] == contig), key=lambda r: (r[2], r[3], r[4], r[0])):
            now = {"beg": r[2], "len": r[4], "seq": r[6], "five": r[7], "three": r[8]}
            hit = next((n for n, rep in reps[::-1][:21] if folds.same_insertion(rep, now)), None)
            if hit is None:
                hit, count = count, count + 1
                reps.append((hit, now))
            want[r[0]] = hit
    assert {r["id"]: r["cluster"] for r in folds.merge_insertions(df).collect()} == want


def walked_once(rows):
    """Blocks (start, top, other) sorted by start, cut one pair after the other by slicing their rows."""
    score_of = {a + b: v for a, r in zip("ACGT", SUBSTITUTION, strict=True) for b, v in zip("ACGT", r, strict=True)}

    def score(top, other):
        total, state = 0, 0
        for x, y in zip(top, other, strict=True):
            now = 1 if x == "-" else 2 if y == "-" else 0
            total += score_of[x + y] if not now else -30 - (400 if now != state else 0)
            state = now
        return total

    def column(block, pos):
        seen = block[0] - 1
        for c, x in enumerate(block[1]):
            seen += x != "-"
            if seen == pos:
                return c

    end = lambda b: b[0] + len(b[1].replace("-", "")) - 1
    now = list(rows)
    for i in range(len(now)):
        for j in range(i + 1, len(now)):
            if now[i] is None:
                break
            if now[j] is None or end(now[j]) < now[i][0] or end(now[i]) < now[j][0]:
                continue
            if end(now[i]) >= end(now[j]):
                now[j] = None
                continue
            e = end(now[i])
            a, b = column(now[i], max(now[i][0], now[j][0])), column(now[j], e)
            if score(now[i][1][a:], now[i][2][a:]) <= score(now[j][1][: b + 1], now[j][2][: b + 1]):
                now[i] = (now[i][0], now[i][1][:a], now[i][2][:a])
            else:
                c = column(now[j], e + 1)
                now[j] = (e + 1, now[j][1][c:], now[j][2][c:])
            for k in (i, j):
                if now[k] and (len(now[k][1]) < 6 or not now[k][1].replace("-", "")):
                    now[k] = None
    return [b and (b[1], b[2]) for b in now]


def test_single_coverage_as_a_plain_walk_does(spark):
    import random

    rnd = random.Random(12)
    rows, blocks_in = [], []
    for i in range(60):
        n = rnd.randrange(6, 60)
        t, q = "".join(rnd.choice("ACGT--") for _ in range(n)), ""
        q = "".join(rnd.choice("ACGT") if x == "-" else rnd.choice((x, x, x, "A", "-")) for x in t)
        rows.append((rnd.randrange(300), t, q))
        blocks_in.append((i, "c", "S", f"q{i % 3}", rnd.choice("+-"), 1000, rows[-1][0], t, rnd.randrange(300), q))
    order = sorted(range(60), key=lambda i: (rows[i][0], -len(rows[i][1].replace("-", "")), i))
    cuts = kernels.cover_once([rows[i] for i in order])
    got = [(rows[i][1][a:b], rows[i][2][a:b]) if b > a else None for i, (a, b) in zip(order, cuts, strict=True)]
    assert got == walked_once([rows[i] for i in order])
    for top, other in rnd.sample([r[1:] for r in rows], 20):
        df = spark.createDataFrame([(top, other)], "a string, b string")
        assert kernels.range_score(top, other) == df.select(seq.pair_score(F.col("a"), F.col("b"))).first()[0]
    df = spark.createDataFrame(blocks_in, BLOCK)
    kept = kernels.single_coverage(df).collect()
    assert kept
    for side in ("t", "q"):
        seen = set()
        for r in kept:
            n = len(r[f"{side}_text"].replace("-", ""))
            start = r["t_start"] if side == "t" else r["q_start"] if r["q_strand"] == "+" else 1000 - r["q_start"] - n
            own = {(r["contig"] if side == "t" else r["q_contig"], p) for p in range(start, start + n)}
            assert n and not own & seen
            seen |= own
    whole = {b[0]: b for b in blocks_in}
    for r in kept:  # what is left of a block is a run of its columns, at its place
        b = whole[r["block"]]
        at = next(i for i in range(len(b[7])) if b[7][i:].startswith(r["t_text"]) and b[9][i:].startswith(r["q_text"]) and b[6] + i - b[7][:i].count("-") == r["t_start"])
        assert b[8] + at - b[9][:at].count("-") == r["q_start"]
