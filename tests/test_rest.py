"""Rules, readers and writers that no query needs, by hand or by plain walks."""

import random

from pyspark.sql import functions as F

from genoweave.functions import cigar, interval, seq
from genoweave.operators import blocks, folds, nets
from genoweave.plans import snp
from genoweave.sources import readers, writers


def values(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_column_rules(spark):
    n = F.lit
    assert values(spark, interval.jaccard_over(n(0), n(10), n(5), n(15), 0.3), interval.jaccard_over(n(0), n(10), n(5), n(15), 0.34)) == (True, False)
    assert values(spark, interval.y_intercept(n(0), n(10), n(10), n(30), n(4)), interval.y_intercept(n(5), n(7), n(5), n(9), n(5))) == (18, 7)
    assert values(spark, *seq.choose_k(n(49)), *seq.choose_k(n(50)), *seq.choose_k(n(51))) == (True, False, False, False, False, True)
    assert values(spark, cigar.md_ops(n("10A5^AC6"))) == (["10", "A", "5", "^AC", "6"],)
    texts = ("ACGT", "AC-T", "ACTT")
    made = F.array(*[F.struct(n("x").alias("src"), n(0).cast("long").alias("start"), n(4).cast("long").alias("size"), n("+").alias("strand"), n(9).cast("long").alias("src_size"), n(t).alias("text")) for t in texts])
    pairs = [values(spark, seq.pair_score(n(a), n(b)))[0] for a, b in (texts[:2], texts[::2], texts[1:])]
    assert values(spark, blocks.sum_of_pairs(made)) == (sum(pairs),)


def test_allele_frequencies(spark):
    df = spark.createDataFrame([(1, 3), (3, 3)], "ac int, ns int")
    assert [r["af"] for r in snp.with_af(df).collect()] == ["0.33", "1"]


def test_exemplars_cover_with_the_farthest(spark):
    rnd = random.Random(8)
    rows = [(i, f"c{i % 2}", s := rnd.randrange(300), s + rnd.randrange(1, 60)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, contig string, st long, en long")
    want = set()
    for c in ("c0", "c1"):
        own = sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], -r[3]))
        covered = own[0][2]
        while True:
            left = [r for r in own if r[3] > covered]
            if not left:
                break
            near = [r for r in left if r[2] <= covered]
            best = max(near, key=lambda r: r[3]) if near else None
            if best is None:
                covered = min(r[2] for r in left)
                continue
            want.add((best[1], best[3]))
            covered = best[3]
    got = {(r["contig"], r["en"]) for r in folds.exemplars(df, ["contig"]).collect()}
    assert got == want


def test_nets_without_fills_go(spark):
    df = spark.createDataFrame([("a", "fill"), ("a", "gap"), ("b", "gap")], "net string, kind string")
    assert {r["net"] for r in nets.drop_empty(df).collect()} == {"a"}


def test_lists_pairs_sizes_and_tables(spark, tmp_path):
    (tmp_path / "l.txt").write_text(" one \n\ntwo\n")
    assert [r["name"] for r in readers.read_list(spark, str(tmp_path / "l.txt")).collect()] == ["one", "two"]
    (tmp_path / "s.txt").write_text("c1\t50\n\nc2\t7\n")
    assert [tuple(r) for r in readers.read_sizes(spark, str(tmp_path / "s.txt")).collect()] == [("c1", 50), ("c2", 7)]
    for name in ("RefvsQ1.axt", "other.txt"):
        (tmp_path / "d").mkdir(exist_ok=True)
        (tmp_path / "d" / name).write_text("x")
    assert [(r["target"], r["query"]) for r in readers.read_pairs(spark, str(tmp_path / "d")).collect()] == [("Ref", "Q1")]
    (tmp_path / "a.paf").write_text("q\t9\t0\t9\t+\tt\t9\t0\t9\t9\t9\t60\n@SQ\tSN:c\nr\t0\tc\t1\t60\t4M\t*\t0\t0\tACGT\t*\n")
    assert [(r["format"], r["qname"]) for r in readers.read_alignments(spark, str(tmp_path / "a.paf")).collect()] == [("paf", "q"), ("sam", "r")]
    df = spark.createDataFrame([("b", 2), ("a", 9), ("a", 1)], "x string, y int")
    writers.write_table(df, str(tmp_path / "t"), ["x", "y"], names=False)
    assert "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))) == "a\t1\na\t9\nb\t2\n"


def test_ranges_and_masks(spark):
    seqs = spark.createDataFrame([("c", "ACGTACGT"), ("d", "TTTT")], "contig string, seq string")
    asked = spark.createDataFrame([("c", -2, 3), ("c", 5, 99), ("e", 0, 4)], "contig string, st long, en long")
    assert sorted((r["st"], r["seq"]) for r in readers.fetch(asked, seqs).collect()) == [(-2, "ACG"), (0, None), (5, "CGT")]
    masked = spark.createDataFrame([("c", 1, 3), ("c", 6, 8)], "contig string, st long, en long")
    assert {r["contig"]: r["seq"] for r in readers.fasta_range(seqs, "", masked, "X").collect()} == {"c": "AXXTACXX", "d": "TTTT"}


def test_header_lines_with_a_reference(spark):
    calls = spark.createDataFrame([("c1", 5, 9, 4, "DEL", "ACGTA", "A", "1|1")], "contig string, beg long, fin long, len long, kind string, ref string, alt string, S0 string")
    sizes = spark.createDataFrame([("c1", 50), ("c0", 7)], "name string, length long")
    lines = [r["line"] for r in writers.sv_vcf(calls, sizes, ["S0"], reference="R1", species="Rice", date="2024-01-02").orderBy("part", "contig", "pos").collect()]
    assert lines[:6] == [
        "##fileformat=VCFv4.2", "##fileDate=2024-01-02", "##source=genoweave", "##reference=R1",
        '##contig=<ID=c0,length=7,assembly=R1,md5=XXXXXXXX,species="Rice",taxonomy=x>', '##contig=<ID=c1,length=50,assembly=R1,md5=XXXXXXXX,species="Rice",taxonomy=x>',
    ]
    assert lines[6:-2] == list(writers.SV_META) and lines[-2].endswith("FORMAT\tS0") and lines[-1].startswith("c1\t5\t")
    snps = spark.createDataFrame([("c1", 3, "A", "C", "C")], "contig string, pos long, ref string, alt string, S0 string")
    lines = [r["line"] for r in writers.snp_vcf(snps, sizes, ["S0"], reference="R1").orderBy("part", "contig", "pos").collect()]
    assert "##phasing=phased" in lines and lines.index("##phasing=phased") == 5 and not any(x.startswith("##fileDate") for x in lines)


def test_sequences_of_long_and_cut_calls(spark):
    """A gap of a million letters is told by its ends; flanks before a contig's beginning are shorter; minus strands are turned."""
    rnd = random.Random(9)
    t, q = ("".join(rnd.choice("ACGT") for _ in range(n)) for n in (1_200_000, 300))
    kind = "net string, g_start long, g_end long, g_name string, g_q0 long, g_q1 long, strand string"
    rows = [("n", 100, 1_000_100, "q", 5, 25, "-"), ("n", 10, 40, "q", 100, 120, "+"), ("x", 1, 2, None, None, None, "+")]
    got = {r["g_start"]: r for r in nets.with_sequences(spark.createDataFrame(rows, kind), spark.createDataFrame([("n", t)], "contig string, seq string"), spark.createDataFrame([("q", q)], "contig string, seq string")).collect()}
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    a, b, c = got[100], got[10], got[1]
    assert a["ref_seq"] == t[100:600] + "N" * 10 + t[999_600:1_000_100] and (a["t5"], a["t3"]) == (t[80:100], t[1_000_100:1_000_120])
    assert a["query_seq"] == turned(q[5:26]) and a["q5"] == turned(q[:5]) and a["q3"] == turned(q[25:45])
    assert b["ref_seq"] == t[10:41] and b["t5"] == t[:10] and b["query_seq"] == q[100:121]
    assert c["ref_seq"] is None and c["query_seq"] is None


def test_alleles_of_nine_letters_get_no_class(spark):
    from genoweave.plans import annotate

    v = spark.createDataFrame([("c", 50, "A", "A", "ACGTACGTA", "i"), ("c", 50, "B", "A", "ACGTACGT", "i")], "chrom string, pos long, id string, ref string, alt string, info string")
    refs = spark.createDataFrame([("c", "ACGT" * 50)], "contig string, seq string")
    none = spark.createDataFrame([], "qname string, qlen long, qs long, qe long, tname string")
    assert {r["id"]: r["info"] for r in annotate.annotate(v, refs, none, none, "INS").collect()} == {"A": "i;NF;NF;NF", "B": "i;NONDUP;NF;NF"}


def test_call_statistics_by_length(spark):
    from genoweave.plans import calls

    rows = [("a", "g", 1), ("a", "c", 1), ("T", "C", 1), ("-", "a", 1), ("-", "ac", 1), ("-", "a" * 3, 1), ("-", "a" * 49, 1), ("g" * 50, "-", 1), ("g" * 999, "-", 1), ("g" * 1000, "-", 1), ("-", "-", 1), ("a", "g", 2)]
    df = spark.createDataFrame(rows, "ref string, alt string, depth int")
    got = {(r["kind"], r["within"]): r["n"] for r in calls.call_statistics(df).collect()}
    assert got == {("ts", None): 2, ("tv", None): 1, ("ins", 1): 1, ("ins", 2): 1, ("ins", 49): 2, ("del", 999): 2, ("del", None): 1}
