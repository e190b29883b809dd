"""Blocks of several genomes, conversions and annotation, worked by hand or by plain walks."""

import pytest
from pyspark.sql import functions as F

from genoweave.operators import multi
from genoweave.plans import annotate
from genoweave.sources import convert
from genoweave.sources.readers import ROW


def row(src, start, strand, size, text):
    return dict(src=src, start=start, size=len(text.replace("-", "")), strand=strand, src_size=size, text=text)


@pytest.fixture(scope="module")
def lists(spark):
    a = [[row("r.1", 2, "+", 40, "ACGTACGTAC"), row("a.1", 5, "+", 50, "ACGTAC-TAC")], [row("r.1", 20, "+", 40, "TTTTT"), row("a.1", 30, "-", 50, "TTTTT")]]
    b = [[row("r.1", 6, "+", 40, "ACGT--ACGG"), row("b.1", 0, "+", 60, "ACGTTTAC-G")]]
    return [spark.createDataFrame([(x,) for x in v], f"rows array<{ROW}>") for v in (a, b)]


def texts(df):
    return sorted([tuple((r["src"], r["start"], r["strand"], r["text"]) for r in x["rows"]) for x in df.collect()])


def test_merge_along_a_tree(spark, lists):
    assert multi.parse_tree("((a b), c)") == (("a", "b"), "c") and multi.parse_tree("(a b c)") == (("a", "b"), "c")
    with pytest.raises(ValueError):
        multi.parse_tree("(a b) c")
    got = texts(multi.merge_along(multi.parse_tree("(r (a b))"), "r", {"a": lists[0], "b": lists[1]}))
    tops = sorted((x[0][1], x[0][1] + len(x[0][3].replace("-", "")), tuple(r[0] for r in x)) for x in got)
    assert tops == [(2, 6, ("r.1", "a.1")), (6, 12, ("r.1", "a.1", "b.1")), (12, 14, ("r.1", "b.1")), (20, 25, ("r.1", "a.1"))]
    joint = next(x for x in got if len(x) == 3)
    assert [r[3].replace("-", "") for r in joint] == ["ACGTAC", "AC" + "TAC", "ACGTTTAC"] and len({len(r[3]) for r in joint}) == 1
    # a genome in common: nothing is joined, both parts stay
    assert texts(multi.merge_lists(lists[0], lists[0])) == sorted(texts(lists[0]) * 2)


def test_regions_and_projection(spark, lists):
    seqs = spark.createDataFrame([("r.1", "g" * 40)], "contig string, seq string")
    regions = spark.createDataFrame([(1, "r.1", 0, 24), (2, "r.1", 30, 35), (3, "r.1", 4, 8)], "id int, contig string, st long, en long")
    got = {(r["id"], r["genome"]): r["text"] for r in multi.region_rows(lists[0].union(lists[1]), regions, seqs, "*").collect()}
    # the second list's block begins inside the first's: only what goes beyond it is taken
    assert got[1, "r"] == "gg" + "ACGTACGTAC" + "GG" + "g" * 6 + "TTTT"
    assert got[1, "a"] == "**" + "ACGTAC-TAC" + "**" + "*" * 6 + "TTTT"
    assert got[1, "b"] == "**" + "*" * 10 + "-G" + "*" * 6 + "****"
    assert got[3, "r"] == "GTAC" and got[3, "a"] == "GTAC" and not any(k[0] == 2 for k in got)
    found, rest = multi.project(lists[0], "a")
    assert texts(found.select("rows"))[0][0][:3] == ("a.1", 5, "+") and {x[0][2] for x in texts(found.select("rows"))} == {"+"} and rest.count() == 0
    assert multi.project(lists[0], "b")[0].count() == 0 and multi.project(lists[0], "r", 4, 5)[0].count() == 1
    order = lists[0].withColumn("no", -F.col("rows")[0]["start"])
    assert [tuple(r) for r in multi.unsorted(order).collect()] == [("r.1", 1)]
    two = lists[0].where(F.col("rows")[0]["start"] == 2).select(multi.split_at(F.col("rows"), F.lit(8)).alias("p")).first()["p"]
    assert [[r["text"] for r in p] for p in two] == [["ACGTAC", "ACGTAC"], ["TAC", "TAC"]] and two[1][0]["start"] == 9


def test_evidence_and_pairs(spark, lists):
    joint = multi.merge_lists(lists[0], lists[1]).withColumn("id", F.col("rows")[0]["start"])
    got = {r["id"]: r["share"] for r in multi.evidence(joint, lists[0]).collect()}
    assert got == {2: 1.0, 6: 1 / 3, 12: 0.0, 20: 1.0}
    assert multi.evidence(joint, lists[0], 0.5).count() == 2
    assert multi.pair_options(["a", "b", "c"], [("*", "c", "x"), ("ab", "ab", "y")]) == [("a", "b", "y"), ("a", "c", "x"), ("b", "c", "x")]
    assert [p[:2] for p in multi.pair_options(["a", "b"], [], "b")] == [("b", "a")]


PAF = "id int, qname string, qlen long, qs long, qe long, strand string, tname string, tlen long, ts long, te long, nmatch long, blen long, mapq int, cs string, cg string"


def test_texts_of_alignments(spark):
    paf = spark.createDataFrame([(1, "q_1", 9, 0, 7, "-", "t_1", 20, 3, 10, 5, 8, 60, "=ACG*ac-t+gg=A", "4M1D2I1M")], PAF)
    text = convert.alignment_text(paf, 5).first()["text"]
    first, second = text.split("\n\n")
    assert first.split("\n") == ["Ref+:          4 ACGat 8         ", " " * 17 + "|||  ", "Qry-:          7 ACGc- 4         "]
    assert second.split("\n") == ["Ref+:          9 --A 9         ", " " * 17 + "  |", "Qry-:          3 ggA 1         "]
    block = spark.createDataFrame([(12.0, [row("a", 9, "+", 50, "ACG-TTA"), row("b", 4, "+", 50, "AAGCTT-")])], f"score double, rows array<{ROW}>")
    lav = block.select(convert.lav_stanza(F.col("score"), F.col("rows")).alias("s")).first()["s"]
    assert lav == "a {\n  s 12\n  b 10 5\n  e 15 10\n  l 10 5 12 7 66\n  l 13 9 14 10 100\n}"


def test_pairs_of_any_aligner(spark):
    paf = spark.createDataFrame([(1, "q_1", 9, 1, 6, "-", "t_1", 20, 3, 8, 4, 5, 60, "=ACG*ac=T", "5M")], PAF)
    got = convert.pair_blocks(paf, "minimap2_chr", "t", "q").first()["rows"]
    assert [(r["src"], r["start"], r["strand"], r["text"]) for r in got] == [("t.1", 3, "+", "ACGAT"), ("q.1", 3, "-", "ACGCT")]
    swapped = convert.pair_blocks(paf, "minimap2_chr", "t", "q", swap=True).first()["rows"]
    assert [(r["src"], r["start"], r["strand"], r["text"]) for r in swapped] == [("q.1", 1, "+", "AGCGT"), ("t.1", 12, "-", "ATCGT")]
    t, q = "ACGTTACGGA", "ACGTACGGGA"
    delta = spark.createDataFrame([("q.1", 10, 1, 10, "t.1", 10, 1, 10, 2, [5, -3])], "qname string, qlen long, qs long, qe long, tname string, tlen long, ts long, te long, errors long, offsets array<long>")
    seqs = [spark.createDataFrame([(n, s)], "contig string, seq string") for n, s in (("t.1", t), ("q.1", q))]
    got = convert.pair_blocks(delta, "mummer", "t", "q", targets=seqs[0], queries=seqs[1]).first()["rows"]
    assert [r["text"].replace("-", "") for r in got] == [t, q] and len(got[0]["text"]) == len(got[1]["text"]) == 11
    maf = spark.createDataFrame([(1.0, [row("1", 2, "-", 9, "ACG"), row("7", 0, "+", 9, "A-G")])], f"score double, rows array<{ROW}>")
    got = convert.pair_blocks(maf, "anchorwave", "t", "q").first()["rows"]
    assert [(r["src"], r["start"], r["strand"], r["text"]) for r in got] == [("t.1", 4, "+", "CGT"), ("q.7", 7, "-", "C-T")]
    with pytest.raises(ValueError):
        convert.pair_blocks(maf, "other", "t", "q")


def test_simulated_reads_and_names(spark):
    kind = "qname string, flag int, rname string, pos long, cigar string, seq string, qual string, tags map<string,string>"
    rows = [("simulated.1", 0x41, "c", 11, "5M", "ACGTA", "abcde", {"XE": "1"}), ("simulated.1", 0x91, "c", 31, "3M1D2M", "ACGTT", "fghij", {}), ("simulated.2", 0, "c", 1, "2M1I2M", "AAAAC", "kkkkl", {})]
    got = {r["name"]: (r["comment"], r["seq"], r["qual"]) for r in convert.simulated_fastq(spark.createDataFrame(rows, kind)).collect()}
    assert got == {"1!c!10_30!15_36!+-/1": ("1:0:0", "ACGTA", "abcde"), "1!c!10_30!15_36!+-/2": ("0:0:0", "AACGT", "jihgf"), "2!c!0!4!+": ("0:0:0", "AAAAC", "kkkkl")}
    df = spark.createDataFrame([("a", 1), ("b", 2)], "contig string, x int")
    names = spark.createDataFrame([("a", "chr1")], "name string, new string")
    assert sorted(tuple(r) for r in convert.renamed(df, names).collect()) == [("b", 2), ("chr1", 1)]


def test_annotation(spark):
    import random

    rnd = random.Random(3)
    ref = "".join(rnd.choice("ACGT") for _ in range(300))
    rc = ref[200:240][::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("c", 100, "A", "A", ref[60:100], "i=1"), ("c", 100, "B", "A", ref[100:140], "i=2"), ("c", 200, "C", "A", rc, "i=3"), ("c", 50, "D", "A", "".join(rnd.choice("ACGT") for _ in range(40)), "i=4"), ("x", 5, "E", "A", "ACGTACGTACGTAC", "i=5")]
    v = spark.createDataFrame(rows, "chrom string, pos long, id string, ref string, alt string, info string")
    refs = spark.createDataFrame([("c", ref)], "contig string, seq string")
    paf = "qname string, qlen long, qs long, qe long, tname string"
    te = spark.createDataFrame([("c_100_A", 200, 0, 50, "x#DNA/t"), ("c_100_A", 200, 40, 99, "x#LTR/t"), ("c_100_A", 200, 47, 102, "y#LTR/t"), ("c_100_A", 200, 150, 190, "z#DNA/q")], paf)
    genes = spark.createDataFrame([("c_100_B", 300, 0, 100, "g1")], paf)
    got = {r["id"]: r["info"] for r in annotate.annotate(v, refs, genes, te, "INS").collect()}
    assert got == {"A": "i=1;5DUP;NF;(DNA:45.0%;LTR:27.5%)", "B": "i=2;3DUP;(g1:33.3%);NF", "C": "i=3;3INVDUP;NF;NF", "D": "i=4;NONDUP;NF;NF", "E": "i=5;NONDUP;NF;NF"}
    found = spark.createDataFrame([("c", 101, 140, "c", 140, 150), ("c", 101, 140, "c", 70, 100), ("c", 1, 40, "c", 200, 210)], "contig string, beg long, fin long, query string, q_st long, q_en long")
    assert sorted((r["q_beg"], r["q_end"], r["side"]) for r in annotate.tandem_copies(found, refs, refs).collect()) == [(100, 140, "3"), (100, 140, "5")]
