"""Conversions and writers, on small inputs worked by hand and round trips."""

import pytest
from pyspark.sql import functions as F

from genoweave.sources import convert, readers, writers


def test_delta_to_paf(spark):
    rows = [("t", "q", 100, 90, 1, 20, 1, 19, 2, [5, 1, -4, -1]), ("t", "q", 100, 90, 11, 20, 30, 21, 1, [])]
    delta = spark.createDataFrame(rows, "tname string, qname string, tlen long, qlen long, ts long, te long, qs long, qe long, errors long, offsets array<long>")
    got = {r["ts"]: r for r in convert.delta_to_paf(delta).collect()}
    # 4 aligned, 2 deleted, 3 aligned, 2 inserted, then 20 - 4 - 2 - 3 = 11 aligned
    assert got[0]["cg"] == "4M2D3M2I11M" and got[0]["blen"] == 22 and got[0]["nmatch"] == 20
    assert (got[10]["cg"], got[10]["strand"], got[10]["qs"], got[10]["qe"]) == ("10M", "-", 20, 30)


@pytest.mark.parametrize(
    ("cg", "md", "seq", "want"),
    [("8M", "8", "ACGTACGT", ":8"), ("8M", "3A4", "ACGTACGT", ":3*AT:4"), ("2S3M1I2M2D3M", "5^GG1C1", "TTACGTACAAT", ":3+T:2-GG:1*CA:1"), ("4M", "3", "ACGT", None), ("4=1X", "4A0", "ACGTC", ":4*AC")],
)
def test_md_to_cs(cg, md, seq, want):
    assert convert.md_to_cs(cg, md, seq) == want


def test_sam_to_paf(spark, tmp_path):
    path = tmp_path / "a.sam"
    path.write_text("@SQ\tSN:c\tLN:100\n" + "\n".join([
        "r1\t16\tc\t11\t60\t2S3M1I2M2D3M\t*\t0\t0\tTTACGTACAAT\t*\tNM:i:4\tMD:Z:5^GG1C1",
        "r2\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\t*", "r3\t0\tc\t99\t60\t4M\t*\t0\t0\tACGT\t*\tNM:i:0", "r4\t65\tc\t1\t9\t4=1X\t*\t0\t0\t*\t*",
    ]) + "\n")
    got = {r["qname"]: r for r in convert.sam_to_paf(*readers.read_sam(spark, str(path))).collect()}
    assert sorted(got) == ["r1", "r4/1"]
    r = got["r1"]
    assert [r[c] for c in convert.PAF] == ["r1", 11, 0, 9, "-", "c", 100, 10, 20, 7, 11, 60]
    assert (r["mm"], r["gn"], r["go"], r["cg"], r["cs"]) == (1, 3, 2, "3M1I2M2D3M", ":3+T:2-GG:1*CA:1")
    assert (got["r4/1"]["nmatch"], got["r4/1"]["mm"]) == (4, 1)


def test_paf_views(spark):
    paf = spark.createDataFrame([("q", 20, 3, 10, "-", "t", 50, 5, 13, 6, 9, 60, "=AC*gt-ag=TT+c=G", "4M2D2M1I1M")], "qname string, qlen long, qs long, qe long, strand string, tname string, tlen long, ts long, te long, nmatch long, blen long, mapq int, cs string, cg string")
    rows = convert.paf_to_maf(paf).first()["rows"]
    assert [(r["text"], r["start"], r["size"], r["strand"]) for r in rows] == [("ACGAGTT-G", 5, 8, "+"), ("ACT--TTCG", 10, 7, "-")]
    assert paf.select(convert.paf_to_cigar_line(F.lit(6)).alias("x")).first()["x"] == "cigar: q 10 3 - t 5 13 + 6 M 4 D 2 M 2 I 1 M 1"
    assert convert.paf_to_maf(paf.withColumn("cs", F.lit(":5"))).count() == 0


def test_annotation(spark, tmp_path):
    path = tmp_path / "a.gtf"
    line = 'c\tx\t{}\t{}\t{}\t.\t+\t.\ttranscript_id "T1"; gene_name "G"; transcript_type "mRNA"; gene_id "g1";'
    path.write_text("\n".join([line.format("exon", 101, 150), line.format("exon", 11, 50), line.format("CDS", 31, 50), line.format("CDS", 101, 120), line.format("gene", 11, 150)]) + "\n")
    gtf = readers.read_gtf(spark, str(path))
    t = convert.transcripts(gtf).first()
    assert (t["st"], t["en"], t["thick_st"], t["thick_en"], t["sizes"], t["starts"], t["name"], t["colour"]) == (10, 150, 30, 120, "40,50,", "0,90,", "T1|mRNA|G", "0,128,255")
    assert [tuple(r) for r in convert.junctions(gtf).select("st", "en").collect()] == [(50, 100)]
    assert convert.genes(gtf).first()["name"] == "g1||G"
    rows = spark.createDataFrame([("r", "c", 5, "+", True, "2S10M3I5D7N4M"), ("r", "c", 50, "+", True, "9M"), ("s", "c", 9, "-", False, "4M")], "name string, contig string, st long, strand string, primary boolean, cigar string")
    got = {(r["name"], r["st"]): r for r in convert.spliced(rows, keep_multi=True).collect()}
    assert (got["r", 5]["sizes"], got["r", 5]["starts"], got["r", 5]["en"], got["r", 5]["class"]) == ("15,4", "0,22", 31, 1)
    assert got["s", 9]["class"] == 2 and convert.spliced(rows).count() == 2


def test_maf_round_trip_and_lift(spark, tmp_path):
    row = lambda *v: dict(zip(("src", "start", "size", "strand", "src_size", "text"), v, strict=True))
    blocks = [(12.0, [row("a.c", 5, 4, "+", 100, "AC-GT"), row("b.longer", 1000, 5, "-", 2000, "ACGGT")]), (7.0, [row("a.c", 1, 1, "+", 100, "A"), row("b.d", 3, 1, "+", 20, "C")])]
    df = spark.createDataFrame(blocks, f"score double, rows array<{readers.ROW}>")
    writers.write_maf(df, str(tmp_path / "maf"))
    back = readers.read_maf(spark, str(tmp_path / "maf"))
    assert {(r["score"], str(r["rows"]), r["error"]) for r in back.collect()} == {(r["score"], str(r["rows"]), None) for r in df.collect()}
    lifted = spark.createDataFrame([(1.0, [row("g.c.101.200", 10, 4, "+", 100, "ACGT"), row("g.c.101.200", 10, 4, "-", 100, "ACGT")])], f"score double, rows array<{readers.ROW}>")
    got = lifted.select(convert.lift_contigs(F.col("rows"), F.create_map(F.lit("g.c"), F.lit(500).cast("long"))).alias("r")).first()["r"]
    assert [(r["src"], r["start"], r["src_size"]) for r in got] == [("g.c", 110, 500), ("g.c", 310, 500)]
    named = convert.name_genomes(df, "R", "Q").first()["rows"]
    assert named[0]["src"].startswith("R.a") and named[1]["src"].startswith("Q.b")


def test_vcf_and_fasta(spark, tmp_path):
    sizes = spark.createDataFrame([("c1", 50)], "name string, length long")
    calls = spark.createDataFrame([("c1", 9, 12, 3, "DEL", "ACG", "A", "1|1", None)], "contig string, beg long, fin long, len long, kind string, ref string, alt string, S0 string, S1 string")
    writers.write_vcf(writers.sv_vcf(calls, sizes, ["S0", "S1"]), str(tmp_path / "sv"))
    lines = [r["value"] for p in sorted((tmp_path / "sv").glob("part-*")) for r in spark.read.text(str(p)).collect()]
    assert lines[0] == "##fileformat=VCFv4.2" and lines[-3] == "##contig=<ID=c1,length=50>" and lines[-2].startswith("#CHROM")
    assert lines[-1] == "c1\t9\tSV9\tACG\tA\t22\tPASS\tSVTYPE=DEL;END=12;SVLEN=3\tGT:GQ\t1|1:22\t.|.:22"
    matrix = spark.createDataFrame([("c1", 4, "A", "C,T", "A", "T", "-")], "contig string, pos long, ref string, alt string, S0 string, S1 string, S2 string")
    snp = writers.snp_vcf(matrix, sizes, ["S0", "S1", "S2"]).where("part = 3").first()["line"]
    assert snp == "c1\t4\t.\tA\tC,T\t50\tPASS\tNS=2;DP=10;AF=0,0.5\tGT:GQ:DP:HQ\t0|0:48:10:51,51\t2|2:48:10:51,51\t.|.:48:10:51,51"
    seqs = spark.createDataFrame([("x", "ACGT" * 40), ("y", "")], "contig string, seq string")
    writers.write_fasta(seqs, str(tmp_path / "fa"))
    assert {(r["contig"], r["seq"]) for r in readers.read_fasta(spark, str(tmp_path / "fa")).collect()} == {("x", "ACGT" * 40), ("y", "")}


def test_simulated(spark):
    row = lambda *v: dict(zip(("src", "start", "size", "strand", "src_size", "text"), v, strict=True))
    maf = spark.createDataFrame([(0.0, [row("ref", 7, 4, "+", 50, "ACGT"), row("S2_1", 0, 3, "-", 3, "AC-T")]), (0.0, [row("ref", 7, 4, "+", 50, "ACGT"), row("S2_2", 0, 4, "+", 4, "ANNT")])], f"score double, rows array<{readers.ROW}>")
    contigs = spark.createDataFrame([(1, "x"), (2, "y")], "no int, name string")
    assert [tuple(r) for r in convert.simulated_fasta(maf, contigs).collect()] == [("S2_1!y!7!11!-", "AGT")]
