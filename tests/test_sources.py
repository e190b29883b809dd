"""Readers on small files."""

from pyspark.sql import functions as F

from genoweave.sources import readers


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_fasta(spark, tmp_path):
    got = readers.read_fasta(spark, write(tmp_path, "a.fa", ">c1 first\nACGT\nacgt\n>c2\nNNN\n")).collect()
    assert {(r["contig"], r["length"], r["seq"]) for r in got} == {("c1", 8, "ACGTacgt"), ("c2", 3, "NNN")}


def test_maf(spark, tmp_path):
    text = "##maf version=1\na score=12.5\ns R.c1 0 4 + 100 ACGT\ns Q.c1 5 3 - 50 AC-T\n\na score=1\ns R.c1 9 2 + 100 AC\ns Q.c1 1 9 + 50 AC\n"
    got = readers.read_maf(spark, write(tmp_path, "a.maf", text))
    assert sorted((r["score"], len(r["rows"]), r["error"]) for r in got.collect()) == [(1.0, 2, "size"), (12.5, 2, None)]
    pair = readers.pair_blocks(got.where("error is null")).first()
    assert (pair["contig"], pair["sample"], pair["q_strand"], pair["q_text"]) == ("R.c1", "Q", "-", "AC-T")


def test_net(spark, tmp_path):
    text = "net R.c1 1000\n fill 0 900 Q.c1 + 0 800 id 1 score 5 ali 700 type top\n  gap 100 50 Q.c1 + 90 10\n   fill 110 20 Q.c2 - 5 20 id 2 score 1 ali 15 qFar 7 type inv\nnet R.c2 500\n fill 3 9 Q.c9 + 1 8 id 4 ali 6 type top\n"
    got = {(r["net"], r["depth"]): r for r in readers.read_net(spark, write(tmp_path, "a.net", text)).collect()}
    assert got["R.c1", 3]["tags"]["qFar"] == "7" and got["R.c1", 3]["parent"] == got["R.c1", 2]["node"]
    assert got["R.c1", 2]["parent"] == got["R.c1", 1]["node"] and got["R.c2", 1]["parent"] is None


def test_lines(spark, tmp_path):
    paf = readers.read_paf(spark, write(tmp_path, "a.paf", "q\t10\t0\t10\t+\tt\t20\t5\t15\t9\t10\t60\ttp:A:P\tcg:Z:10M\n")).first()
    assert (paf["qlen"], paf["te"], paf["tags"]["cg"]) == (10, 15, "10M")
    records, head = readers.read_sam(spark, write(tmp_path, "a.sam", "@SQ\tSN:t\tLN:20\nr\t16\tt\t6\t60\t10M\t*\t0\t0\tACGT\t*\tNM:i:1\n"))
    assert (records.first()["flag"], records.first()["tags"]["NM"], head.first()["length"]) == (16, "1", 20)
    bed = readers.read_bed12(spark, write(tmp_path, "a.bed", "c\t100\t200\tx\t0\t+\t100\t200\t0\t2\t10,20,\t0,80,\nd\t1\t5\n")).collect()
    assert sorted((r["contig"], r["st"], r["en"]) for r in bed) == [("c", 100, 110), ("c", 180, 200), ("d", 1, 5)]
    gtf = readers.read_gtf(spark, write(tmp_path, "a.gtf", 'c\ts\texon\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t1";\n')).first()
    assert (gtf["start"], gtf["transcript"]) == (1, "t1")
    vcf = readers.read_vcf(spark, write(tmp_path, "a.vcf", "##x\n#CHROM\nc\t5\t.\tA\tC\t50\tPASS\tNS=2;AF=0.5\tGT\t0|0\t1|1\n"))
    row = vcf.select("genotypes", readers.info(F.col("info"), "AF").alias("af")).first()
    assert (row["genotypes"], row["af"]) == (["0|0", "1|1"], "0.5")
    delta = readers.read_delta(spark, write(tmp_path, "a.delta", "/r /q\nNUCMER\n>t q 100 90\n1 10 2 11 1 1 0\n5\n-3\n0\n20 30 20 30 0 0 0\n0\n")).collect()
    assert sorted((r["ts"], list(r["offsets"])) for r in delta) == [(1, [5, -3]), (20, [])]
