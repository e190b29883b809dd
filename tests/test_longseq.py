"""Sequences by byte offsets and lav files, against plain readers and round trips."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from genoweave.operators import lineage, seqs
from genoweave.sources import lav, longseq
from genoweave.sources.readers import ROW

rnd = random.Random(51)


def text(n):
    return "".join(rnd.choice("ACGTNacgtn") for _ in range(n))


@pytest.fixture(scope="module")
def fasta(tmp_path_factory):
    """Contigs on one line and on many, with blank lines, carriage returns, long headers and none before the first."""
    folder = tmp_path_factory.mktemp("fa")
    contigs = {"one": text(20_000), "empty": "", "many": text(5_003), "crlf": text(700), "last": text(64)}
    lines = ["ACGT", ">one the first", contigs["one"], ">empty", ">many " + "x" * 900]
    lines += [contigs["many"][i : i + 61] for i in range(0, 5_003, 61)] + ["", ">crlf\r"]
    lines += [contigs["crlf"][i : i + 50] + "\r" for i in range(0, 700, 50)] + [">last", contigs["last"]]
    (folder / "a.fa").write_bytes("\n".join(lines).encode())
    (folder / "b.fa").write_bytes(f">other\n{contigs['crlf']}\n".encode())
    return folder, contigs | {"other": contigs["crlf"]}


@pytest.mark.parametrize("split,piece", [(1 << 20, 1 << 16), (997, 100), (64, 7), (4096, 1000)])
def test_chunks_of_long_sequences(spark, fasta, split, piece):
    folder, contigs = fasta
    with lineage.tidy():
        chunks = longseq.read_chunks(spark, [f"file://{folder}/a.fa", str(folder / "b.fa")], size=512, split=split, piece=piece)
        got = {}
        for r in sorted(chunks.collect(), key=lambda r: (r["contig"], r["chunk"])):
            assert r["chunk"] == len(got.setdefault(r["contig"], []))
            got[r["contig"]].append(r["part"])
        assert {k: "".join(v) for k, v in got.items()} == {k: v for k, v in contigs.items() if v}
        assert all(len(p) == 512 for v in got.values() for p in v[:-1])
        assert {r["contig"]: r["length"] for r in longseq.contig_sizes(chunks).collect()} == {k: len(v) for k, v in contigs.items() if v}
        if split == 997:
            asked = spark.createDataFrame([("one", 500, 1600), ("many", 5000, 6000), ("none", 0, 5)], "contig string, st long, en long")
            found = {r["contig"]: r["s"] for r in seqs.letters(asked, chunks, "s", "st", "en", size=512).collect()}
            assert found == {"one": contigs["one"][500:1600], "many": contigs["many"][5000:], "none": None}


def test_no_row_holds_a_contig(spark, fasta):
    folder, contigs = fasta
    rows = longseq.pieces(spark, f"file://{folder}/a.fa", split=997, piece=100)
    assert rows.rdd.getNumPartitions() > 20
    assert rows.agg(F.max(F.length("part"))).first()[0] <= 100
    assert rows.where("header IS NULL").select("path", "offset").distinct().count() == rows.where("header IS NULL").count()


def test_ranges_of_packed_files(spark, tmp_path):
    code = {c: i for i, c in enumerate("TCAGN")} | {c: i + 8 for i, c in enumerate("tcagn")}
    for name, n, order in (("odd", 5001, "<"), ("even", 4000, ">"), ("none", 0, "<")):
        whole = text(n)
        half = [code[c] for c in whole] + [0] * (n % 2)
        path = tmp_path / f"{name}.nib"
        path.write_bytes(struct.pack(f"{order}II", 0x6BE93D3A, n) + bytes(a << 4 | b for a, b in zip(half[::2], half[1::2], strict=True)))
        every = longseq.pieces(spark, str(path), kind="nib", split=300, piece=64).orderBy("offset").collect()
        assert "".join(r["part"] for r in every) == whole
        if not n:
            continue
        comp = str.maketrans("ACGTNacgtn", "TGCANtgcan")
        for a, b in ((1, 1), (2, 3), (7, 1999), (n - 3, n + 50), (1500, 1001)):
            parts = longseq.nib_range(spark, str(path), a, b, split=100, piece=64)
            got = "".join(r["part"] for r in parts.orderBy("no").collect())
            assert got == (whole[a - 1 : b] if a <= b else whole[b - 1 : a][::-1].translate(comp))
            # only the range's bytes are planned
            assert parts.rdd.getNumPartitions() <= (abs(a - b) + 2) // 200 + 2
        lines = [r["line"] for r in longseq.range_lines("x", 7, 1999, n, longseq.nib_range(spark, str(path), 7, 1999, piece=64)).orderBy("no").collect()]
        assert lines[0] == f">x:7-1999:+:{n}" and "".join(lines[1:]) == whole[6:1999] and {len(x) for x in lines[1:-1]} == {50}
    (tmp_path / "bad.nib").write_bytes(b"12345678")
    with pytest.raises(Exception, match="not a packed sequence"):
        longseq.pieces(spark, str(tmp_path / "bad.nib"), kind="nib").count()


def row(src, start, strand, size, t):
    return dict(src=src, start=start, size=len(t.replace("-", "")), strand=strand, src_size=size, text=t)


def pair(one, two, n):
    """A block of n letters of each, with gaps."""
    comp = str.maketrans("ACGT", "TGCA")
    (src1, s1), (src2, s2) = one, two
    back = rnd.random() < 0.5
    s2 = s2[::-1].translate(comp) if back else s2
    a, b = rnd.randrange(len(s1) - n), rnd.randrange(len(s2) - n)
    t, q, i, j = "", "", a, b
    for k in range(n):
        gap = rnd.random() if 0 < k < n - 1 else 1
        if gap < 0.05:
            t, q, i = t + s1[i], q + "-", i + 1
        elif gap < 0.1:
            t, q, j = t + "-", q + s2[j], j + 1
        else:
            t, q, i, j = t + s1[i], q + s2[j], i + 1, j + 1
    return [row(src1, a, "+", len(s1), t), row(src2, b, "-" if back else "+", len(s2), q)]


def ordered(t, q):
    """Gaps of the second row before those of the first between two runs, as the file's pieces tell no order."""
    out, one, two = [], "", ""
    for x, y in zip(t, q, strict=True):
        if y == "-":
            one += x
        elif x == "-":
            two += y
        else:
            out += [(c, "-") for c in one] + [("-", c) for c in two] + [(x, y)]
            one = two = ""
    return "".join(x for x, _ in out), "".join(y for _, y in out)


def test_lav_round_trip(spark, tmp_path):
    names = {f"{g}.c{i}": "".join(rnd.choice("ACGT") for _ in range(400)) for g in "ab" for i in range(2)}
    maf = [pair((x := f"a.c{rnd.randrange(2)}", names[x]), (y := f"b.c{rnd.randrange(2)}", names[y]), rnd.randrange(5, 90)) for _ in range(40)]
    df = spark.createDataFrame([(7.0, b) for b in maf], f"score double, rows array<{ROW}>").dropDuplicates(["rows"])
    lav.write_lav(df, str(tmp_path / "x.lav"))
    whole = "\n".join(p.read_text() for p in sorted((tmp_path / "x.lav").glob("part-*")))
    assert whole.startswith("#:lav\ns {\n  \"a.c") and "reverse complement" in whole and whole.count("#:lav") <= 8
    seq = spark.createDataFrame([(f">{n}", s) for n, s in names.items()], "head string, seq string")
    with lineage.tidy():
        found = lav.read_lav(spark, str(tmp_path / "x.lav"))
        assert {(r["dir1"], r["dir2"]) for r in found.collect()} == {(0, 0), (0, 1)} and {r["score"] for r in found.collect()} == {7.0}
        got = lav.lav_to_maf(found, seq, seq).collect()
    plain = lambda rows: tuple((r["src"], r["start"], r["size"], r["strand"], r["src_size"]) for r in rows)
    want = sorted((plain(b), ordered(b[0]["text"], b[1]["text"])) for b in {str(x): x for x in maf}.values())
    assert sorted((plain(r["rows"]), (r["rows"][0]["text"], r["rows"][1]["text"])) for r in got) == want


def test_headers_tell_places(spark, tmp_path):
    (tmp_path / "y.lav").write_text('#:lav\nd {\n  "blastz"\n}\n#:lav\ns {\n  "f1" 1 8 0 1\n  "f2-" 1 6 1 1\n}\nh {\n  ">g:c1:101:+:1000"\n  ">h:h:11:-:500 (reverse complement)"\n}\na {\n  s 99\n  b 2 1\n  e 7 5\n  l 2 1 3 2 100\n  l 6 4 7 5 50\n}\nx {\n  n 0\n}\n')
    one = spark.createDataFrame([(">g:c1:101:+:1000", "ACGTACGT")], "head string, seq string")
    two = spark.createDataFrame([(">h:h:11:-:500", "AACCGG")], "head string, seq string")
    with lineage.tidy():
        got = lav.lav_to_maf(lav.read_lav(spark, str(tmp_path / "y.lav")), one, two).first()["rows"]
    # the second, itself on the minus strand, is turned: CCGGTT, from 484 on the plus strand
    assert [(r["src"], r["start"], r["size"], r["strand"], r["src_size"], r["text"]) for r in got] == [("g.c1", 101, 6, "+", 1000, "CGTA-CG"), ("h", 484, 5, "+", 500, "CC--GGT")]
