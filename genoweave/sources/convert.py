"""Conversions between alignment and annotation formats, as DataFrames in and out. PAF frames have the reader's columns and cg or cs."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions import cigar
from genoweave.functions.seq import revcomp
from genoweave.operators.seqs import chunked, letters

PAF = ["qname", "qlen", "qs", "qe", "strand", "tname", "tlen", "ts", "te", "nmatch", "blen", "mapq"]


def delta_to_paf(delta: DataFrame) -> DataFrame:
    """PAF rows with nm and cg of read_delta's rows. A run of gaps begins where an offset is not one letter after the last or goes the
    other way; what stands before it is aligned. A last run of no letters is left out."""
    off, n = F.col("offsets"), F.size("offsets")
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    first = F.filter(every, lambda i: (i == 0) | (F.abs(F.get(off, i)) > 1) | (F.signum(F.get(off, i)) != F.signum(F.get(off, i - 1))))
    piece = F.transform("__first", lambda i, k: F.concat(
        F.when(F.abs(F.get(off, i)) > 1, F.concat((F.abs(F.get(off, i)) - 1).cast("string"), F.lit("M"))).otherwise(""),
        (F.coalesce(F.get("__first", k + 1), n) - i).cast("string"), F.when(F.get(off, i) > 0, "D").otherwise("I")))
    matched = F.aggregate(off, F.lit(0).cast("long"), lambda a, d: a + F.abs(d) - 1)
    deleted, inserted = F.size(F.filter(off, lambda d: d > 0)), F.size(F.filter(off, lambda d: d < 0))
    lo = lambda a, b: F.least(a, b) - 1
    rs, re_, qs, qe = lo("ts", "te"), F.greatest("ts", "te"), lo("qs", "qe"), F.greatest("qs", "qe")
    last = re_ - rs - matched - deleted
    blen = matched + deleted + inserted + last
    cg = F.concat(F.array_join(piece, ""), F.when(last > 0, F.concat(last.cast("string"), F.lit("M"))).otherwise(""))
    strand = F.when((F.col("ts") < F.col("te")) == (F.col("qs") < F.col("qe")), "+").otherwise("-")
    return delta.withColumn("__first", first).select(
        "qname", "qlen", qs.alias("qs"), qe.alias("qe"), strand.alias("strand"), "tname", "tlen", rs.alias("ts"), re_.alias("te"), (blen - F.col("errors")).alias("nmatch"), blen.alias("blen"), F.lit(0).alias("mapq"),
        F.col("errors").alias("nm"), cg.alias("cg"),
    )


def md_to_cs(ops: str, md: str, seq: str) -> str | None:
    """The cs string of an alignment from its CIGAR, MD and letters; None if they do not agree.

    MD is read as one mark for each aligned column ('=' or the reference's letter) and a list of deleted letters; the CIGAR's
    operations then take their share of the marks."""
    marks, gone = [], []
    for run, dele, base in re.findall(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])", md):
        if dele:
            gone.append(dele)
        else:
            marks.append("=" * int(run) if run else base)
    line, at, pos, out = "".join(marks), 0, 0, []
    merged: list[list] = []
    for size, op in re.findall(r"(\d+)([MIDNSHP=X])", ops):
        kind = "M" if op in "=X" else op
        if kind in "HP":
            continue
        if merged and merged[-1][1] == kind:
            merged[-1][0] += int(size)
        else:
            merged.append([int(size), kind])
    for size, kind in merged:
        if kind == "M":
            share = line[at : at + size]
            if len(share) < size:
                return None
            for piece in re.findall(r"=+|[A-Za-z]", share):
                out.append(f":{len(piece)}" if piece[0] == "=" else f"*{piece}{seq[pos : pos + 1]}")
                pos += len(piece)
            at += size
        elif kind == "D":
            if not gone or len(gone[0]) != size:
                return None
            out.append("-" + gone.pop(0))
        elif kind == "I":
            out.append("+" + seq[pos : pos + size])
            pos += size
        elif kind == "S":
            pos += size
        else:
            return None
    return "".join(out) if at == len(line) and not gone and pos == len(seq) else None


def _with_cs(rows: DataFrame) -> DataFrame:
    """rows (cigar, md, seq, cs) with cs from the MD string where there is none; only this walks letters in Python, by batches."""
    schema = rows.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            told = zip(*[batch.column(at[c]).to_pylist() for c in ("cigar", "md", "seq", "cs")], strict=True)
            new = pa.array([cs if cs is not None or md is None or not seq or seq == "*" else md_to_cs(cg, md, seq) for cg, md, seq, cs in told], pa.string())
            yield pa.RecordBatch.from_arrays([new if n == "cs" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)

    return rows.mapInArrow(run, schema)


def sam_to_paf(records: DataFrame, lengths: DataFrame, primary_only: bool = False) -> DataFrame:
    """PAF rows with mm, gn, go, cg, cs and type of SAM records. Unmapped ones, ones beyond their reference's end and ones whose letters
    and CIGAR differ in length are left out. Mismatches are NM less the gaps (never below 0), or the X of an extended CIGAR."""
    t = F.col("tags")
    rows = records.where("(flag & 4) = 0 AND rname <> '*' AND cigar <> '*'")
    if primary_only:
        rows = rows.where("(flag & 256) = 0")
    rows = rows.join(lengths.select(F.col("name").alias("rname"), F.col("length").alias("ref_size")), "rname")
    total, ops = (lambda kinds: cigar.total(F.col("cigar"), kinds)), cigar.ops(F.col("cigar"))
    count = lambda kinds: F.size(F.filter(ops, lambda x: x["op"].isin(*kinds))).cast("long")
    end = lambda x: F.when(x["op"].isin("S", "H"), x["len"]).otherwise(0)
    rows = rows.withColumns({
        "m": total("M=X"), "x": total("X"), "gaps": total("ID"), "opens": count("ID"), "ref_len": total("MDN=X"), "held": total("MIS=X"), "ins": total("I"),
        "clip5": end(F.get(ops, F.lit(0))), "clip3": F.when(F.size(ops) > 1, end(F.element_at(ops, -1))).otherwise(0), "extended": (count("=X") > 0) & (count("M") == 0),
    })
    start = F.col("pos") - 1
    rows = rows.where((start + F.col("ref_len") <= F.col("ref_size")) & ((F.col("seq") == "*") | (F.length("seq") == F.col("held"))))
    nm = t["NM"].try_cast("long")
    mm = F.when(F.col("extended"), F.col("x")).when(nm.isNotNull(), F.greatest(F.lit(0), nm - F.col("gaps"))).otherwise(0)
    rows = _with_cs(rows.select(
        F.concat("qname", F.when((F.col("flag").bitwiseAND(1) > 0) & (F.col("flag").bitwiseAND(64) > 0), "/1").when((F.col("flag").bitwiseAND(1) > 0) & (F.col("flag").bitwiseAND(128) > 0), "/2").otherwise("")).alias("qname"),
        (F.col("m") + F.col("ins") + F.col("clip5") + F.col("clip3")).alias("qlen"), (F.col("flag").bitwiseAND(16) > 0).alias("rev"), "clip5", "clip3", F.col("rname").alias("tname"), F.col("ref_size").alias("tlen"), start.alias("ts"), (start + F.col("ref_len")).alias("te"),
        (F.col("m") - mm).alias("nmatch"), (F.col("m") + F.col("gaps")).alias("blen"), "mapq", F.when(F.col("extended") | nm.isNotNull(), mm).alias("mm"), F.col("gaps").alias("gn"), F.col("opens").alias("go"),
        "cigar", t["MD"].alias("md"), "seq", t["cs"].alias("cs"), F.when(F.col("flag").bitwiseAND(256) > 0, "S").otherwise("P").alias("type"),
    ))
    before, after = F.when(F.col("rev"), F.col("clip3")).otherwise(F.col("clip5")), F.when(F.col("rev"), F.col("clip5")).otherwise(F.col("clip3"))
    return rows.select("qname", "qlen", before.alias("qs"), (F.col("qlen") - after).alias("qe"), F.when(F.col("rev"), "-").otherwise("+").alias("strand"), "tname", "tlen", "ts", "te", "nmatch", "blen", "mapq",
                       "type", "mm", "gn", "go", F.regexp_replace("cigar", r"\d+[SH]", "").alias("cg"), "cs")


def cs_texts(cs: Column) -> Column:
    """struct<t, q> of gapped rows of a long cs string (bases of matches are written out); NULL if it is short or has introns."""
    ops = cigar.cs_ops(cs)
    one = lambda x, own: F.when(x["op"] == "=", x["arg"]).when(x["op"] == "*", F.substring(x["arg"], own + 1, 1)).when(x["op"] == ("-" if own == 0 else "+"), x["arg"]).otherwise(F.repeat(F.lit("-"), F.length(x["arg"])))
    text = lambda own: F.upper(F.array_join(F.transform(ops, lambda x: one(x, own)), ""))
    return F.when(~F.exists(ops, lambda x: x["op"].isin(":", "~")), F.struct(text(0).alias("t"), text(1).alias("q")))


def paf_to_maf(paf: DataFrame) -> DataFrame:
    """(score, rows) of PAF rows with a long cs; a minus row is told on its own strand. The score is the number of matches."""
    own = F.when(F.col("strand") == "-", F.col("qlen") - F.col("qe")).otherwise(F.col("qs"))
    row = lambda src, start, size, strand, whole, text: F.struct(src.alias("src"), start.cast("long").alias("start"), size.cast("long").alias("size"), strand.alias("strand"), whole.cast("long").alias("src_size"), text.alias("text"))
    t = row(F.col("tname"), F.col("ts"), F.col("te") - F.col("ts"), F.lit("+"), F.col("tlen"), F.col("x.t"))
    q = row(F.col("qname"), own, F.col("qe") - F.col("qs"), F.col("strand"), F.col("qlen"), F.col("x.q"))
    return paf.withColumn("x", cs_texts(F.col("cs"))).where("x IS NOT NULL").select(F.col("nmatch").cast("double").alias("score"), F.array(t, q).alias("rows"))


def paf_to_cigar_line(score: Column) -> Column:
    """A line 'cigar: query target score operations' of a PAF row with cg; a minus query is told backwards."""
    minus = F.col("strand") == "-"
    ops = F.array_join(F.transform(cigar.ops(F.col("cg")), lambda x: F.concat_ws(" ", x["op"], x["len"].cast("string"))), " ")
    text = lambda c: c.cast("string")
    return F.concat_ws(" ", F.lit("cigar:"), "qname", text(F.when(minus, F.col("qe")).otherwise(F.col("qs"))), text(F.when(minus, F.col("qs")).otherwise(F.col("qe"))), "strand", "tname", text(F.col("ts")), text(F.col("te")), F.lit("+"), text(score), ops)


def lift_contigs(rows: Column, sizes: Column) -> Column:
    """Rows named genome.contig.offset.end (1-based chunks of chromosomes) as rows of their chromosomes; sizes is a map."""
    def lifted(r: Column) -> Column:
        p = F.split(r["src"], r"\.")
        name = F.concat_ws(".", F.get(p, F.lit(0)), F.get(p, F.lit(1)))
        whole = F.try_element_at(sizes, name)
        start = F.when(r["strand"] == "+", F.get(p, F.lit(2)).try_cast("long") + r["start"] - 1).otherwise(whole - F.get(p, F.lit(3)).try_cast("long") + r["start"])
        return F.struct(name.alias("src"), start.alias("start"), r["size"].alias("size"), r["strand"].alias("strand"), whole.alias("src_size"), r["text"].alias("text"))

    return F.transform(rows, lifted)


def name_genomes(maf: DataFrame, target: str, query: str) -> DataFrame:
    """Two-row blocks with the genomes' names before the contigs'; blocks with a row of no letters are dropped."""
    named = lambda r, g: F.struct(F.concat(F.lit(g + "."), r["src"]).alias("src"), *[r[c].alias(c) for c in ("start", "size", "strand", "src_size", "text")])
    t, q = F.col("rows")[0], F.col("rows")[1]
    return maf.where((t["size"] > 0) & (q["size"] > 0)).withColumn("rows", F.array(named(t, target), named(q, query)))


# Colours of transcript types.
COLOURS = {"protein_coding": "0,128,255", "mRNA": "0,128,255", "lincRNA": "0,192,0", "snRNA": "0,192,0", "miRNA": "0,192,0", "misc_RNA": "0,192,0"}
OTHER_COLOUR = "196,196,196"


def attribute(attributes: Column, *names: str) -> Column:
    """The value of the first of the attributes named that GTF ('name "value";') or GFF3 ('name=value') has."""
    found = [F.nullif(F.regexp_extract(attributes, rf'(?:^|[;\s]){n}(?: "([^"]+)"|=([^;]+))', 1), F.lit("")) for n in names]
    plain = [F.nullif(F.regexp_extract(attributes, rf"(?:^|[;\s]){n}=([^;]+)", 1), F.lit("")) for n in names]
    return F.coalesce(*[c for pair in zip(found, plain, strict=True) for c in pair])


def _exons(gtf: DataFrame) -> DataFrame:
    """Exon and CDS rows of transcripts with their names, half-open."""
    a = F.col("attributes")
    rows = gtf.where("feature IN ('exon', 'CDS')").select(
        F.col("seqname").alias("contig"), "feature", (F.col("start") - 1).alias("st"), F.col("end").alias("en"), "strand", attribute(a, "transcript_id").alias("tid"),
        F.coalesce(attribute(a, "transcript_type", "transcript_biotype", "gbkey"), F.lit("")).alias("type"), F.coalesce(attribute(a, "gene_name", "gene_id"), F.lit("N/A")).alias("gene"), F.coalesce(attribute(a, "transcript_name"), F.lit("N/A")).alias("tname"),
    )
    return rows.where("tid IS NOT NULL")


def transcripts(gtf: DataFrame, short_names: bool = False) -> DataFrame:
    """A BED12 row for each transcript: exons by start, the CDS as the thick part (the whole, if it has none). Rows of a transcript
    need not stand together; those without a transcript's id are left out."""
    exon = F.col("feature") == "exon"
    t = _exons(gtf).groupBy("tid").agg(
        F.array_sort(F.collect_list(F.when(exon, F.struct("st", "en")))).alias("x"), F.min(F.when(exon, F.struct("contig", "strand", "type", "gene", "tname"))).alias("i"),
        F.min(F.when(~exon, F.col("st"))).alias("c0"), F.max(F.when(~exon, F.col("en"))).alias("c1"),
    ).where("size(x) > 0")
    st, en = F.col("x")[0]["st"], F.array_max(F.transform("x", lambda e: e["en"]))
    name = F.concat_ws("|", "i.tname", "i.type") if short_names else F.concat_ws("|", "tid", "i.type", "i.gene")
    colour = F.coalesce(*[F.when(F.col("i.type") == k, v) for k, v in COLOURS.items()], F.lit(OTHER_COLOUR))
    listed = lambda f: F.concat(F.array_join(F.transform("x", lambda e: f(e).cast("string")), ","), F.lit(","))
    return t.select(
        F.col("i.contig").alias("contig"), st.alias("st"), en.alias("en"), name.alias("name"), F.lit(1000).alias("score"), F.col("i.strand").alias("strand"), F.coalesce("c0", st).alias("thick_st"), F.coalesce("c1", en).alias("thick_en"),
        colour.alias("colour"), F.size("x").alias("blocks"), listed(lambda e: e["en"] - e["st"]).alias("sizes"), listed(lambda e: e["st"] - st).alias("starts"),
    )


def junctions(gtf: DataFrame) -> DataFrame:
    """(contig, st, en, name, strand): the introns between neighbouring exons of each transcript."""
    order = Window.partitionBy("tid").orderBy("st", "en")
    rows = _exons(gtf).where("feature = 'exon'").withColumn("before", F.lag("en").over(order)).where("before IS NOT NULL")
    return rows.select("contig", F.col("before").alias("st"), F.col("st").alias("en"), F.concat_ws("|", "tid", "type", "gene").alias("name"), "strand")


def genes(gtf: DataFrame) -> DataFrame:
    """(contig, st, en, name, strand) of gene rows; a source gene's id stands for the own one."""
    a = F.col("attributes")
    name = F.concat_ws("|", attribute(a, "source_gene", "gene_id"), F.coalesce(attribute(a, "gene_type", "gene_biotype"), F.lit("")), F.coalesce(attribute(a, "gene_name"), F.lit("N/A")))
    return gtf.where("feature = 'gene'").select(F.col("seqname").alias("contig"), (F.col("start") - 1).alias("st"), F.col("end").alias("en"), name.alias("name"), "strand")


def spliced(rows: DataFrame, keep_multi: bool = False) -> DataFrame:
    """BED12 rows of spliced alignments (name, contig, st, strand, primary, cigar): blocks between introns. class 0 is primary, 1 one of
    several primaries of a name, 2 secondary; secondary ones are dropped unless keep_multi."""
    ops = F.filter(cigar.ops(F.col("cigar")), lambda x: x["op"].isin("M", "D", "N"))
    text = F.array_join(F.transform(ops, lambda x: F.concat(F.when(x["op"] == "N", F.concat(F.lit("|"), x["len"].cast("string"), F.lit("|"))).otherwise(F.concat(x["len"].cast("string"), F.lit("+"))))), "")
    # parts alternate: a block's lengths joined by +, then an intron's length
    size = lambda s: F.aggregate(F.filter(F.split(s, r"\+"), lambda v: v != ""), F.lit(0).cast("long"), lambda a, v: a + v.cast("long"))
    wide = rows.withColumn("p", F.transform(F.split(text, r"\|"), size))
    even = lambda k: F.transform(F.sequence(F.lit(0), F.floor((F.size("p") - 1) / 2).cast("int")), k)
    wide = wide.withColumn("sizes", even(lambda j: F.get("p", 2 * j))).withColumn("starts", even(lambda j: F.aggregate(F.slice("p", F.lit(1), 2 * j), F.lit(0).cast("long"), lambda a, v: a + v)))
    many = F.sum(F.when(F.col("primary"), 1).otherwise(0)).over(Window.partitionBy("name"))
    kind = F.when(~F.col("primary"), 2).when(many > 1, 1).otherwise(0)
    out = wide.select("contig", "st", (F.col("st") + F.aggregate("p", F.lit(0).cast("long"), lambda a, v: a + v)).alias("en"), "name", "strand", kind.alias("class"), F.size("sizes").alias("blocks"), F.array_join("sizes", ",").alias("sizes"), F.array_join("starts", ",").alias("starts"))
    return out if keep_multi else out.where("class <> 2")


def simulated_fasta(maf: DataFrame, contigs: DataFrame) -> DataFrame:
    """(name, seq) of simulated reads: the second rows of blocks, named read!contig!start!end!strand by contigs (no from 1, name); reads
    with two unknown letters together are dropped, minus reads are turned."""
    t, q = F.col("rows")[0], F.col("rows")[1]
    reads = maf.where(F.size("rows") >= 2).select(q["src"].alias("read"), t["start"].alias("st"), (t["start"] + t["size"]).alias("en"), q["strand"].alias("strand"), F.replace(q["text"], F.lit("-"), F.lit("")).alias("seq"), F.regexp_extract(q["src"], r"S(\d+)_\d+", 1).try_cast("int").alias("no"))
    found = reads.where("NOT contains(seq, 'NN')").join(contigs.select("no", F.col("name").alias("contig")), "no")
    return found.select(F.concat_ws("!", "read", "contig", F.col("st").cast("string"), F.col("en").cast("string"), "strand").alias("name"), F.when(F.col("strand") == "-", revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def renamed(df: DataFrame, names: DataFrame, column: str = "contig") -> DataFrame:
    """df with contigs renamed by a second list (name, new); those not listed keep their names."""
    return df.join(names.select(F.col("name").alias(column), F.col("new").alias("__new")), column, "left").withColumn(column, F.coalesce("__new", column)).select(df.columns)


def simulated_fastq(records: DataFrame) -> DataFrame:
    """(name, comment, seq, qual) of simulated SAM records, turned to the read's own strand: the mates of a pair tell both places in their names, reads alone
    their own; the comment is errors, substitutions and indels."""
    back = F.col("flag").bitwiseAND(16) > 0
    mate = F.when(F.col("flag").bitwiseAND(0xC0) == 0x40, 1).when(F.col("flag").bitwiseAND(0xC0) == 0x80, 2).otherwise(0)
    tag = lambda t: F.coalesce(F.col("tags")[t], F.lit("0"))
    rows = records.select(
        F.regexp_replace("qname", "^simulated.", "").alias("read"), F.col("rname").alias("contig"), (F.col("pos") - 1).alias("st"), (F.col("pos") - 1 + cigar.total(F.col("cigar"), "MDN")).alias("en"), F.when(back, "-").otherwise("+").alias("strand"),
        F.when(back, revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"), mate.alias("mate"), F.concat_ws(":", tag("XE"), tag("XS"), tag("XI")).alias("comment"),
    )
    one = rows.groupBy("read").agg(F.min(F.when(F.col("mate") == 1, F.struct("contig", "st", "en", "strand"))).alias("a"), F.min(F.when(F.col("mate") == 2, F.struct("contig", "st", "en", "strand"))).alias("b"))
    text = lambda *c: F.concat_ws("_", *[F.col(x).cast("string") for x in c])
    paired = F.concat(F.concat_ws("!", "read", "contig", text("a.st", "b.st"), text("a.en", "b.en"), F.concat("a.strand", "b.strand")), F.lit("/"), F.col("mate").cast("string"))
    alone = F.concat_ws("!", "read", "contig", F.col("st").cast("string"), F.col("en").cast("string"), "strand")
    named = rows.join(one, "read").withColumn("name", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), paired).otherwise(alone))
    return named.select("name", "comment", "seq", "qual")


def fastq_record(name: Column, comment: Column, seq: Column, qual: Column) -> Column:
    return F.concat(F.lit("@"), name, F.lit(" "), comment, F.lit("\n"), seq, F.lit("\n+\n"), qual)


def alignment_text(paf: DataFrame, width: int = 80) -> DataFrame:
    """(id, text) of PAF rows (id, with cs): both rows and a line of bars between them, in lines of `width` columns with the places of their ends. Letters that a short
    cs leaves out are '='."""
    ops = F.transform(cigar.cs_ops(F.col("cs")), lambda x: F.when(x["op"] == ":", F.struct(F.lit("=").alias("op"), F.repeat(F.lit("="), x["arg"].try_cast("int")).alias("arg"))).otherwise(x))
    n = lambda x: F.length(x["arg"])
    part = lambda x, k: F.when(x["op"] == "*", F.substring(x["arg"], k, 1)).when(x["op"] == "=", x["arg"]).when(x["op"] == ("-" if k == 1 else "+"), x["arg"]).otherwise(F.repeat(F.lit("-"), n(x)))
    bars = lambda x: F.when(x["op"] == "=", F.repeat(F.lit("|"), n(x))).when(x["op"] == "*", " ").otherwise(F.repeat(F.lit(" "), n(x)))
    rows = {k: F.array_join(F.transform("__o", f), "") for k, f in (("t", lambda x: part(x, 1)), ("q", lambda x: part(x, 2)), ("m", bars))}
    wide = paf.where("cs IS NOT NULL").withColumn("__o", F.filter(ops, lambda x: x["op"].isin("=", "*", "+", "-"))).withColumns({f"__{k}": c for k, c in rows.items()})
    cut = lambda c: F.regexp_extract_all(F.col(c), F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    held = lambda s: F.length(F.replace(s, F.lit("-"), F.lit("")))
    plus = F.col("strand") != "-"
    first = F.struct(F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("q"), F.array().cast("array<string>").alias("out"))
    left, right = (lambda v: F.lpad(v.cast("string"), 10, " ")), (lambda v: F.rpad(v.cast("string"), 10, " "))

    def add(acc: Column, x: Column) -> Column:
        t1, q1 = acc["t"] + held(x["t"]), acc["q"] + held(x["q"])
        q_from = F.when(plus, F.col("qs") + acc["q"] + 1).otherwise(F.col("qe") - acc["q"])
        q_to = F.when(plus, F.col("qs") + q1).otherwise(F.col("qe") - q1 + 1)
        lines = F.concat(
            F.lit("Ref+: "), left(F.col("ts") + acc["t"] + 1), F.lit(" "), x["t"], F.lit(" "), right(F.col("ts") + t1), F.lit("\n" + " " * 17), x["m"],
            F.lit("\nQry"), F.col("strand"), F.lit(": "), left(q_from), F.lit(" "), x["q"], F.lit(" "), right(q_to),
        )
        return F.struct(t1.alias("t"), q1.alias("q"), F.concat(acc["out"], F.array(lines)).alias("out"))

    lines = F.arrays_zip(cut("__t").alias("t"), cut("__q").alias("q"), cut("__m").alias("m"))
    return wide.select("id", F.array_join(F.aggregate(lines, first, add, lambda acc: acc["out"]), "\n\n").alias("text"))


def lav_stanza(score: Column, rows: Column) -> Column:
    """The stanza of a two-row block: its score, ends, and a line with the percent identity for each stretch without gaps."""
    a, b = rows[0], rows[1]
    mark = lambda t, q: F.when(t == "", "").when(t == "-", F.when(q == "-", "B").otherwise("I")).when(q == "-", "D").when(F.upper(t) == F.upper(q), "M").otherwise("X")
    tokens = F.regexp_extract_all(F.array_join(F.zip_with(F.split(a["text"], ""), F.split(b["text"], ""), mark), ""), F.lit("([MX]+|I+|D+|B+)"), F.lit(1))
    first = F.struct((a["start"] + 1).alias("t"), (b["start"] + 1).alias("q"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        n, run = F.length(x), F.substring(x, 1, 1).isin("M", "X")
        on = lambda *k: F.when(run | F.substring(x, 1, 1).isin(*k), n).otherwise(0)
        same = F.floor(F.length(F.replace(x, F.lit("X"), F.lit(""))) * 100 / n)
        line = F.concat_ws(" ", F.lit("  l"), *[v.cast("string") for v in (acc["t"], acc["q"], acc["t"] + n - 1, acc["q"] + n - 1, same)])
        return F.struct((acc["t"] + on("D")).alias("t"), (acc["q"] + on("I")).alias("q"), F.when(run, F.concat(acc["out"], F.array(line))).otherwise(acc["out"]).alias("out"))

    text = lambda *v: F.concat_ws(" ", *[x.cast("string") for x in v])
    head = [F.lit("a {"), text(F.lit("  s"), F.floor(score)), text(F.lit("  b"), a["start"] + 1, b["start"] + 1), text(F.lit("  e"), a["start"] + a["size"], b["start"] + b["size"])]
    return F.concat_ws("\n", *head, F.aggregate(tokens, first, add, lambda acc: acc["out"]), F.lit("}"))


def rows_of_paf(paf: DataFrame, targets: DataFrame, queries: DataFrame) -> DataFrame:
    """(score, rows) of PAF rows with cg, the letters taken from sequences (contig, seq) by chunks; for aligners that tell no letters."""
    minus = F.col("strand") == "-"
    own = F.when(minus, F.col("qlen") - F.col("qe")).otherwise(F.col("qs"))
    wide = letters(paf, chunked(targets.select(F.col("contig").alias("tname"), "seq"), ("tname",)), "__t", "ts", "te", ("tname",))
    wide = letters(wide, chunked(queries.select(F.col("contig").alias("qname"), "seq"), ("qname",)), "__q", "qs", "qe", ("qname",)).where("__t IS NOT NULL AND __q IS NOT NULL")
    wide = wide.withColumn("__q", F.when(minus, revcomp(F.col("__q"))).otherwise(F.col("__q")))
    placed = F.filter(cigar.placed(F.col("cg"), F.lit(0)), lambda x: x["op"].isin("M", "=", "X", "I", "D", "N"))
    cut = lambda c, at, x: F.substring(F.col(c), (at + 1).cast("int"), x["len"].cast("int"))
    dashes = lambda x: F.repeat(F.lit("-"), x["len"].cast("int"))
    t = F.array_join(F.transform(placed, lambda x: F.when(x["op"] == "I", dashes(x)).otherwise(cut("__t", x["st"], x))), "")
    q = F.array_join(F.transform(placed, lambda x: F.when(x["op"].isin("D", "N"), dashes(x)).otherwise(cut("__q", x["q"], x))), "")
    row = lambda src, start, size, strand, whole, text: F.struct(src.alias("src"), start.cast("long").alias("start"), size.cast("long").alias("size"), strand.alias("strand"), whole.cast("long").alias("src_size"), text.alias("text"))
    rows = F.array(row(F.col("tname"), F.col("ts"), F.col("te") - F.col("ts"), F.lit("+"), F.col("tlen"), t), row(F.col("qname"), own, F.col("qe") - F.col("qs"), F.col("strand"), F.col("qlen"), q))
    return wide.select(F.col("nmatch").cast("double").alias("score"), rows.alias("rows"))


#: Aligners whose output `pair_blocks` reads, with what it is read as.
ALIGNERS = {"minimap2_chr": "paf", "minimap2_ctg": "paf", "mummer": "delta", "last_chr": "maf", "last_ctg": "maf", "lastz": "maf", "anchorwave": "maf"}


def pair_blocks(rows: DataFrame, aligner: str, target: str, query: str, sizes: Column | None = None, targets: DataFrame | None = None, queries: DataFrame | None = None, swap: bool = False) -> DataFrame:
    """(score, rows) of an aligner's output as its reader gives it (PAF with a long cs, delta, or MAF), in the one form that nets are made of: the target's row on top
    and on the plus strand, contig chunks (_ctg, sizes: a map) on their chromosomes. Names of PAF have dots for underscores; deltas need both sequences;
    anchorwave's rows get the genomes' names. With swap the query is on top."""
    from genoweave.operators import blocks

    kind = ALIGNERS.get(aligner)
    if kind is None:
        raise ValueError(f"{aligner} is none of {', '.join(ALIGNERS)}")
    if kind == "paf":
        out = paf_to_maf(rows)
        dotted = lambda r: F.struct(F.replace(r["src"], F.lit("_"), F.lit(".")).alias("src"), *[r[c].alias(c) for c in ("start", "size", "strand", "src_size", "text")])
        out = out.withColumn("rows", F.transform("rows", dotted))
    elif kind == "delta":
        if targets is None or queries is None:
            raise ValueError("a delta has no letters: targets and queries are needed")
        out = rows_of_paf(delta_to_paf(rows), targets, queries)
    else:
        out = name_genomes(rows, target, query) if aligner == "anchorwave" else rows
        on_top = F.concat(F.filter("rows", lambda r: blocks.genome(r) == target), F.filter("rows", lambda r: blocks.genome(r) != target))
        out = out.withColumn("rows", blocks.upright(on_top))
    if aligner.endswith("_ctg"):
        if sizes is None:
            raise ValueError("chunks of contigs need the sizes of their chromosomes")
        lifted = lift_contigs(F.slice("rows", 2, 1), sizes)
        out = out.withColumn("rows", F.concat(F.slice("rows", 1, 1), lifted))
    return out.withColumn("rows", blocks.flip(F.col("rows"))).select("score", "rows") if swap else out.select("score", "rows")
