"""Readers of text formats as DataFrames. Records are cut by the line separator, so a file is split among tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.operators.seqs import chunked, letters


def _lines(spark: SparkSession, path: str | list[str], sep: str | None = None) -> DataFrame:
    reader = spark.read.option("lineSep", sep) if sep else spark.read
    return reader.text(path)


def _fields(df: DataFrame, names: dict[str, str], sep: str = "\t") -> DataFrame:
    parts = F.split("value", sep)
    return df.select(*[F.try_element_at(parts, F.lit(i + 1)).try_cast(kind).alias(n) for i, (n, kind) in enumerate(names.items())], parts.alias("parts"))


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(contig, length, seq): the first word of a header is the name; letters keep their case."""
    records = _lines(spark, path, "\n>").select(F.regexp_replace("value", "^>", "").alias("v")).where("trim(v) <> ''")
    seq = F.regexp_replace(F.regexp_replace("v", r"^[^\n]*\n?", ""), r"\s", "")
    return records.select(F.regexp_extract("v", r"^(\S*)", 1).alias("contig"), F.length(seq).cast("long").alias("length"), seq.alias("seq"))


def fetch(ranges: DataFrame, seqs: DataFrame, iv: tuple[str, str] = ("st", "en")) -> DataFrame:
    """ranges (contig, half-open) with the letters of each (seq): longer than the contig is cut, before it begins clamps to 0."""
    return letters(ranges, chunked(seqs.select("contig", "seq")), "seq", *iv)


def fasta_range(seqs: DataFrame, spec: str, masked: DataFrame | None = None, fill: str = "") -> DataFrame:
    """The part of each sequence that a suffix [from,to] names (1-based, closed), reverse-complemented if it ends in -; in the letters of
    masked ranges (contig, st, en: 0-based, half-open) lower case, or all `fill` ("X" hides them), if they are given."""
    import re

    from genoweave.functions.seq import revcomp

    m = re.fullmatch(r"(?:\[(\d+),(\d+)\])?(-?)", spec)
    if not m:
        raise ValueError(f"not a range: {spec}")
    if masked is not None:
        spots = masked.groupBy("contig").agg(F.array_sort(F.collect_list(F.struct("st", "en"))).alias("__m"))
        part = lambda a, b: F.substring("seq", (a + 1).cast("int"), F.greatest(F.lit(0), (b - a).cast("int")))
        first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
        hidden = lambda s: F.repeat(F.lit(fill), F.length(s)) if fill else F.lower(s)
        add = lambda acc, x: F.struct(F.greatest(acc["at"], x["en"]).alias("at"), F.concat(acc["out"], part(acc["at"], x["st"]), hidden(part(F.greatest(acc["at"], x["st"]), x["en"]))).alias("out"))
        whole = F.aggregate("__m", first, add, lambda acc: F.concat(acc["out"], part(acc["at"], F.length("seq").cast("long"))))
        seqs = seqs.join(spots, "contig", "left").withColumn("seq", F.when(F.col("__m").isNull(), F.col("seq")).otherwise(whole)).drop("__m")
    seq = F.col("seq") if not m[1] else F.substring("seq", int(m[1]), int(m[2]) - int(m[1]) + 1)
    return seqs.withColumn("seq", revcomp(seq, "iupac") if m[3] else seq).withColumn("length", F.length("seq").cast("long"))


def contig_headers(seqs: DataFrame) -> DataFrame:
    """(contig, header) of sequences (contig, length): name, the closed range of all of it, strand and length."""
    size = F.col("length").cast("string")
    return seqs.select("contig", F.concat(F.lit(">"), "contig", F.lit(":1-"), size, F.lit(":+:"), size).alias("header"))


def check_names(records: DataFrame) -> DataFrame:
    """(path, header, problem) of FASTA records (path, header: the first line, seq) that name a genome badly: the file's name begins with a
    digit, the record does not begin with '>' and letters of nucleotides, or its name does not hold the file's name."""
    from genoweave.functions.seq import is_fasta_text

    genome = F.regexp_extract("path", r"([^/]*?)(?:\.fa|\.fasta|\.fna)?$", 1)
    name = F.regexp_extract("header", r"^>(\S*)", 1)
    problem = (
        F.when(genome.rlike("^[0-9]"), "begins with a digit").when(~F.coalesce("header", F.lit("")).startswith(">") | ~is_fasta_text(F.coalesce("seq", F.lit(""))), "not FASTA")
        .when(~F.contains(name, genome), "name without the genome")
    )
    return records.select("path", "header", problem.alias("problem")).where("problem IS NOT NULL")


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    return _fields(_lines(spark, path).where("trim(value) <> ''"), {"name": "string", "length": "long"}).drop("parts")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).select(F.trim("value").alias("name")).where("name <> ''")


def read_pairs(spark: SparkSession, path: str, pattern: str = r"([^/]+?)vs([^/]+?)\.[^/]*$") -> DataFrame:
    """(path, target, query) of the files of a folder whose names hold two genome names."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.select("path", F.regexp_extract("path", pattern, 1).alias("target"), F.regexp_extract("path", pattern, 2).alias("query")).where("target <> ''")


ROW = "struct<src:string,start:bigint,size:bigint,strand:string,src_size:bigint,text:string>"


def read_maf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(score, rows, error): blank lines separate blocks; lines other than a and s are skipped. error says where a row's size is
    not its number of letters or the rows' lengths differ."""
    blocks = _lines(spark, path, "\n\n").where(F.col("value").rlike(r"(?m)^s\s"))
    lines = F.filter(F.split("value", "\n"), lambda x: x.rlike(r"^s\s"))

    def row(line: Column) -> Column:
        p = F.split(F.trim(line), r"\s+")
        return F.struct(p[1].alias("src"), p[2].cast("long").alias("start"), p[3].cast("long").alias("size"), p[4].alias("strand"), p[5].cast("long").alias("src_size"), p[6].alias("text"))

    score = F.regexp_extract("value", r"(?m)^a.*?score=([-+0-9.eE]+)", 1).try_cast("double")
    out = blocks.select(score.alias("score"), F.transform(lines, row).alias("rows"))
    bad_size = F.exists("rows", lambda r: F.length(F.replace(r["text"], F.lit("-"), F.lit(""))) != r["size"])
    widths = F.size(F.array_distinct(F.transform("rows", lambda r: F.length(r["text"]))))
    return out.withColumn("error", F.when(bad_size, "size").when(widths > 1, "length"))


def pair_blocks(maf: DataFrame) -> DataFrame:
    """Two-row blocks as columns: block (a hash), contig, t_start, t_text, sample, q_contig, q_start, q_strand, q_size, q_text."""
    t, q = F.col("rows")[0], F.col("rows")[1]
    genome = lambda s: F.split_part(s, F.lit("."), F.lit(1))
    return maf.where(F.size("rows") == 2).select(
        F.xxhash64("rows").alias("block"), t["src"].alias("contig"), t["start"].alias("t_start"), t["text"].alias("t_text"), genome(q["src"]).alias("sample"),
        q["src"].alias("q_contig"), q["start"].alias("q_start"), q["strand"].alias("q_strand"), q["src_size"].alias("q_size"), q["text"].alias("q_text"),
    )


def read_net(spark: SparkSession, path: str) -> DataFrame:
    """Net nodes: a record for each net, depth by indentation, the parent is the last node one level up."""
    nets = _lines(spark, path, "\nnet ").select(F.regexp_replace("value", r"^(#[^\n]*\n)*(net )?", "").alias("v")).where(F.col("v").rlike(r"^\S+\s+\d+"))
    lines = nets.select(F.regexp_extract("v", r"^(\S+)", 1).alias("net"), F.regexp_extract("v", r"^\S+\s+(\d+)", 1).cast("long").alias("net_size"), F.posexplode(F.split("v", "\n")).alias("no", "line"))
    lines = lines.where(F.col("line").rlike(r"^ +(fill|gap) ")).withColumn("depth", F.length(F.regexp_extract("line", "^( +)", 1)))
    p = F.split(F.trim("line"), r"\s+")
    pairs = F.slice(p, F.lit(8), F.greatest(F.lit(0), F.size(p) - 7))
    half = F.floor(F.size(pairs) / 2).cast("int")
    tags = F.when(half > 0, F.map_from_arrays(F.transform(F.sequence(F.lit(0), half - 1), lambda i: F.element_at(pairs, 2 * i + 1)), F.transform(F.sequence(F.lit(0), half - 1), lambda i: F.element_at(pairs, 2 * i + 2)))).otherwise(F.create_map().cast("map<string,string>"))
    nodes = lines.select(
        "net", "net_size", F.col("no").cast("long").alias("node"), "depth", p[0].alias("kind"), p[1].cast("long").alias("t_start"), p[2].cast("long").alias("t_size"), p[3].alias("q_name"),
        p[4].alias("q_strand"), p[5].cast("long").alias("q_start"), p[6].cast("long").alias("q_size"), tags.alias("tags"),
    )
    from pyspark.sql import Window

    order = Window.partitionBy("net").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    above = F.coalesce(*[F.when(F.col("depth") == d + 1, F.last(F.when(F.col("depth") == d, F.col("node")), ignorenulls=True).over(order)) for d in range(1, 13)])
    return nodes.withColumn("parent", above)


TAGS = r"([A-Za-z][A-Za-z0-9]):[AifZHB]:([^\t]*)"


def tag_map(line: Column) -> Column:
    """The TG:T:V fields of a line as a map."""
    return F.map_from_arrays(F.regexp_extract_all(line, F.lit(r"\t" + TAGS), F.lit(1)), F.regexp_extract_all(line, F.lit(r"\t" + TAGS), F.lit(2)))


PAF = {"qname": "string", "qlen": "long", "qs": "long", "qe": "long", "strand": "string", "tname": "string", "tlen": "long", "ts": "long", "te": "long", "nmatch": "long", "blen": "long", "mapq": "int"}
SAM = {"qname": "string", "flag": "int", "rname": "string", "pos": "long", "mapq": "int", "cigar": "string", "rnext": "string", "pnext": "long", "tlen": "long", "seq": "string", "qual": "string"}
GTF = {"seqname": "string", "source": "string", "feature": "string", "start": "long", "end": "long", "score": "string", "strand": "string", "frame": "string", "attributes": "string"}
VCF = {"chrom": "string", "pos": "long", "id": "string", "ref": "string", "alt": "string", "qual": "string", "filter": "string", "info": "string", "format": "string"}


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    rows = _lines(spark, path).where(F.col("value").rlike(r"^([^\t]*\t){11}"))
    return rows.select(*_named(PAF), tag_map(F.col("value")).alias("tags"))


def _named(names: dict[str, str], sep: str = "\t") -> list[Column]:
    parts = F.split("value", sep)
    return [F.try_element_at(parts, F.lit(i + 1)).try_cast(kind).alias(n) for i, (n, kind) in enumerate(names.items())]


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, reference lengths)."""
    lines = _lines(spark, path)
    head = lines.where("value LIKE '@SQ\t%'").select(F.regexp_extract("value", r"\tSN:(\S+)", 1).alias("name"), F.regexp_extract("value", r"\tLN:(\d+)", 1).try_cast("long").alias("length"))
    return lines.where("value NOT LIKE '@%' AND value <> ''").select(*_named(SAM), tag_map(F.col("value")).alias("tags")), head


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """(value, format, qname): PAF or SAM lines, told apart: a sign in the fifth field is a strand, so the line is PAF."""
    lines = _lines(spark, path).where("value NOT LIKE '@%'")
    parts = F.split("value", "\t")
    is_paf = F.try_element_at(parts, F.lit(5)).isin("+", "-")
    return lines.select("value", F.when(is_paf, "paf").otherwise("sam").alias("format"), parts[0].alias("qname"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).where(F.col("value").rlike(r"^[^#\t]+\t\d+\t\d+")).select(*_named({"contig": "string", "st": "long", "en": "long", "name": "string", "score": "string", "strand": "string"}))


def read_bed12(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of BED12 lines, a row each; lines with fewer fields are one block."""
    lines = _lines(spark, path).where(F.col("value").rlike(r"^[^#\t]+\t\d+\t\d+"))
    p = F.split("value", "\t")
    ints = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("long"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("off"), (p[2].cast("long") - p[1].cast("long")).alias("size")))
    blocks = F.when(F.size(p) >= 12, F.zip_with(ints(F.try_element_at(p, F.lit(12))), ints(F.try_element_at(p, F.lit(11))), lambda o, s: F.struct(o.alias("off"), s.alias("size")))).otherwise(whole)
    rows = lines.select(p[0].alias("contig"), p[1].cast("long").alias("base"), F.try_element_at(p, F.lit(4)).alias("name"), F.explode(blocks).alias("b"))
    return rows.select("contig", (F.col("base") + F.col("b.off")).alias("st"), (F.col("base") + F.col("b.off") + F.col("b.size")).alias("en"), "name")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF or GFF3 rows with the transcript's id; start is 1-based as in the file."""
    rows = _lines(spark, path).where("value NOT LIKE '#%' AND value <> ''").select(*_named(GTF))
    tid = F.coalesce(F.nullif(F.regexp_extract("attributes", r"transcript_id[ =]\"?([^\";]+)", 1), F.lit("")), F.nullif(F.regexp_extract("attributes", r"Parent=([^;]+)", 1), F.lit("")))
    return rows.withColumn("transcript", tid)


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """The nine fixed columns and the genotypes as an array."""
    rows = _lines(spark, path).where("value NOT LIKE '#%' AND value <> ''")
    return rows.select(*_named(VCF), F.slice(F.split("value", "\t"), 10, 1_000_000).alias("genotypes"))


def info(column: Column, key: str) -> Column:
    """A value of a VCF INFO column; NULL if it has none."""
    return F.nullif(F.regexp_extract(column, rf"(?:^|;){key}=([^;]*)", 1), F.lit(""))


def read_delta(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a MUMmer delta file with their signed offsets: (tname, qname, tlen, qlen, ts, te, qs, qe, errors, offsets), 1-based."""
    records = _lines(spark, path, "\n>").where(F.col("value").rlike(r"^>?\S+ \S+ \d+ \d+"))
    head = F.split(F.regexp_extract("value", r"^>?([^\n]*)", 1), " ")
    body = F.regexp_extract_all("value", F.lit(r"\n(-?\d+ -?\d+ -?\d+ -?\d+ -?\d+ -?\d+ -?\d+)((?:\n-?\d+(?= *(?:\n|$)))*)"), F.lit(0))
    rows = records.select(head[0].alias("tname"), head[1].alias("qname"), head[2].cast("long").alias("tlen"), head[3].cast("long").alias("qlen"), F.explode(body).alias("a"))
    lines = F.split(F.regexp_replace("a", r"^\n", ""), "\n")
    f = F.split(lines[0], " ")
    offsets = F.transform(F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda x: ~x.isin("0", "")), lambda x: F.trim(x).cast("long"))
    return rows.select("tname", "qname", "tlen", "qlen", *[f[i].cast("long").alias(n) for i, n in enumerate(("ts", "te", "qs", "qe", "errors"))], offsets.alias("offsets"))
