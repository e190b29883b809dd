"""Renderings of text formats as lines, and their writing. Lines are written in the order given by range partitions, so the
part files of a folder, read in the order of their names, are one sorted file; nothing is gathered in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.functions import interval, variants

# Meta lines of the variant files written.
SV_META = (
    '##INFO=<ID=BKPTID,Number=.,Type=String,Description="ID of the assembled alternate allele in the assembly file">',
    '##INFO=<ID=CIEND,Number=2,Type=Integer,Description="Confidence interval around END for imprecise variants">',
    '##INFO=<ID=CIPOS,Number=2,Type=Integer,Description="Confidence interval around POS for imprecise variants">',
    '##INFO=<ID=END,Number=1,Type=Integer,Description="End position of the variant described in this record">',
    '##INFO=<ID=HOMLEN,Number=.,Type=Integer,Description="Length of base pair identical micro-homology at event breakpoints">',
    '##INFO=<ID=HOMSEQ,Number=.,Type=String,Description="Sequence of base pair identical micro-homology at event breakpoints">',
    '##INFO=<ID=SVLEN,Number=.,Type=Integer,Description="Difference in length between REF and ALT alleles">',
    '##INFO=<ID=SVTYPE,Number=1,Type=String,Description="Type of structural variant">',
    '##ALT=<ID=DEL,Description="Deletion">',
    '##ALT=<ID=DEL:ME:ALU,Description="Deletion of ALU element">',
    '##ALT=<ID=DEL:ME:L1,Description="Deletion of L1 element">',
    '##ALT=<ID=DUP,Description="Duplication">',
    '##ALT=<ID=DUP:TANDEM,Description="Tandem Duplication">',
    '##ALT=<ID=INS,Description="Insertion of novel sequence">',
    '##ALT=<ID=INS:ME:ALU,Description="Insertion of ALU element">',
    '##ALT=<ID=INS:ME:L1,Description="Insertion of L1 element">',
    '##ALT=<ID=INV,Description="Inversion">',
    '##ALT=<ID=CNV,Description="Copy number variable region">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype quality">',
    '##FORMAT=<ID=CN,Number=1,Type=Integer,Description="Copy number genotype for imprecise events">',
    '##FORMAT=<ID=CNQ,Number=1,Type=Float,Description="Copy number genotype quality for imprecise events">',
)
SNP_META = (
    "##phasing=phased",
    '##INFO=<ID=NS,Number=1,Type=Integer,Description="Number of Samples With Data">',
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Total Depth">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Allele Frequency">',
    '##INFO=<ID=AA,Number=1,Type=String,Description="Ancestral Allele">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP membership, build 129">',
    '##INFO=<ID=H2,Number=0,Type=Flag,Description="HapMap2 membership">',
    '##FILTER=<ID=q10,Description="Quality below 10">',
    '##FILTER=<ID=s50,Description="Less than 50% of samples have data">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype Quality">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Read Depth">',
    '##FORMAT=<ID=HQ,Number=2,Type=Integer,Description="Haplotype Quality">',
)


def maf_block(score: Column, rows: Column) -> Column:
    """A block of an alignment file with its blank line: names are padded to the right, numbers to the left."""
    widest = lambda f: F.array_max(F.transform(rows, lambda r: F.length(f(r))))
    number = lambda name: lambda r: r[name].cast("string")
    left = lambda r, name: F.lpad(r[name].cast("string"), widest(number(name)), " ")
    line = lambda r: F.concat_ws(" ", F.lit("s"), F.rpad(r["src"], widest(lambda x: x["src"]), " "), left(r, "start"), left(r, "size"), r["strand"], left(r, "src_size"), r["text"])
    return F.concat(F.format_string("a score=%.1f\n", F.coalesce(score, F.lit(0.0)).cast("double")), F.array_join(F.transform(rows, line), "\n"), F.lit("\n"))


def fasta_record(name: Column, seq: Column, width: int = 60) -> Column:
    """A header and the letters in lines of at most `width`."""
    lines = F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    return F.concat(F.lit(">"), name, F.when(F.size(lines) > 0, F.concat(F.lit("\n"), F.array_join(lines, "\n"))).otherwise(""))


def variant_fasta(kind: Column, chrom: Column, pos: Column, id: Column, ref: Column, alt: Column) -> Column:
    """The sequence that a structural variant takes away or adds, under its place and id."""
    return fasta_record(F.concat_ws("_", chrom, pos.cast("string"), id), F.when(kind == "DEL", ref).otherwise(alt), 1 << 30)


def header(df: DataFrame, sizes: DataFrame, meta: tuple[str, ...], samples: list[str], reference: str = "", species: str = "", date: str = "") -> DataFrame:
    """(part, contig, pos, line) of a variant file: version, meta lines, a line for each contig of sizes (name, length; in the order of their names), the columns' names, then
    the rows of df (contig, pos, line; part 3). With a reference its name, the date (YYYY-MM-DD, if given) and the source follow the version, the contigs come before
    the meta lines and tell assembly and species too."""
    spark = df.sparkSession
    names = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])
    about = ([f"##fileDate={date}"] if date else []) + ["##source=genoweave", f"##reference={reference}"] if reference else []
    fixed = [(-2, "", i, m) for i, m in enumerate(["##fileformat=VCFv4.2", *about])] + [(0, "", i, m) for i, m in enumerate(meta)] + [(2, "", 0, names)]
    more = f',assembly={reference},md5=XXXXXXXX,species="{species}",taxonomy=x>' if reference else ">"
    line = F.concat(F.lit("##contig=<ID="), "name", F.lit(",length="), F.col("length").cast("string"), F.lit(more))
    contigs = sizes.select(F.lit(-1 if reference else 1).alias("part"), F.col("name").alias("contig"), F.lit(0).cast("long").alias("pos"), line.alias("line"))
    top = spark.createDataFrame(fixed, "part int, contig string, pos long, line string")
    return top.unionByName(contigs).unionByName(df.select(F.lit(3).alias("part"), "contig", F.col("pos").cast("long").alias("pos"), "line"))


def sv_vcf(calls: DataFrame, sizes: DataFrame, samples: list[str], **about: str) -> DataFrame:
    """The lines of a file of structural variants: calls (contig, beg, fin, len, kind, ref, alt and a genotype for each sample)."""
    cells = F.concat_ws("\t", *[F.concat(F.coalesce(F.col(s), F.lit(".|.")), F.lit(f":{variants.SV_QUAL}")) for s in samples])
    line = variants.sv_line(F.col("contig"), F.col("beg"), F.col("ref"), F.col("alt"), F.col("kind"), F.col("fin"), F.col("len"), cells)
    return header(calls.select("contig", F.col("beg").alias("pos"), line.alias("line")), sizes, SV_META, samples, **about)


def snp_vcf(matrix: DataFrame, sizes: DataFrame, samples: list[str], **about: str) -> DataFrame:
    """The lines of a file of single-base variants: matrix (contig, pos, ref, alt joined by commas, and a base for each sample, '-'
    where it has none). Frequencies are cut after two decimals, one for each allele."""
    alts = F.split("alt", ",")
    known = F.array(*[F.col(s) for s in samples])
    held = F.filter(known, lambda b: b != "-")
    count = lambda a: F.size(F.filter(held, lambda b: b == a))
    af = F.array_join(F.transform(alts, lambda a: interval.af_text(count(a), F.size(held))), ",")
    calls = F.transform(known, lambda b: F.when(b == "-", None).when(b == F.col("ref"), 0).otherwise(F.nullif(F.array_position(alts, b), F.lit(0))).cast("int"))
    line = variants.snp_line(F.col("contig"), F.col("pos"), F.col("ref"), F.col("alt"), F.size(held), af, calls)
    return header(matrix.select("contig", "pos", line.alias("line")), sizes, SNP_META, samples, **about)


def write_lines(df: DataFrame, path: str, order: list[str], line: str = "line") -> None:
    """df's lines, sorted, as text; the folder is replaced."""
    df.orderBy(*order).select(line).write.mode("overwrite").text(path)


def write_vcf(lines: DataFrame, path: str) -> None:
    write_lines(lines, path, ["part", "contig", "pos", "line"])


def write_maf(blocks: DataFrame, path: str) -> None:
    """blocks (score, rows) sorted by the first row's name and start."""
    top = F.col("rows")[0]
    write_lines(blocks.select(top["src"].alias("src"), top["start"].alias("start"), maf_block(F.col("score"), F.col("rows")).alias("line")), path, ["src", "start"])


def write_fasta(seqs: DataFrame, path: str, width: int = 60) -> None:
    write_lines(seqs.select("contig", fasta_record(F.col("contig"), F.col("seq"), width).alias("line")), path, ["contig"])


def write_table(df: DataFrame, path: str, order: list[str], names: bool = True) -> None:
    """Tab-separated rows sorted by the columns named; a header in each part file if names."""
    df.orderBy(*order).write.mode("overwrite").option("sep", "\t").option("header", names).csv(path)
