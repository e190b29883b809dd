"""Variant rules and renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of rendered files.
SV_FORMAT, SV_QUAL = "GT:GQ", 22
SNP_FORMAT, SNP_QUAL, SNP_CELL = "GT:GQ:DP:HQ", 50, "48:10:51,51"


def carries(members: Column, sample: Column) -> Column:
    """Whether a sample is among the contigs that gave the variant (the genome is the part before the first dot)."""
    return F.exists(members, lambda m: F.split_part(m, F.lit("."), F.lit(1)) == sample)


def allele_lengths(ref: Column, alts: Column, svlen: Column | None = None) -> Column:
    """struct<lo, hi>: the least and largest change of length; symbolic alleles are skipped, a given SVLEN stands for all."""
    real = F.filter(alts, lambda a: ~a.startswith("<"))
    sizes = F.transform(real, lambda a: F.abs(F.length(a) - F.length(ref)))
    lo, hi = F.array_min(sizes), F.array_max(sizes)
    if svlen is not None:
        lo, hi = F.coalesce(F.abs(svlen), lo), F.coalesce(F.abs(svlen), hi)
    return F.struct(F.coalesce(lo, F.lit(0)).alias("lo"), F.coalesce(hi, F.lit(0)).alias("hi"))


def select_by_length(rows: DataFrame, least: int, most: int) -> DataFrame:
    """rows (ref, alts) whose largest change is at least `least` and smallest at most `most`."""
    n = allele_lengths(F.col("ref"), F.col("alts"))
    return rows.where((n["hi"] >= least) & (n["lo"] <= most))


def is_transition(ref: Column, alt: Column) -> Column:
    return F.concat(F.upper(ref), F.upper(alt)).isin("AG", "GA", "CT", "TC")


#: Upper limits of the lengths of insertions and deletions that are counted together.
CHANGES = (1, 2, 49, 999, 6999)


def indel_bucket(change: Column) -> Column:
    """The limit of CHANGES that the length of a change is within; NULL beyond."""
    n, out = F.abs(change), F.lit(None).cast("int")
    for limit in reversed(CHANGES):
        out = F.when(n <= limit, limit).otherwise(out)
    return out


def allele_stats(rows: DataFrame) -> DataFrame:
    """(metric, within, n) of rows (ref, alts): letters that differ over the shorter allele (ts, tv), and insertions and deletions by the limit
    their length is within (NULL: longer). Symbolic alleles are left out."""
    each = rows.select("ref", F.explode("alts").alias("alt")).where("NOT startswith(alt, '<') AND substring(alt, 2, 1) <> '>'")
    pair = F.zip_with(F.split("ref", ""), F.split("alt", ""), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    apart = F.filter(pair, lambda x: (x["a"] != "") & (x["b"] != "") & (x["a"] != x["b"]))
    change = F.length("alt") - F.length("ref")
    kinds = F.transform(apart, lambda x: F.struct(F.when(F.concat(x["a"], x["b"]).isin("AG", "GA", "CT", "TC"), "ts").otherwise("tv").alias("metric"), F.lit(None).cast("int").alias("within")))
    indel = F.when(change != 0, F.array(F.struct(F.when(change > 0, "ins").otherwise("del").alias("metric"), indel_bucket(change).alias("within"))))
    found = each.select(F.explode(F.concat(kinds, F.coalesce(indel, F.slice(kinds, 1, 0)))).alias("x"))
    return found.groupBy("x.metric", "x.within").agg(F.count("*").alias("n"))


def sv_line(chrom: Column, pos: Column, ref: Column, alt: Column, kind: Column, end: Column, length: Column, cells: Column | None = None) -> Column:
    """A VCF line of a structural variant."""
    info = F.concat(F.lit("SVTYPE="), kind, F.lit(";END="), end.cast("string"), F.lit(";SVLEN="), length.cast("string"))
    fixed = [chrom, pos.cast("string"), F.concat(F.lit("SV"), pos.cast("string")), ref, alt, F.lit(str(SV_QUAL)), F.lit("PASS"), info, F.lit(SV_FORMAT)]
    return F.concat_ws("\t", *fixed, *([cells] if cells is not None else []))


def snp_line(chrom: Column, pos: Column, ref: Column, alts: Column, ns: Column, af: Column, calls: Column) -> Column:
    """A VCF line of a single-base variant; calls are allele numbers, NULL where a sample has none."""
    info = F.concat(F.lit("NS="), ns.cast("string"), F.lit(";DP=10;AF="), af)
    cells = F.transform(calls, lambda c: F.concat(F.coalesce(F.concat(c.cast("string"), F.lit("|"), c.cast("string")), F.lit(".|.")), F.lit(f":{SNP_CELL}")))
    return F.concat_ws("\t", chrom, pos.cast("string"), F.lit("."), ref, alts, F.lit(str(SNP_QUAL)), F.lit("PASS"), info, F.lit(SNP_FORMAT), F.array_join(cells, "\t"))
