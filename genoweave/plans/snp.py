"""Single-base variants over all samples. Rows are gap-free runs and differing bases, never aligned bases: what a sample has at
a locus is read from the run that covers it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.functions.interval import af_text
from genoweave.operators.posmap import BIN

LOCUS = ["contig", "pos", "ref"]


def differences(runs: DataFrame) -> DataFrame:
    """(contig, sample, pos, ref, base) of the columns of runs (posmap.aligned_runs) whose letters differ; pos is 1-based, letters upper case."""
    both = F.arrays_zip(F.split(F.upper("t_seq"), "").alias("t"), F.split(F.upper("q_seq"), "").alias("q"))
    each = F.filter(F.transform(both, lambda x, i: F.struct(i.alias("i"), x["t"].alias("t"), x["q"].alias("q"))), lambda x: x["t"] != x["q"])
    found = runs.where(F.upper("t_seq") != F.upper("q_seq")).select("contig", "sample", "t_from", F.explode(each).alias("x"))
    return found.select("contig", "sample", (F.col("t_from") + F.col("x.i") + 1).alias("pos"), F.col("x.t").alias("ref"), F.col("x.q").alias("base"))


def loci(runs: DataFrame) -> DataFrame:
    """Distinct (contig, pos, ref, alt) where some sample differs; any letter counts as a base."""
    return differences(runs).select(*LOCUS, F.col("base").alias("alt")).distinct()


def bases(found: DataFrame, runs: DataFrame, bin_size: int = BIN) -> DataFrame:
    """(contig, sample, pos, ref, base) of every run with a base at a locus of `found` whose reference letter it agrees with.

    An equi-join on contig and bin: runs are listed in each bin they touch, loci in their own."""
    at = found.select(*LOCUS).distinct().withColumn("__bin", F.floor((F.col("pos") - 1) / bin_size))
    wide = runs.select("contig", "sample", "t_from", "t_to", "t_seq", "q_seq", F.explode(F.sequence(F.floor(F.col("t_from") / bin_size), F.floor(F.col("t_to") / bin_size))).alias("__bin"))
    met = at.join(wide, ["contig", "__bin"]).where("pos - 1 BETWEEN t_from AND t_to")
    place, one = (F.col("pos") - F.col("t_from")).cast("int"), F.lit(1)
    return met.where(F.upper(F.substring("t_seq", place, one)) == F.col("ref")).select("contig", "sample", "pos", "ref", F.upper(F.substring("q_seq", place, one)).alias("base"))


def frequencies(cols: DataFrame, found: DataFrame) -> DataFrame:
    """For each locus and alternative: samples with a base, those with the alternative, and its percentage, cut."""
    same = F.count_if(F.col("base") == F.col("alt"))
    return found.join(cols, LOCUS).groupBy(*LOCUS, "alt").agg(F.count("base").alias("ns"), same.alias("ac"), F.floor(100.0 * same / F.count("base") + 1e-9).cast("double").alias("percent"))


def with_af(freq: DataFrame) -> DataFrame:
    """frequencies with the text of the allele frequency."""
    return freq.withColumn("af", af_text(F.col("ac"), F.col("ns")))


def matrix(cols: DataFrame, found: DataFrame, samples: list[str], missing: str = "-") -> DataFrame:
    """One row for each locus with its alternatives, sorted, and the base of each sample."""
    alts = found.groupBy(*LOCUS).agg(F.array_join(F.array_sort(F.collect_set("alt")), ",").alias("alt"))
    wide = cols.groupBy(*LOCUS).pivot("sample", samples).agg(F.max("base"))
    return alts.join(wide, LOCUS, "left").select(*LOCUS, "alt", *[F.coalesce(F.col(s), F.lit(missing)).alias(s) for s in samples])
