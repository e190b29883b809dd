"""Genotyping of merged variants in every sample. Variants have contig, beg, fin, len, kind; runs come from posmap.

Cheap tests come first and only what they leave open is looked at in the alignment, so the costly step sees few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.functions import interval
from genoweave.functions.seq import chars, revcomp
from genoweave.functions.variants import carries
from genoweave.operators import intervals, kernels, posmap
from genoweave.operators.lineage import dealt, settled, spread
from genoweave.operators.seqs import chunked, letters

KEY = ["contig", "beg", "fin", "len", "kind"]


def _ends(variants: DataFrame, runs: DataFrame, lo: Column, hi: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carry, sample, upper, n, q): where the lower and the upper end of each variant lie in each sample in which they are mapped. Both ends of all
    variants are looked up in one join."""
    end = lambda at, upper: F.struct(at.cast("long").alias("pos"), F.lit(upper).alias("upper"))
    keyed = variants.select(*KEY, *carry, F.explode(F.array(end(lo, False), end(hi, True))).alias("e")).select(*KEY, *carry, "e.*")
    return posmap.lookup(keyed, posmap.shifted(runs)).select(*KEY, *carry, "sample", "upper", F.col("q_name").alias("n"), F.col("q_pos").alias("q"))


def _end(upper: bool) -> Column:
    """Of grouped ends, where the lower or the upper one lies (the least, if it is mapped many times)."""
    return F.min(F.when(F.col("upper") == upper, F.col("q")))


def _held_ends(variants: DataFrame, runs: DataFrame, lo: Column, hi: Column, bin_size: int = posmap.BIN) -> DataFrame:
    """The variants, each with the runs that hold its lower or upper end (sample, q_lo, q_hi; NULL where a run does not hold it); those that no run holds stay, without
    a sample. Variants are listed in the bins of their ends, which are mostly one; neither side is sent through the driver."""
    bin_of = lambda c: F.floor(F.col(c) / bin_size)
    points = variants.withColumns({"__lo": lo.cast("long"), "__hi": hi.cast("long")})
    points = points.withColumn("__bin", F.explode(F.when(bin_of("__lo") == bin_of("__hi"), F.array(bin_of("__lo"))).otherwise(F.array(bin_of("__lo"), bin_of("__hi")))))
    moved = posmap.shifted(runs).withColumn("__bin", F.explode(F.sequence(bin_of("t_from"), bin_of("t_to")))).withColumnRenamed("contig", "__contig").withColumnRenamed("__bin", "__b")
    holds = lambda c: (bin_of(c) == F.col("__bin")) & (F.col(c) >= F.col("t_from")) & (F.col(c) <= F.col("t_to"))
    met = spread(points, "contig", "__bin").join(moved.hint("merge"), (F.col("contig") == F.col("__contig")) & (F.col("__bin") == F.col("__b")) & (holds("__lo") | holds("__hi")), "left")
    at = lambda c: F.when(holds(c), F.col("q_from") + F.col("step") * (F.col(c) - F.col("t_from")))
    return met.select(*variants.columns, "sample", at("__lo").alias("q_lo"), at("__hi").alias("q_hi"))


def _indel_ends(variants: DataFrame, runs: DataFrame) -> DataFrame:
    lo = F.when(F.col("kind") == "DEL", F.col("beg")).otherwise(F.col("beg") - 2)
    return _held_ends(variants.select(*KEY), runs, lo, F.col("fin") + 2)


def _indel_call(q_lo: Column, q_hi: Column) -> Column:
    d = F.abs(q_hi - q_lo)
    call_del = F.when(d == F.col("len") + 2, "0|0").when(d <= 2, "1|1").otherwise(".|.")
    call_ins = F.when(d == F.col("len") + 4, "1|1").when(d <= 4, "0|0").otherwise(".|.")
    return F.when(F.col("kind") == "DEL", call_del).otherwise(call_ins)


def genotype_indel(variants: DataFrame, runs: DataFrame) -> DataFrame:
    """(key, sample, gt) of small indels from the query distance of two reference positions around them."""
    ends = _indel_ends(variants, runs).groupBy(*KEY, "sample").agg(F.min("q_lo").alias("q_lo"), F.min("q_hi").alias("q_hi")).where("q_lo IS NOT NULL AND q_hi IS NOT NULL")
    return ends.select(*KEY, "sample", _indel_call(F.col("q_lo"), F.col("q_hi")).alias("gt"))


def indel_table(variants: DataFrame, runs: DataFrame, samples: list[str], missing: str = ".|.") -> DataFrame:
    """The same as one row for each different variant and one column for each sample: both ends in all samples are numbers of one aggregation, so
    variants are read once and not joined again."""
    ends = spread(_indel_ends(variants, runs), *KEY)
    least = lambda c, s: F.min(F.when(F.col("sample") == s, F.col(c)))
    wide = ends.groupBy(*KEY).agg(*[least(c, s).alias(f"{c}_{i}") for i, s in enumerate(samples) for c in ("q_lo", "q_hi")])
    both = lambda i: F.col(f"q_lo_{i}").isNotNull() & F.col(f"q_hi_{i}").isNotNull()
    return wide.select(*KEY, *[F.when(both(i), _indel_call(F.col(f"q_lo_{i}"), F.col(f"q_hi_{i}"))).otherwise(missing).alias(s) for i, s in enumerate(samples)])


def carriers(variants: DataFrame) -> DataFrame:
    """(key, sample) of the genomes that gave each variant: members are its contigs, a genome's name is the part before the first dot.
    Without a column `members` there are none."""
    if "members" not in variants.columns:
        return variants.select(*KEY, F.lit("").alias("sample")).limit(0)
    genomes = F.array_distinct(F.transform("members", lambda m: F.split_part(m, F.lit("."), F.lit(1))))
    return variants.select(*KEY, F.explode(genomes).alias("sample")).distinct()


def _others(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows (key, sample, ...) of samples that do not carry the variant."""
    return rows.join(known, [*KEY, "sample"], "left_anti")


def _carried(known: DataFrame) -> DataFrame:
    return known.select(*KEY, "sample", F.lit("1|1").alias("gt"))


def pivot(calls: DataFrame, variants: DataFrame, samples: list[str], missing: str = ".|.") -> DataFrame:
    """One row for each variant and one column for each sample; samples are given, so no pass is spent to find them."""
    wide = calls.groupBy(*KEY).pivot("sample", samples).agg(F.max("gt"))
    return variants.select(*KEY).join(wide, KEY, "left").select(*KEY, *[F.coalesce(F.col(s), F.lit(missing)).alias(s) for s in samples])


def _deletion_ends(variants: DataFrame, runs: DataFrame, extend: int, carry: tuple[str, ...] = ()) -> DataFrame:
    w = interval.flank_window_del(F.col("beg"), F.col("fin"), F.col("five"), F.col("three"), F.lit(extend))
    return _ends(variants, runs, w["beg0"], w["end0"], ("five", "three", *carry))


def _deletion_call(q_lo: Column, q_hi: Column, extend: int, slack: int) -> Column:
    fiv, thr = F.least(F.col("five"), F.lit(extend)), F.when(F.col("three") > 1000, extend).otherwise(F.col("three"))
    return interval.deletion_span_call(F.abs(q_hi - q_lo) - (fiv + thr - 10), F.col("len"), slack)


def genotype_del(variants: DataFrame, runs: DataFrame, extend: int = 1000, slack: int = 13) -> DataFrame:
    """(key, sample, gt) of deletions (with five and three, the flanks' lengths) by the query span between the flanks; 'window'
    where the alignment itself has to be looked at (window_identity)."""
    ends = _deletion_ends(variants, runs, extend)
    both = ends.groupBy(*KEY, "five", "three", "sample").agg(_end(False).alias("lo"), _end(True).alias("hi")).where("lo IS NOT NULL AND hi IS NOT NULL")
    return both.select(*KEY, "sample", _deletion_call(F.col("lo"), F.col("hi"), extend, slack).alias("gt"))


def insertion_spans(variants: DataFrame, runs: DataFrame) -> DataFrame:
    """(key, sample, flank, span, n_lo, q_lo, n_hi, q_hi): ends are looked up at the flanks, or at the nearest mapped position
    towards the variant; the span is the query's length between them less that of the flanks as asked for."""
    flank = interval.flank_bucket_ins(F.col("len"))
    w = interval.flank_window_ins(F.col("beg"), F.col("fin"), F.col("five"), F.col("three"), flank)
    moved = settled(posmap.shifted(runs), "runs")
    keyed = variants.select(F.struct(*KEY).alias("key"), "contig", w["beg0"].cast("long").alias("beg0"), w["end0"].cast("long").alias("end0"), F.col("beg").cast("long").alias("b"), F.col("fin").cast("long").alias("e"))
    left = posmap.lookup_nearest(keyed.select("key", "contig", F.col("beg0").alias("lo"), F.col("b").alias("hi")), moved, right=True)
    right = posmap.lookup_nearest(keyed.select("key", "contig", F.col("e").alias("lo"), F.col("end0").alias("hi")), moved, right=False)
    extended = variants.select(F.struct(*KEY).alias("key"), w["extended"].alias("extended"))
    both = left.select("key", "sample", F.col("q_name").alias("n_lo"), F.col("q_pos").alias("q_lo")).join(right.select("key", "sample", F.col("q_name").alias("n_hi"), F.col("q_pos").alias("q_hi")), ["key", "sample"]).join(extended, "key")
    span = F.abs(F.col("q_hi") - F.col("q_lo")) - F.col("extended")
    return both.select("key.*", "sample", interval.flank_bucket_ins(F.col("key.len")).alias("flank"), span.alias("span"), "n_lo", "q_lo", "n_hi", "q_hi")


def genotype_ins(variants: DataFrame, runs: DataFrame, slack: int = 13, far: int = 200_000) -> DataFrame:
    """(key, sample, gt) of insertions: '0|0' if the query has no more than the flanks, 'window' where the sequence has to be
    aligned (genotype_insertions does it)."""
    spans = insertion_spans(variants, runs)
    return spans.select(*KEY, "sample", _insertion_call(slack, far).alias("gt"))


def _insertion_call(slack: int, far: int) -> Column:
    """Two contigs or one and the same place cannot hold the insertion, but a short span is decided before that is asked."""
    first = interval.insertion_span_call(F.col("span"), slack, far)
    return F.when((first == "window") & ((F.col("n_lo") != F.col("n_hi")) | (F.col("q_lo") == F.col("q_hi"))), ".|.").otherwise(first)


def genotype_insertions(variants: DataFrame, runs: DataFrame, sequences: DataFrame, slack: int = 13, far: int = 200_000, identical: float = 95.0) -> DataFrame:
    """(key, sample, gt) of insertions, all decided. variants have five, three, and where the insertion was found: query (genome.contig), q_st
    and q_en (1-based, closed); sequences are (sample, contig, seq).

    Genomes among the members carry it. Where the span leaves a call open, the sample's sequence between both ends is aligned with that of
    the genome in which the insertion was found, with the flanks. Ranges of sequences are cut from chunks. A contig without sequence gives
    '.|.'; a flank that begins before its contig is shorter."""
    known = carriers(variants)
    spans = settled(_others(insertion_spans(variants, runs), known).withColumn("gt", _insertion_call(slack, far)), "spans")
    parts = chunked(sequences.select("sample", "contig", "seq"), ("sample", "contig"))
    flank = interval.flank_bucket_ins(F.col("len"))
    genome = F.split_part("query", F.lit("."), F.lit(1))
    given = variants.select(*KEY, genome.alias("g"), F.col("query").alias("n"), (F.col("q_st") - 1 - flank).cast("long").alias("a0"), (F.col("q_en") + flank).cast("long").alias("a1"), F.least(flank, F.col("q_st") - 1).alias("left"))
    open_rows = spans.where("gt = 'window'").withColumns({"b0": F.least("q_lo", "q_hi").cast("long") - 1, "b1": F.greatest("q_lo", "q_hi").cast("long")})
    wanted = given.join(open_rows.select(*KEY).distinct(), KEY, "left_semi").withColumnsRenamed({"contig": "__contig"}).withColumnsRenamed({"g": "sample", "n": "contig"})
    found = letters(wanted, parts, "a", "a0", "a1", ("sample", "contig")).drop("sample", "contig").withColumnRenamed("__contig", "contig").select(*KEY, "left", "a")
    own = open_rows.withColumnsRenamed({"contig": "__contig", "n_lo": "contig"})
    own = letters(own, parts, "s", "b0", "b1", ("sample", "contig")).drop("contig").withColumnRenamed("__contig", "contig")
    todo = own.join(found, KEY).select(*KEY, "sample", "left", "a", F.when(F.col("q_lo") > F.col("q_hi"), revcomp(F.col("s"))).otherwise(F.col("s")).alias("b"))
    rows = kernels.global_align(todo.where("a IS NOT NULL AND b IS NOT NULL"))
    # the middle is the one letter before the insertion
    marks = rows.select(*KEY, "sample", "identity", row_windows(F.col("a_row"), F.col("b_row"), F.col("left") - 1, F.col("left")).alias("w"))
    w = {k: F.col(f"w.{k}") for k in ("id5", "ov5", "region", "id3", "ov3")}
    flanks = (w["id5"] >= 0.75) & (w["id3"] >= 0.75) & (w["ov5"] >= 0.2) & (w["ov3"] >= 0.2)
    call = F.when(F.col("identity") > identical, "1|1").when(flanks & (w["region"] >= 0.4), "1|1").when(flanks & (w["region"] < 0.1), "0|0").when(w["region"] >= 0.9, "1|1").otherwise(".|.")
    aligned = marks.select(*KEY, "sample", call.alias("found"))
    decided = spans.select(*KEY, "sample", "gt").join(aligned, [*KEY, "sample"], "left").select(*KEY, "sample", F.when(F.col("gt") == "window", F.coalesce("found", F.lit(".|."))).otherwise(F.col("gt")).alias("gt"))
    return _carried(known).unionByName(decided)


def _tally(t: Column, q: Column, start: Column, lo: Column, first: Column, second: Column, hi: Column) -> Column:
    """struct of letters held and letters equal in the windows lo..first..second..hi (half-open) of two gapped rows, the upper
    one beginning at `start`."""
    zero = F.lit(0).cast("long")
    names = ("h5", "m5", "hr", "mr", "h3", "m3")

    def add(acc: Column, x: Column) -> Column:
        pos = acc["pos"]
        held = (x["t"] != "-") & (x["q"] != "-")
        same = held & (F.upper(x["t"]) == F.upper(x["q"]))
        part = {"5": (pos >= lo) & (pos < first), "r": (pos >= first) & (pos < second), "3": (pos >= second) & (pos < hi)}
        new = [(acc[k] + F.when(part[k[1]] & (held if k[0] == "h" else same), 1).otherwise(0)).alias(k) for k in names]
        return F.struct((pos + F.when(x["t"] != "-", 1).otherwise(0)).alias("pos"), *new)

    first_state = F.struct(start.cast("long").alias("pos"), *[zero.alias(k) for k in names])
    return F.aggregate(F.arrays_zip(chars(t).alias("t"), chars(q).alias("q")), first_state, add, lambda acc: F.struct(*[acc[k].alias(k) for k in names]))


def _rates(c: dict[str, Column], n5: Column, nr: Column, n3: Column) -> Column:
    """struct<id5, ov5, region, id3, ov3> of tallies and the windows' numbers of bases."""
    ratio = lambda a, b: a.cast("double") / (b + 1)
    return F.struct(ratio(c["m5"], c["h5"]).alias("id5"), ratio(c["h5"], n5).alias("ov5"), ratio(c["mr"], nr).alias("region"), ratio(c["m3"], c["h3"]).alias("id3"), ratio(c["h3"], n3).alias("ov3"))


def row_windows(a: Column, b: Column, first: Column, second: Column) -> Column:
    """The rates of one aligned pair of rows whose upper row is cut at two numbers of bases."""
    total = F.length(F.replace(a, F.lit("-"), F.lit("")))
    t = _tally(a, b, F.lit(0), F.lit(0), first, second, total)
    return _rates({k: t[k] for k in ("h5", "m5", "hr", "mr", "h3", "m3")}, first, second - first, total - second)


TALLIES = ("h5", "m5", "hr", "mr", "h3", "m3")


def _deletion_tallies(variants: DataFrame, blocks: DataFrame, flank: Column | None, width: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carry, sample, lo, hi, tallies) of each piece of a block that meets a variant's flanks lo..hi: pieces meet variants by bins."""
    size = interval.flank_bucket_del(F.col("len")) if flank is None else flank
    v = variants.select(*KEY, *carry, F.greatest(F.lit(0), F.col("beg") - 1 - size).cast("long").alias("lo"), (F.col("fin") + size).cast("long").alias("hi"))
    parts = posmap.pieces(blocks, width).where("t_end > t_start").select("contig", "sample", "t_start", "t_end", "t_text", "q_text")
    # neither side goes through the driver: a block's file is much smaller than its pieces
    met = intervals.overlap_join(v, parts.hint("merge"), max(1024, width), a_iv=("lo", "hi"), b_iv=("t_start", "t_end"), many=True)
    met = met.withColumn("x", _tally(F.col("t_text"), F.col("q_text"), F.col("t_start"), F.col("lo"), F.col("beg") - 1, F.col("fin"), F.col("hi")))
    return met.select(*KEY, *carry, "sample", "lo", "hi", *[F.col(f"x.{k}").alias(k) for k in TALLIES])


def _deletion_rates() -> Column:
    return _rates({k: F.col(k) for k in TALLIES}, F.col("beg") - 1 - F.col("lo"), F.col("fin") - F.col("beg") + 1, F.col("hi") - F.col("fin"))


def deletion_windows(variants: DataFrame, blocks: DataFrame, flank: Column | None = None, width: int = 512) -> DataFrame:
    """(key, sample, id5, ov5, region, id3, ov3) of each variant and sample with an aligned base within the flanks: blocks are cut
    into pieces, tallies are summed. Bases in no block count as not aligned."""
    sums = _deletion_tallies(variants, blocks, flank, width).groupBy(*KEY, "sample", "lo", "hi").agg(*[F.sum(k).alias(k) for k in TALLIES])
    return sums.select(*KEY, "sample", _deletion_rates().alias("r")).select(*KEY, "sample", "r.*")


def genotype_deletions(variants: DataFrame, blocks: DataFrame, extend: int = 1000, slack: int = 13, flank: Column | None = None, width: int = 512) -> DataFrame:
    """(key, sample, gt) of deletions (with five and three), all decided: genomes among the members carry it; else by the query span where
    both ends are mapped and the span is clear, else by the alignment between the flanks. A sample without aligned base there has no
    row; pivot fills '.|.'.

    The ends that are mapped and the tallies of the pieces meet in one aggregation; who carries a variant is told by the row itself."""
    given = settled(variants.withColumn("members", F.col("members") if "members" in variants.columns else F.array().cast("array<string>")), "variants")
    blocks = dealt(blocks)
    ends = _deletion_ends(given, posmap.position_runs(blocks).hint("merge"), extend, ("members",)).drop("n")
    tallies = _deletion_tallies(given, blocks, flank, width, ("five", "three", "members"))
    rows = ends.unionByName(tallies, allowMissingColumns=True).where(~carries(F.col("members"), F.col("sample")))
    # lo and hi follow from the key; rows of ends do not have them
    met = rows.groupBy(*KEY, "five", "three", "sample").agg(_end(False).alias("q_lo"), _end(True).alias("q_hi"), F.max("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(k).alias(k) for k in TALLIES])
    span = _deletion_call(F.col("q_lo"), F.col("q_hi"), extend, slack)
    met = met.withColumns({"span": F.when(F.col("q_lo").isNotNull() & F.col("q_hi").isNotNull(), F.nullif(span, F.lit("window"))), "r": F.when(F.col("lo").isNotNull(), _deletion_rates())})
    seen = F.when(F.col("r").isNotNull(), window_call(*[F.col(f"r.{c}") for c in ("id5", "ov5", "region", "id3", "ov3")]))
    decided = met.select(*KEY, "sample", F.coalesce("span", seen).alias("gt")).where("gt IS NOT NULL")
    return _carried(carriers(given)).unionByName(decided)


def window_identity(blocks: DataFrame, first: Column, second: Column) -> DataFrame:
    """(block, id5, ov5, region, id3, ov3): in the three windows of a reference row cut at two offsets, equal letters over
    aligned ones and aligned over all (each plus 1); the middle window compares with all its bases. Counted inside the row."""
    total = F.length(F.replace("t_text", F.lit("-"), F.lit("")))
    one, two = F.least(first, total), F.least(second, total)
    return blocks.select("block", _tally(F.col("t_text"), F.col("q_text"), F.lit(0), F.lit(0), first, second, total).alias("x"), one.alias("one"), two.alias("two"), total.alias("n")).select(
        "block", _rates({k: F.col(f"x.{k}") for k in ("h5", "m5", "hr", "mr", "h3", "m3")}, F.col("one"), F.col("two") - F.col("one"), F.col("n") - F.col("two")).alias("r")
    ).select("block", "r.*")


def window_call(id5: Column, ov5: Column, region: Column, id3: Column, ov3: Column, identity: float = 0.9, overlap: float = 0.2, hi: float = 0.5, lo: float = 0.1) -> Column:
    """The deletion's call from the rates of its windows: both flanks must be there, then a covered region is the reference."""
    flanks = (id5 >= identity) & (id3 >= identity) & (ov5 >= overlap) & (ov3 >= overlap)
    return F.when(flanks & (region >= hi), "0|0").when(flanks & (region < lo), "1|1").otherwise(".|.")


def genotype_inv(variants: DataFrame, alignments: DataFrame, bin_size: int = 1024) -> DataFrame:
    """(id, sample, q_name, gt) of inversions (id, contig, st, en, and members, if known) in samples' alignments (sample, q_name, contig, st, en, strand).

    Genomes among the members carry it (q_name NULL). In others, for the query with most of the interval, ties to the smaller name, the
    ratio of minus to plus alignments in both flanks (half the length) and between them decides."""
    flank = F.floor((F.col("en") - F.col("st")) / 2)
    names = F.array_distinct(F.transform("members", lambda m: F.split_part(m, F.lit("."), F.lit(1)))) if "members" in variants.columns else F.array().cast("array<string>")
    held = variants.withColumn("__given", names)
    wide = held.select("id", "contig", F.col("st").alias("v_st"), F.col("en").alias("v_en"), (F.col("st") - flank).alias("lo"), (F.col("en") + flank).alias("hi"), "__given")
    met = intervals.overlap_join(wide.hint("merge"), alignments, bin_size, a_iv=("lo", "hi"), b_iv=("st", "en"))
    # who carries a variant is told by the row itself, and a bin's pairs are together: they are summed before anything is exchanged
    met = met.where(~F.coalesce(F.array_contains("__given", F.col("sample")), F.lit(False)))
    known = held.select("id", F.explode("__given").alias("sample")).distinct()
    part = {"5": ("lo", "v_st"), "i": ("v_st", "v_en"), "3": ("v_en", "hi")}
    n = {k: interval.overlap_len(F.col("st"), F.col("en"), F.col(a), F.col(b)) for k, (a, b) in part.items()}
    by = lambda k, s: F.sum(F.when(F.col("strand") == s, n[k]).otherwise(0))
    rates = met.groupBy("id", "sample", "q_name").agg(F.sum(n["i"]).alias("inner"), *[(by(k, "-") / (by(k, "+") + 1).cast("double")).alias(f"r{k}") for k in part])
    best = rates.groupBy("id", "sample").agg(F.min(F.struct((-F.col("inner")).alias("o"), "q_name", "r5", "ri", "r3")).alias("x"))
    called = best.select("id", "sample", "x.q_name", interval.inversion_call(F.col("x.r5"), F.col("x.ri"), F.col("x.r3")).alias("gt"))
    return called.unionByName(known.select("id", "sample", F.lit(None).cast("string").alias("q_name"), F.lit("1|1").alias("gt")))
