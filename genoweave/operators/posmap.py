"""Position maps as gap-free runs of aligned columns, and lookups through them.

A two-row block has columns block, contig, t_start, t_text, sample, q_contig, q_start, q_strand, q_size, q_text; starts
are 0-based on the row's own strand. A run maps target positions t_from..t_to (0-based, both included) to query
positions q_from, q_from + step, ...: one row for as many bases as stand between two gaps (up to the width of a piece).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 1024


def _cut(blocks: DataFrame, width: int) -> DataFrame:
    piece = lambda c: F.regexp_extract_all(F.col(c), F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    sizes = lambda c: F.transform(c, lambda x: F.length(F.replace(x, F.lit("-"), F.lit(""))).cast("long"))
    starts = lambda first, c: F.aggregate(sizes(c), F.array(F.col(first).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    wide = blocks.withColumn("__t", piece("t_text")).withColumn("__q", piece("q_text")).withColumn("__ts", starts("t_start", "__t")).withColumn("__qs", starts("q_start", "__q"))
    part = F.transform("__t", lambda x, i: F.struct(x.alias("t_text"), F.get("__q", i).alias("q_text"), F.get("__ts", i).alias("t_start"), F.get("__ts", i + 1).alias("t_end"), F.get("__qs", i).alias("q_start")))
    return wide.select("block", "contig", "sample", "q_contig", "q_strand", "q_size", F.explode(part).alias("x")).select("block", "contig", "sample", "q_contig", "q_strand", "q_size", "x.*")


def pieces(blocks: DataFrame, width: int = 512) -> DataFrame:
    """Blocks cut into pieces of at most `width` columns, with t_start, t_end (exclusive) and q_start of each.

    Texts are cut inside their row, first into long pieces and these into short ones, so a block of any length costs no exchange and
    no long list; pieces without columns are none."""
    return _cut(_cut(blocks, 512 * width), width)


def aligned_runs(blocks: DataFrame, width: int = 512) -> DataFrame:
    """(block, sample, contig, q_contig, q_strand, q_size, t_from, t_to, q_own, t_seq, q_seq): the runs of columns with letters in
    both rows, with their letters; q_own is the first's 0-based place on the query's own strand. No row stands for a base and
    nothing is exchanged: a piece's columns become one string of marks, whose tokens are the runs. Runs end where pieces do."""
    mark = lambda t, q: F.when(t == "", "").when(t == "-", F.when(q == "-", "B").otherwise("I")).when(q == "-", "D").otherwise("M")
    marks = F.array_join(F.zip_with(F.split("t_text", ""), F.split("q_text", ""), mark), "")
    parts = pieces(blocks, width).withColumn("tokens", F.regexp_extract_all(marks, F.lit("(M+|I+|D+|B+)"), F.lit(1)))
    zero, kind = F.lit(0), "array<struct<col:int,n:int,t:int,q:int>>"
    first = F.struct(zero.alias("col"), zero.alias("t"), zero.alias("q"), F.array().cast(kind).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        n, op = F.length(x), F.substring(x, 1, 1)
        run = F.array(F.struct((acc["col"] + 1).alias("col"), n.alias("n"), acc["t"].alias("t"), acc["q"].alias("q")))
        on = lambda kinds: F.when(op.isin(*kinds), n).otherwise(0)
        return F.struct((acc["col"] + n).alias("col"), (acc["t"] + on("MD")).alias("t"), (acc["q"] + on("MI")).alias("q"), F.when(op == "M", F.concat(acc["out"], run)).otherwise(acc["out"]).alias("out"))

    runs = parts.withColumn("x", F.explode(F.aggregate("tokens", first, add, lambda acc: acc["out"])))
    x, t_from = F.col("x"), F.col("t_start") + F.col("x.t")
    return runs.select(
        "block", "sample", "contig", "q_contig", "q_strand", "q_size", t_from.alias("t_from"), (t_from + x["n"] - 1).alias("t_to"), (F.col("q_start") + x["q"]).alias("q_own"),
        F.substring("t_text", x["col"], x["n"]).alias("t_seq"), F.substring("q_text", x["col"], x["n"]).alias("q_seq"),
    )


def position_runs(blocks: DataFrame) -> DataFrame:
    """(sample, contig, t_from, t_to, q_name, q_from, step): q positions on the plus strand, step -1 for a minus row."""
    minus = F.col("q_strand") == "-"
    return aligned_runs(blocks).select(
        "sample", "contig", "t_from", "t_to", F.col("q_contig").alias("q_name"),
        F.when(minus, F.col("q_size") - 1 - F.col("q_own")).otherwise(F.col("q_own")).alias("q_from"), F.when(minus, -1).otherwise(1).alias("step"),
    )


def shifted(runs: DataFrame) -> DataFrame:
    """Runs in the numbers that genotyping uses: target positions are 1-based plus 1; query positions 1-based plus 1 on the
    plus strand, and 1-based less 1 on the minus strand."""
    query = F.when(F.col("step") > 0, F.col("q_from") + 2).otherwise(F.col("q_from"))
    return runs.withColumn("q_from", query).withColumn("t_from", F.col("t_from") + 2).withColumn("t_to", F.col("t_to") + 2)


def _mapped(pos: Column) -> Column:
    return F.col("q_from") + F.col("step") * (pos - F.col("t_from"))


def lookup(points: DataFrame, runs: DataFrame, bin_size: int = BIN) -> DataFrame:
    """points (contig, pos, ...) with sample, q_name and q_pos for each run that holds the position (inner).

    An equi-join on contig and bin: runs are listed in each bin they touch, points in their own."""
    wide = runs.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("t_from") / bin_size), F.floor(F.col("t_to") / bin_size))))
    found = points.withColumn("__bin", F.floor(F.col("pos") / bin_size)).join(wide, ["contig", "__bin"])
    found = found.where((F.col("pos") >= F.col("t_from")) & (F.col("pos") <= F.col("t_to")))
    return found.withColumn("q_pos", _mapped(F.col("pos"))).drop("__bin", "t_from", "t_to", "q_from", "step")


def lookup_nearest(points: DataFrame, runs: DataFrame, right: bool, bin_size: int = BIN) -> DataFrame:
    """points (key, contig, lo, hi) with the nearest mapped position within lo..hi: the first if right, else the last.

    (key, sample, pos, q_name, q_pos). Points and runs meet in the bins that both touch; one is kept for each key and sample."""
    spread = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / bin_size), F.floor(F.col(hi) / bin_size)))
    met = points.where("lo <= hi").withColumn("__bin", spread("lo", "hi")).join(runs.withColumn("__bin", spread("t_from", "t_to")), ["contig", "__bin"])
    met = met.where("t_from <= hi AND t_to >= lo")
    pos = F.greatest("lo", "t_from") if right else F.least("hi", "t_to")
    hits = met.withColumn("pos", pos).withColumn("q_pos", _mapped(pos))
    pick = F.min if right else F.max
    best = hits.groupBy("key", "sample").agg(pick(F.struct("pos", "q_name", "q_pos")).alias("x"))
    return best.select("key", "sample", "x.pos", "x.q_name", "x.q_pos")


def asof(points: DataFrame, marks: DataFrame, by: tuple[str, ...] = ("contig",), bound: int | None = None) -> DataFrame:
    """points (id, by, pos) with the last mark at or before each: both are sorted together, so no range is joined.

    (id, by, pos, mark_pos, mark); mark NULL if none lies within `bound`. Of marks at the same position the largest counts."""
    both = points.select(*by, "pos", F.col("id"), F.lit(None).cast("long").alias("mark"), F.lit(1).alias("kind")).unionByName(
        marks.select(*by, "pos", F.lit(None).cast("long").alias("id"), F.col("mark").cast("long"), F.lit(0).alias("kind"))
    )
    order = Window.partitionBy(*by).orderBy("pos", "kind", "mark").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == 0, F.struct(F.col("pos").alias("p"), F.col("mark").alias("m"))), ignorenulls=True).over(order)
    found = both.withColumn("__last", last).where("kind = 1")
    near = F.col("__last").isNotNull() if bound is None else F.col("pos") - F.col("__last.p") <= bound
    return found.select("id", *by, "pos", F.when(near, F.col("__last.p")).alias("mark_pos"), F.when(near, F.col("__last.m")).alias("mark"))
