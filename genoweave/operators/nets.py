"""Nets of fills and gaps: the hierarchical synteny filter and the classification of gaps into structural variants.

A node has net, node, parent, depth, kind ('fill' or 'gap'), t_start, t_size, q_name, q_strand, q_start, q_size and tags
(a map of strings: id, score, ali, qOver, qFar, qDup, type). Depths alternate: fills 1, 3, 5, gaps 2, 4, 6.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions.seq import revcomp
from genoweave.operators.lineage import settled
from genoweave.operators.seqs import chunked, letters


def tag(name: str, kind: str = "long") -> Column:
    """A tag by its name, NULL if the node has none."""
    return F.try_element_at(F.col("tags"), F.lit(name)).cast(kind)


def own_rule(top_len: int = 500_000, nonsyn_len: int = 500_000, syn_len: int = 500_000, inv_len: int = 10_000, ali_rate: float = 0.1, q_far: int = 5_000_000) -> Column:
    """Whether a node passes by itself: gaps up to depth 6 do, fills by their kind's length and share of aligned bases."""
    size = F.col("t_size")
    enough = F.coalesce(tag("ali") / size > ali_rate, F.lit(False))
    near_inversion = (size > inv_len) & enough & (tag("qOver") > 0) & (tag("qFar") < q_far)
    long_inversion = (size > 5 * inv_len) & (F.col("q_size") > 5 * inv_len) & (tag("qFar") < size)
    kind = tag("type", "string")
    deep = (
        F.when(kind == "nonSyn", (size > nonsyn_len) & enough)
        .when(kind == "syn", (size > syn_len) & enough)
        .when(kind == "inv", near_inversion | long_inversion)
        .otherwise(False)
    )
    fill = F.when(F.col("depth") == 1, (size > top_len) & enough).when(F.col("depth").isin(3, 5), deep).otherwise(False)
    return F.coalesce(F.when(F.col("kind") == "gap", F.col("depth").isin(2, 4, 6)).otherwise(fill), F.lit(False))


def filter_synteny(nodes: DataFrame, **limits) -> DataFrame:
    """Nodes that pass and whose ancestors all pass. Depth is at most 6, so five semi-joins up the tree are enough; each
    level is joined with the kept nodes of the level above."""
    passed = nodes.where(own_rule(**limits))
    kept = passed.where("depth = 1")
    out = kept
    for depth in range(2, 7):
        above = kept.select("net", F.col("node").alias("parent"))
        kept = passed.where(F.col("depth") == depth).join(above, ["net", "parent"], "left_semi")
        out = out.unionByName(kept)
    return out


def drop_empty(nodes: DataFrame) -> DataFrame:
    """Nodes of nets that have a fill."""
    return nodes.join(nodes.where("kind = 'fill'").select("net").distinct(), "net", "left_semi")


def paired_chromosomes(kept: DataFrame) -> DataFrame:
    """(net, partners): the query contigs of the top and non-syntenic fills that were kept, sorted."""
    fills = kept.where((F.col("kind") == "fill") & ((F.col("depth") == 1) | (tag("type", "string") == "nonSyn")))
    return fills.groupBy("net").agg(F.array_sort(F.collect_set("q_name")).alias("partners"))


def gap_bed(nodes: DataFrame) -> DataFrame:
    return nodes.where("kind = 'gap'").select(F.col("net").alias("contig"), F.col("t_start").alias("st"), (F.col("t_start") + F.col("t_size")).alias("en"))


def walked_fills(nodes: DataFrame, top: int = 20_000, deeper: int = 10_000) -> DataFrame:
    """Fills that are looked into: by their aligned bases, not their length."""
    return nodes.where((F.col("kind") == "fill") & (tag("ali") >= F.when(F.col("depth") == 1, top).otherwise(deeper)))


def gap_flanks(gaps: DataFrame) -> DataFrame:
    """gaps (fill, t_start, t_size, fill_start, fill_end) with five and three: the aligned stretch before and after each gap."""
    order = Window.partitionBy("fill").orderBy("t_start", "t_size")
    end = F.col("t_start") + F.col("t_size")
    return gaps.withColumn("five", F.col("t_start") - F.coalesce(F.lag(end).over(order), "fill_start")).withColumn("three", F.coalesce(F.lead("t_start").over(order), "fill_end") - end)


def gap_fills(gaps: DataFrame, children: DataFrame) -> DataFrame:
    """gaps (gap, t_len, q_len) with sums over their child fills (gap, kind, t_len, ali, q_far, q_start, q_len): n, total_cov
    of all, and ali, inv_len and the query span of those syntenic or inverted and nearer than twice the gap."""
    child = children.select("gap", F.col("t_len").alias("c_len"), "ali", "q_far", F.col("q_start").alias("c_start"), F.col("q_len").alias("c_qlen"), "kind")
    met = gaps.select("gap", "t_len").join(child, "gap")
    near = F.col("kind").isin("syn", "inv") & (F.col("q_far") < 2 * F.col("t_len"))
    sums = met.groupBy("gap").agg(
        F.count("*").alias("n"), F.sum("c_len").alias("total_cov"), F.sum(F.when(near, F.col("ali")).otherwise(0)).alias("ali"),
        F.sum(F.when(near & (F.col("kind") == "inv"), F.col("ali")).otherwise(0)).alias("inv_len"),
        F.min(F.when(near, F.least("c_start", F.col("c_start") + F.col("c_qlen")))).alias("q_min"), F.max(F.when(near, F.greatest("c_start", F.col("c_start") + F.col("c_qlen")))).alias("q_max"),
    )
    return gaps.join(sums, "gap", "left")


def gap_class(t_len: Column, q_len: Column, n: Column, total_cov: Column, ali: Column, inv_len: Column, cnv_len: int = 500, del_len: int = 20_000, rate: float = 0.25) -> Column:
    """The class of a gap from its lengths and the sums over its child fills (n is NULL or 0 without children)."""
    sparse = (total_cov / t_len < 0.1) & (t_len > 10_000)
    longer = t_len / (q_len + 0.1) > 2
    filled = (
        F.when(longer & (inv_len > (q_len + t_len) / 4) & (inv_len > cnv_len), "InvCNV")
        .when(longer & (ali / t_len > rate) & (ali > cnv_len), "CNV")
        .when(longer & (t_len <= del_len), F.when(sparse, "DEL_PAV").otherwise("DEL"))
        .when(sparse, "CMPLX_PAV")
        .otherwise("CMPLX")
    )
    return F.when(F.coalesce(n, F.lit(0)) > 0, filled).when(t_len / (q_len + 0.01) > 2, "DEL_PAV").otherwise("CMPLX_PAV")


def companion(sv: Column) -> Column:
    """The second row that a copy-number class also gives."""
    return F.when(sv == "InvCNV", "DEL_invCNV").when(sv == "CNV", "DEL_CNV")


def inversion_fills(gaps: DataFrame, children: DataFrame, inv_len: int = 10_000, long: int = 20_000) -> DataFrame:
    """Child fills that are inversions of their own: near, and overlapping or long, with enough aligned bases."""
    met = children.join(gaps.select("gap", F.col("t_len").alias("gap_len")), "gap")
    big = (F.col("q_over") >= inv_len) | ((F.col("t_len") > long) & (F.col("q_len") > long))
    return met.where((F.col("kind") == "inv") & (F.col("q_far") < 2 * F.col("gap_len")) & big & (F.col("ali") >= inv_len))


def trl_class(depth: Column, kind: Column, t_len: Column, q_far: Column, least: int = 5000) -> Column:
    """The translocation class of a fill, NULL if it is none."""
    return F.when(depth == 1, F.when(t_len > 10 * least, "ChrEND")).when(
        kind.isin("syn", "inv"), F.when((t_len > least) & (q_far > 2 * t_len), "IntraChr")
    ).when(kind == "nonSyn", F.when(t_len > least, "InterChr"))


def call_sv(nodes: DataFrame, **limits) -> DataFrame:
    """(net, gap, fill, svtype, t_start, t_end, q_name, q_start, q_end, five, three) of all gaps under walked fills, and INV
    rows of inverted child fills with their own coordinates."""
    fills = walked_fills(nodes).select("net", F.col("node").alias("fill"), F.col("t_start").alias("fill_start"), (F.col("t_start") + F.col("t_size")).alias("fill_end"))
    strand = F.col("q_strand") if "q_strand" in nodes.columns else F.lit("+")
    gaps = nodes.where("kind = 'gap'").select("net", F.col("parent").alias("fill"), F.col("node").alias("gap"), "t_start", "t_size", "q_name", strand.alias("strand"), "q_start", F.col("q_size").alias("q_len"))
    gaps = gap_flanks(gaps.join(fills, ["net", "fill"])).withColumn("t_len", F.col("t_size")).withColumn("gap", F.struct("net", "gap"))
    child = nodes.where("kind = 'fill'").select(
        F.struct(F.col("net"), F.col("parent").alias("gap")).alias("gap"), F.col("node").alias("child"), F.col("t_start").alias("c_t"), F.col("t_size").alias("t_len"), tag("ali").alias("ali"),
        tag("qFar").alias("q_far"), tag("qOver").alias("q_over"), F.col("q_name").alias("c_name"), "q_start", F.col("q_size").alias("q_len"), tag("type", "string").alias("kind"),
    )
    summed = gap_fills(gaps, child).withColumn("svtype", gap_class(F.col("t_len"), F.col("q_len"), F.col("n"), F.col("total_cov"), F.col("ali"), F.col("inv_len"), **limits))
    kinds = F.explode(F.filter(F.array("svtype", companion(F.col("svtype"))), lambda x: x.isNotNull()))
    end = (F.col("t_start") + F.col("t_len")).alias("t_end")
    rows = summed.select("net", "gap.gap", "fill", kinds.alias("svtype"), "t_start", end, "q_name", "q_start", (F.col("q_start") + F.col("q_len")).alias("q_end"), "five", "three", "strand", F.col("t_start").alias("g_start"), end.alias("g_end"), F.col("q_name").alias("g_name"), F.col("q_start").alias("g_q0"), (F.col("q_start") + F.col("q_len")).alias("g_q1"))
    own = gaps.select("gap", "net", "fill", "five", "three", "strand", F.col("t_start").alias("g_start"), (F.col("t_start") + F.col("t_len")).alias("g_end"), F.col("q_name").alias("g_name"), F.col("q_start").alias("g_q0"), (F.col("q_start") + F.col("q_len")).alias("g_q1"))
    inv = inversion_fills(gaps.select("gap", "t_len"), child).join(own, "gap")
    inv = inv.select("net", "gap.gap", "fill", F.lit("INV").alias("svtype"), F.col("c_t").alias("t_start"), (F.col("c_t") + F.col("t_len")).alias("t_end"), F.col("c_name").alias("q_name"), "q_start", (F.col("q_start") + F.col("q_len")).alias("q_end"), "five", "three", "strand", "g_start", "g_end", "g_name", "g_q0", "g_q1")
    return rows.unionByName(inv)


#: From so many bases on, a sequence is given by its two ends with ten Ns between them.
LONG, ENDS = 1_000_000, 500


def with_sequences(calls: DataFrame, targets: DataFrame, queries: DataFrame) -> DataFrame:
    """calls (of call_sv) with ref_seq and query_seq of the gap, one letter more than its length, and the 20 letters before and after it on both
    (t5, t3, q5, q3); on the minus strand the query's are reverse-complemented. targets and queries are (contig, seq), cut into chunks.

    Where a contig begins less than 20 letters before, there are fewer."""
    rows = settled(calls.withColumn("__id", F.monotonically_increasing_id()), "calls")
    out = rows
    for seqs, name, st, en, marks in ((targets, "net", "g_start", "g_end", ("ref_seq", "t5", "t3")), (queries, "g_name", "g_q0", "g_q1", ("query_seq", "q5", "q3"))):
        # the four stretches of each call are looked up at once
        a, b, size = F.col(st), F.col(en), F.col(en) - F.col(st)
        part = lambda mark, lo, hi: F.struct(F.lit(mark).alias("mark"), lo.cast("long").alias("__a"), hi.cast("long").alias("__b"))
        each = F.array(part("head", a, F.when(size < LONG, b + 1).otherwise(a + ENDS)), part("tail", F.when(size >= LONG, b - ENDS), b), part("5", a - 20, a), part("3", b, b + 20))
        ranges = rows.select("__id", name, F.explode(each).alias("r")).select("__id", name, "r.*")
        found = letters(ranges, chunked(seqs.select(F.col("contig").alias(name), "seq"), (name,)), "s", "__a", "__b", (name,))
        wide = found.groupBy("__id").agg(*[F.max(F.when(F.col("mark") == m, F.col("s"))).alias(c) for m, c in (("head", "__head"), ("tail", "__tail"), ("5", marks[1]), ("3", marks[2]))])
        whole = F.when(size < LONG, F.col("__head")).otherwise(F.concat("__head", F.lit("N" * 10), "__tail"))
        out = out.join(wide, "__id").withColumn(marks[0], whole).drop("__head", "__tail")
    turn = lambda c: F.when(F.col("strand").contains("-"), revcomp(F.col(c))).otherwise(F.col(c))
    return out.withColumns({c: turn(c) for c in ("query_seq", "q5", "q3")}).drop("__id")


def call_trl(nodes: DataFrame, least: int = 5000) -> DataFrame:
    """(net, t_start, t_end, q_name, q_start, q_end, class, depth) of the fills that are translocations."""
    found = walked_fills(nodes).withColumn("class", trl_class(F.col("depth"), tag("type", "string"), F.col("t_size"), tag("qFar"), least)).where("class IS NOT NULL")
    return found.select("net", "t_start", (F.col("t_start") + F.col("t_size")).alias("t_end"), "q_name", "q_start", (F.col("q_start") + F.col("q_size")).alias("q_end"), "class", "depth")
