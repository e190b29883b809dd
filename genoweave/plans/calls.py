"""Variants, lifted regions and paired haplotypes from pairwise alignments; evaluations of overlaps and junctions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions import cigar
from genoweave.operators import folds, intervals
from genoweave.operators.lineage import settled
from genoweave.operators.seqs import chunked, letters
from genoweave.operators.tiles import beside


def primary(paf: DataFrame, least_quality: int, least_length: int) -> DataFrame:
    """PAF rows (with type, s1 and s2 where known) that are mapped, primary, long and sure enough."""
    has = lambda c: F.col(c).isNotNull() if c in paf.columns else F.lit(False)
    kind = F.coalesce(F.col("type"), F.lit("P")) if "type" in paf.columns else F.lit("P")
    return paf.where((F.col("tname") != "*") & (F.col("blen") >= least_length) & (F.col("mapq") >= least_quality) & kind.isin("P", "I") & ~(has("s1") & ~has("s2")))


def covered_once(paf: DataFrame, long: int = 50_000) -> DataFrame:
    """(contig, st, en) of stretches that one alignment covers, if it has at least `long` columns: a sweep over ends summed by position."""
    rows = paf.select(F.col("tname").alias("contig"), F.col("ts").alias("st"), F.col("te").alias("en"), F.when(F.col("blen") >= long, 1).otherwise(0).alias("l"))
    runs = intervals.sweep(rows, weights={"depth": F.lit(1), "long": F.col("l")})
    return runs.where("depth = 1 AND long = 1 AND en IS NOT NULL").select("contig", "st", "en")


#: Tiles in which depths are counted, and the longest cs (characters) that goes on uncut.
DEPTH_TILE, UNCUT = 1 << 15, 1 << 12
OPERATION = re.compile(r"(:[0-9]+|\*[a-z][a-z]|[=+-][A-Za-z]+|~[a-z]{2}[0-9]+[a-z]{2})")


def _steps(cs: str) -> Iterator[tuple[str, str, int, int]]:
    """(op, arg, target letters, query letters) of a cs (see cigar.cs_ops)."""
    for x in OPERATION.findall(cs):
        op, arg = x[0], x[1:]
        n = int(arg) if op == ":" else 1 if op == "*" else int(arg[2:-2]) if op == "~" else len(arg)
        yield op, arg, 0 if op == "+" else n, n if op in ":=*+" else 0


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Alignments with where their cs begins (p_t, p_e: target, p_q: query letters before) and whether the row counts; a long cs goes in pieces behind a row without any."""
    for batch in batches:
        ts, te, cs = batch.column("ts"), batch.column("te"), batch.column("cs")
        long = pc.fill_null(pc.greater(pc.binary_length(cs), UNCUT), False)
        n = batch.num_rows
        row = batch.set_column(batch.schema.get_field_index("cs"), "cs", pc.if_else(long, pa.scalar(None, cs.type), cs))
        new = {"p_t": ts, "p_e": te, "p_q": pa.array([0] * n, pa.int64()), "counts": pa.array([True] * n)}
        yield pa.RecordBatch.from_arrays([*row.columns, *new.values()], names=[*row.schema.names, *new])
        for i in np.flatnonzero(long.to_numpy(zero_copy_only=False)):
            rest, found = batch.slice(i, 1), []
            t, q, begin, text = ts[i].as_py(), 0, None, []
            for op, arg, on_t, on_q in _steps(cs[i].as_py()):
                begin = begin or (t, q)
                text.append(op + arg)
                t, q = t + on_t, q + on_q
                if len(text) == UNCUT // 8:
                    found.append(("".join(text), begin[0], t, begin[1]))
                    begin, text = None, []
            if text:
                found.append(("".join(text), begin[0], t, begin[1]))
            for at in range(0, len(found), 256):
                some = found[at : at + 256]
                same = rest.take(pa.array([0] * len(some), pa.int64()))
                same = same.set_column(same.schema.get_field_index("cs"), "cs", pa.array([f[0] for f in some], cs.type))
                new = [pa.array([f[k] for f in some], pa.int64()) for k in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([*same.columns, *new, pa.array([False] * len(some))], names=[*same.schema.names, "p_t", "p_e", "p_q", "counts"])


def _depths(own: np.ndarray, st: np.ndarray, en: np.ndarray, ts: np.ndarray, te: np.ndarray, counts: np.ndarray, rank: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """The depth of each difference (its alignment's row, st, en) among the rows that count (see call_variants)."""
    at = np.flatnonzero(counts)
    by_end, by_start = at[np.argsort(te[at], kind="stable")], at[np.argsort(ts[at], kind="stable")]
    ends, starts = te[by_end], ts[by_start]
    depth = np.searchsorted(starts, st, "right") - np.searchsorted(ends, st, "right")
    depth += te[own] <= st  # an insertion at its alignment's own end
    flat = en == st
    # a later alignment that ends inside a deletion does not span it; at an insertion later ones may end, and must begin before it
    rules = (
        (by_end, np.searchsorted(ends, st, "right"), np.where(flat, 0, np.searchsorted(ends, en, "left")), -1, lambda j, s: ts[j] <= s),
        (by_end, np.searchsorted(ends, st, "left"), np.where(flat, np.searchsorted(ends, st, "right"), 0), 1, lambda j, s: ts[j] < s),
        (by_start, np.searchsorted(starts, st, "left"), np.where(flat, np.searchsorted(starts, st, "right"), 0), -1, lambda j, s: te[j] > s),
    )
    for order, lo, hi, sign, holds in rules:
        n = np.maximum(hi - lo, 0)
        some = np.flatnonzero(n)
        total = np.cumsum(n[some])
        first = 0
        while first < len(some):  # so many pairs at a time
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + block, "right")))
            d = some[first:last]
            pair = np.repeat(d, n[d])
            j = order[np.arange(len(pair)) - np.repeat(np.cumsum(n[d]) - n[d], n[d]) + np.repeat(lo[d], n[d])]
            hit = (rank[j] > rank[own[pair]]) & holds(j, st[pair])
            depth += sign * np.bincount(pair[hit], minlength=len(st))
            first = last
    return depth


def call_variants(paf: DataFrame, cover: int = 10_000, long: int = 50_000, quality: int = 5, bin_size: int = DEPTH_TILE) -> DataFrame:
    """Differences in the cs of alignments (with id) of at least `long` columns, with the number of alignments of at least `cover` columns over each (depth,
    itself included): id, contig, st, en, mapq, ref, alt, qname, qs, qe, strand, depth. Substitutions by n are left out. Calls are those of depth 1.

    In the order of starts (then ends, then id), an earlier alignment counts if it ends after the difference begins, a later one if it
    spans the difference and begins before its end. Alignments are listed in the tiles (of bin_size positions) that they touch, and cross one exchange: a tile's task
    finds their differences there and counts. A long cs is cut into pieces before, each of which goes to its own tiles only."""
    used = primary(paf, quality, cover)
    one = used.select("id", F.col("tname").alias("contig"), "ts", "te", "qname", "qs", "qe", "strand", F.col("mapq").cast("int").alias("mapq"), F.when(F.col("blen") >= long, F.col("cs")).alias("cs"))
    one = one.withColumns({c: F.col(c).cast("long") for c in ("ts", "te", "qs", "qe")})
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in one.schema.fields)
    cut = one.mapInArrow(_pieces, f"{kind}, p_t long, p_e long, p_q long, counts boolean")
    tile = lambda c: F.floor(F.col(c) / bin_size)
    listed = cut.withColumn("last", F.greatest(tile("p_t"), tile("p_e"))).withColumn("tile", F.explode(F.sequence(tile("p_t"), "last")))
    listed = listed.where("counts OR cs IS NOT NULL").withColumn("last", F.col("tile") == F.col("last")).drop("p_e")
    schema = f"id {one.schema['id'].dataType.simpleString()}, contig string, st long, en long, mapq int, ref string, alt string, qname string, qs long, qe long, strand string, depth long"

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lo = key[1].as_py() * bin_size
        hi = lo + bin_size
        own, st, en, ref, alt, q0 = [], [], [], [], [], []
        ts, te, counts = (table.column(c).to_numpy() for c in ("ts", "te", "counts"))
        strand, begin, end = (table.column(c).to_pylist() for c in ("strand", "qs", "qe"))
        for i, (cs, t, q, last) in enumerate(zip(*(table.column(c).to_pylist() for c in ("cs", "p_t", "p_q", "last")), strict=True)):
            for op, arg, on_t, on_q in _steps(cs or ""):
                # what stands beyond the end that the row states is told in its last tile
                if op in "*+-" and lo <= t and (t < hi or last) and not (op == "*" and "n" in arg):
                    own.append(i)
                    st.append(t)
                    en.append(t + on_t)
                    ref.append(arg[0] if op == "*" else arg if op == "-" else "-")
                    alt.append(arg[1] if op == "*" else arg if op == "+" else "-")
                    q0.append(end[i] - q - on_q if strand[i] == "-" else begin[i] + q)
                    q0.append(q0[-1] + on_q)
                t, q = t + on_t, q + on_q
        at = np.array(own, np.int64)
        rank = np.empty(len(ts), np.int64)
        rank[pc.sort_indices(table, [("ts", "ascending"), ("te", "ascending"), ("id", "ascending")]).to_numpy()] = np.arange(len(ts))
        depth = _depths(at, np.array(st, np.int64), np.array(en, np.int64), ts, te, counts, rank) if own else []
        whole = table.take(pa.array(at))
        new = {"st": pa.array(st, pa.int64()), "en": pa.array(en, pa.int64()), "ref": pa.array(ref, pa.string()), "alt": pa.array(alt, pa.string()), "qs": pa.array(q0[::2], pa.int64()), "qe": pa.array(q0[1::2], pa.int64()), "depth": pa.array(depth, pa.int64())}
        names = ("id", "contig", "st", "en", "mapq", "ref", "alt", "qname", "qs", "qe", "strand", "depth")
        return pa.table({c: new[c] if c in new else whole.column(c) for c in names})

    return listed.groupBy("contig", "tile").applyInArrow(run, schema)


def call_statistics(calls: DataFrame, gap: int = 50, long: int = 1000) -> DataFrame:
    """(kind, within, n) of calls (of call_variants) of depth 1: substitutions as transitions (ts) and others (tv), insertions and deletions by the length they are
    at most: 1, 2, under `gap`, under `long`, or more (NULL). Add covered_once for the bases that exactly one alignment covers."""
    one = calls.where("depth <= 1 AND NOT (ref = '-' AND alt = '-')")
    kind = F.when(F.col("ref") == "-", "ins").when(F.col("alt") == "-", "del").when(F.lower(F.concat("ref", "alt")).isin("ag", "ga", "ct", "tc"), "ts").otherwise("tv")
    size = F.when(F.col("ref") == "-", F.length("alt")).when(F.col("alt") == "-", F.length("ref"))
    within = F.when(size == 1, 1).when(size == 2, 2).when(size < gap, gap - 1).when(size < long, long - 1)
    return one.groupBy(kind.alias("kind"), within.alias("within")).agg(F.count("*").alias("n"))


def call_lines(calls: DataFrame, references: DataFrame) -> DataFrame:
    """(contig, pos, line) of a variant file of calls of depth 1: gaps take the reference's letter before them (references: contig, seq)."""
    one = calls.where("depth = 1")
    gap = (F.col("ref") == "-") | (F.col("alt") == "-")
    # only the letters that are needed travel: chunks of contigs meet the places asked for, one letter for each
    at = one.where(gap & (F.col("st") > 0)).select("contig", "st", (F.col("st") - 1).alias("before")).distinct()
    at = letters(at, chunked(references.select("contig", "seq")), "base", "before", "st").select("contig", "st", F.upper("base").alias("base"))
    rows = one.join(at, ["contig", "st"], "left").where(~gap | F.col("base").isNotNull())
    text = lambda c: F.when(~gap, F.upper(c)).when(F.col(c) == "-", F.col("base")).otherwise(F.concat("base", F.upper(c)))
    pos = F.when(gap, F.col("st")).otherwise(F.col("st") + 1)
    info = F.concat(F.lit("QNAME="), "qname", F.lit(";QSTART="), (F.col("qs") + 1).cast("string"), F.lit(";QSTRAND="), "strand")
    return rows.select("contig", pos.alias("pos"), F.concat_ws("\t", "contig", pos.cast("string"), F.lit("."), text("ref"), text("alt"), F.col("mapq").cast("string"), F.lit("."), info, F.lit("GT"), F.lit("1/1")).alias("line"))


def lift_regions(paf: DataFrame, regions: DataFrame, quality: int = 5, length: int = 50_000, divergence: float = 2.0, bin_size: int = 4096) -> DataFrame:
    """(contig, st, en, name, strand): query regions (contig, st, en) on the target, for each alignment (with cg) that meets them. An end
    outside the alignment becomes the alignment's and the name gets _t5 or _t3; inside an insertion it is the base after it."""
    used = primary(paf, quality, length)
    if 0 <= divergence < 1:
        s = cigar.sums(F.col("cg"))
        used = used.where(~cigar.too_divergent(F.col("blen") - F.col("nmatch") - s["gaps"], s["opens"], F.col("nmatch"), divergence))
    met = intervals.overlap_join(regions.select("contig", "st", "en"), used.select(F.col("qname").alias("contig"), "qlen", "qs", "qe", "strand", "tname", "ts", "te", cigar.ops(F.col("cg")).alias("__ops")), bin_size, b_iv=("qs", "qe"))
    minus = F.col("strand") == "-"
    first = F.when(minus, F.col("qlen") - F.col("en")).otherwise(F.col("st"))
    last = F.when(minus, F.col("qlen") - F.col("st") - 1).otherwise(F.col("en") - 1)
    start = F.struct(F.col("ts").alias("x"), F.when(minus, F.col("qlen") - F.col("qe")).otherwise(F.col("qs")).alias("y"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))

    def step(acc: Column, x: Column) -> Column:
        both, only_t = x["op"].isin("M", "=", "X"), x["op"].isin("D", "N")
        at = lambda p, old: F.when(old.isNull() & ~only_t & (acc["y"] <= p) & (p < acc["y"] + x["len"]), acc["x"] + F.when(both, p - acc["y"]).otherwise(0)).otherwise(old)
        return F.struct((acc["x"] + F.when(both | only_t, x["len"]).otherwise(0)).alias("x"), (acc["y"] + F.when(only_t, 0).otherwise(x["len"])).alias("y"), at(first, acc["a"]).alias("a"), at(last, acc["b"]).alias("b"))

    hit = met.withColumn("h", F.aggregate("__ops", start, step))
    name = F.concat(F.concat_ws("_", "contig", F.col("st").cast("string"), F.col("en").cast("string")), F.when(F.col("h.a").isNull(), "_t5").otherwise(""), F.when(F.col("h.b").isNull(), "_t3").otherwise(""))
    return hit.select(F.col("tname").alias("contig"), F.coalesce("h.a", "ts").alias("st"), F.coalesce(F.col("h.b") + 1, "te").alias("en"), name.alias("name"), "strand")


# Haploid-free ends of the sex chromosome in two assemblies (closed start, end).
PAR = {"37": ((0, 2_699_520), (154_931_043, 155_260_560)), "38": ((0, 2_781_479), (155_701_383, 156_030_895))}


def pair_haplotypes(vcf: DataFrame, male: bool = False, assembly: str | None = None, pattern: str = r"^(chr)?([0-9]+|X|Y)$") -> DataFrame:
    """vcf (chrom, pos, ref, genotypes: one for each haplotype, 'a/b:depths') with filter, genotype and qual: a haplotype that is not called
    (GAP) or has two alleles (HET) is a dot. On a male's single chromosomes the missing haplotype alone is no failure."""
    rows = vcf.where(F.col("chrom").rlike(pattern))
    g = [F.get("genotypes", F.lit(i)) for i in (0, 1)]
    part = lambda c, i: F.regexp_extract(c, r"^(\.|[0-9]+)/(\.|[0-9]+):(\S+)", i)
    gap, het = [part(c, 1) == "." for c in g], [(part(c, 1) != ".") & (part(c, 1) != part(c, 2)) for c in g]
    own = [F.when(gap[i] | het[i], ".").otherwise(part(g[i], 1)) for i in (0, 1)]
    fails = F.filter(F.array(*[F.when(gap[i], f"GAP{i + 1}").when(het[i], f"HET{i + 1}") for i in (0, 1)]), lambda f: f.isNotNull())
    if male:
        end = F.col("pos") + F.length("ref")
        shared = F.lit(False)
        for lo, hi in PAR.get(assembly or "", ()):
            shared = shared | ((F.col("pos") >= lo) & (end <= hi))
        one = F.when(F.col("chrom").rlike("^(chr)?X") & F.lit(assembly in PAR) & ~shared, "GAP1").when(F.col("chrom").rlike("^(chr)?Y"), "GAP2")
        fails = F.when((F.size(fails) == 1) & F.coalesce(fails[0] == one, F.lit(False)), F.array().cast("array<string>")).otherwise(fails)
    depths = F.zip_with(F.split(part(g[0], 3), ","), F.split(part(g[1], 3), ","), lambda a, b: (F.coalesce(a.try_cast("long"), F.lit(0)) + F.coalesce(b.try_cast("long"), F.lit(0))).cast("string"))
    return rows.select("chrom", "pos", "ref", F.when(F.size(fails) > 0, F.array_join(fails, ";")).otherwise(".").alias("filter"), F.concat(own[0], F.lit("|"), own[1], F.lit(":"), F.array_join(depths, ",")).alias("genotype"), F.lit(30).alias("qual"))


def overlap_counts(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(truths, found, both) of unordered pairs (a, b), repeats counted once; both sides are aggregated before they meet."""
    pair = lambda df, n: df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(n).alias("side"))
    sides = pair(found, 1).unionByName(pair(truth, 2)).groupBy("a", "b").agg(F.max(F.when(F.col("side") == 1, 1).otherwise(0)).alias("f"), F.max(F.when(F.col("side") == 2, 1).otherwise(0)).alias("t"))
    return sides.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("truths"), F.coalesce(F.sum("f"), F.lit(0)).alias("found"), F.count_if((F.col("f") == 1) & (F.col("t") == 1)).alias("both"))


GENE = ("full_sgl", "full_dup", "frag", "part50+", "part10+", "part10-")


def gene_cover(paf: DataFrame, least: float = 0.99, identity: float = 0.99) -> DataFrame:
    """(gene, whole, share) of spliced alignments of genes (qname, qlen, qs, qe, nmatch, blen): those of enough identity that hold
    enough of the gene, and the share of the gene that all of them cover together."""
    used = paf.where(F.col("nmatch") >= F.col("blen") * identity)
    whole = F.count_if(F.col("qe") - F.col("qs") >= F.col("qlen") * least)
    union = intervals.cov_union(used.select(F.col("qname").alias("gene"), F.col("qs").alias("st"), F.col("qe").alias("en")), ("gene",))
    counts = used.groupBy(F.col("qname").alias("gene")).agg(whole.alias("whole"), F.max("qlen").alias("qlen"))
    seen = paf.select(F.col("qname").alias("gene")).distinct()
    joined = seen.join(counts, "gene", "left").join(union, "gene", "left")
    return joined.select("gene", F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce(F.col("covered").cast("double") / F.col("qlen"), F.lit(0.0)).alias("share"))


def distinct_genes(paf: DataFrame) -> DataFrame:
    """(gene) of the reference's alignments (qname, qlen, tname, ts, te, no: the order of lines; a gene's last line counts): a walk by place,
    in which a gene that begins before the last one's end takes its place if it is longer, and is left out if it is not."""
    place = paf.groupBy(F.col("qname").alias("gene")).agg(F.max_by(F.struct("tname", "ts", "te", "qlen"), "no").alias("x")).select("gene", "x.*")
    # no gene of an island meets one of another, so each is walked on its own
    rows = intervals.islands(place.withColumnsRenamed({"ts": "st", "te": "en"}), ("tname",), touch=False)

    def step(last: tuple | None, row: dict) -> tuple[tuple, bool]:
        if last is None or row["st"] >= last[0] or row["qlen"] > last[1]:
            return (row["en"], row["qlen"]), True
        return last, False

    walked = folds.walk(rows, ["tname", "island"], ["st", "gene"], lambda: None, step, "now", "boolean", ["st", "en", "qlen"]).where("now")
    # of those that were the last one, one stays unless the next that took over began before its end
    return beside(walked, ("tname", "island"), "st", ["st", "gene"], {"__next": ("min", F.struct("st", "gene"))}, before=False).where("__next IS NULL OR __next.st >= en").select("gene")


def gene_status(reference: DataFrame, assembly: DataFrame, kept: DataFrame | None = None, least: float = 0.99) -> DataFrame:
    """(gene, copies, status): how an assembly holds the genes (both gene_cover) that the reference holds; kept (gene) limits them. Genes that it
    holds once get one of GENE; of those that it holds more often the copies count only (status NULL)."""
    genes = reference.where("whole >= 1").select("gene", F.col("whole").alias("held"))
    genes = genes.join(kept.select("gene").distinct(), "gene", "left_semi") if kept is not None else genes
    x = genes.join(assembly, "gene", "left")
    n, share = F.coalesce("whole", F.lit(0)), F.coalesce("share", F.lit(0.0))
    status = F.when(n == 1, GENE[0]).when(n > 1, GENE[1]).when(share >= least, GENE[2]).when(share >= 0.5, GENE[3]).when(share >= 0.1, GENE[4]).otherwise(GENE[5])
    return x.select("gene", n.alias("copies"), F.when(F.col("held") == 1, status).alias("status"))


def gene_counts(status: DataFrame) -> DataFrame:
    """(metric, n): how many genes have each status; dup_cnt of the genes that the reference holds more often are held more than once, as
    dup_sum copies."""
    each = status.where("status IS NOT NULL").groupBy(F.col("status").alias("metric")).agg(F.count("*").alias("n"))
    more = status.where("status IS NULL").agg(F.count_if(F.col("copies") > 1).alias("dup_cnt"), F.coalesce(F.sum("copies"), F.lit(0)).alias("dup_sum"))
    return each.unionByName(more.select(F.expr("stack(2, 'dup_cnt', dup_cnt, 'dup_sum', dup_sum) AS (metric, n)")))


def alignment_stats(paf: DataFrame) -> DataFrame:
    """(queries, primary, secondary, long_cigars, length, covered, subs) of alignments (qname, qlen, qs, qe, cg, nm, nn, s2): those without s2 are secondary
    and only counted. Substitutions are NM less gaps and unknown letters, never below 0."""
    rows = paf.where("s2 IS NOT NULL AND cg IS NOT NULL")
    subs = F.greatest(F.lit(0), F.col("nm") - cigar.total(F.col("cg"), "ID") - F.coalesce("nn", F.lit(0)))
    own = rows.agg(F.count("*").alias("primary"), F.count_if(F.size(cigar.ops(F.col("cg"))) > 65_535).alias("long_cigars"), F.coalesce(F.sum(subs), F.lit(0)).alias("subs"))
    union = intervals.cov_union(rows.select("qname", F.col("qs").alias("st"), F.col("qe").alias("en")), ("qname",)).agg(F.coalesce(F.sum("covered"), F.lit(0)).alias("covered"))
    each = rows.groupBy("qname").agg(F.max("qlen").alias("l")).agg(F.count("*").alias("queries"), F.coalesce(F.sum("l"), F.lit(0)).alias("length"))
    out = own.join(F.broadcast(each)).join(F.broadcast(union)).join(F.broadcast(paf.agg(F.count_if(F.col("s2").isNull()).alias("secondary"))))  # one row each
    return out.select("queries", "primary", "secondary", "long_cigars", "length", "covered", "subs")


def gap_counts(alignments: DataFrame) -> DataFrame:
    """(op, under, n, letters): insertions and deletions of alignments (cg) by the limit their length is under; NULL beyond the last."""
    gaps = alignments.select(F.explode(F.filter(cigar.ops(F.col("cg")), lambda x: x["op"].isin("I", "D"))).alias("x"))
    return gaps.groupBy(F.col("x.op").alias("op"), cigar.gap_bucket(F.col("x.len")).alias("under")).agg(F.count("*").alias("n"), F.sum("x.len").alias("letters"))


def _ng(lengths: DataFrame, goal: float, name: str) -> DataFrame:
    """The length (counted: len, n) at which the running sum, largest first, passes the goal; NULL if it never does."""
    order = Window.orderBy(F.desc("len"))  # of distinct lengths
    ran = lengths.withColumn("run", F.sum(F.col("len") * F.col("n")).over(order))
    return ran.where(F.col("run") > goal).agg(F.max("len").alias(name))


def query_steps(paf: DataFrame) -> DataFrame:
    """(qname, length, gap) of alignments (qname, qs, qe, strand, tname, ts, te) that are not inside the one before them on their query, by qs:
    the length beyond the one before, and how much the query and target gaps to the last such one differ (10^9 on another target
    or strand; NULL for the first)."""
    order = Window.partitionBy("qname").orderBy("qs", "no")
    prev = paf.withColumn("pe", F.lag("qe").over(order))
    kept = prev.where("pe IS NULL OR qs >= pe OR qe >= pe").withColumn("length", F.when(F.col("qs") < F.col("pe"), F.col("qe") - F.col("pe")).otherwise(F.col("qe") - F.col("qs")))
    last = F.lag(F.struct("qe", "strand", "tname", "ts", "te")).over(order)
    x = kept.withColumn("last", last)
    same = (F.col("last.strand") == F.col("strand")) & (F.col("last.tname") == F.col("tname"))
    # the rule compares the target's order with that of the plus strand only if the strand is named so
    dr = F.when(F.col("strand") == "+", F.col("ts") - F.col("last.te")).otherwise(F.col("last.ts") - F.col("te"))
    gap = F.when(same, F.abs(F.col("qs") - F.col("last.qe") - dr)).otherwise(1_000_000_000)
    return x.select("qname", "length", F.when(F.col("last").isNotNull(), gap).alias("gap"))


def assembly_stats(paf: DataFrame, ref_len: int, segment: int = 10_000, most: float = 0.01, query: int = 0) -> DataFrame:
    """One row of an assembly's alignments (qname, qlen, qs, qe, strand, tname, ts, te, type, cg, nm, no: the order of lines): length of the queries,
    covered (l_cov), rcov and rdup (percent of the reference covered, and of that covered more than once), qcov, ng75, ng50, nga50, aunga,
    breaks (further lines of a query after its first that counts), bp and bp10k (steps of 500 bases, and gaps of 10,000).

    Lines that count are primary, have `segment` query bases and a gap-compressed divergence of at most `most`."""
    # every part reads the lines again: they are put together, and their operations taken apart, once
    parsed = paf.where(F.col("qlen") >= query).withColumn("__ops", cigar.ops(F.col("cg")))
    gaps, opens = cigar.total_of(F.col("__ops"), "ID"), F.size(F.filter("__ops", lambda x: x["op"].isin("I", "D")))
    diff = F.coalesce(cigar.compressed_divergence(F.col("nm"), gaps, opens, cigar.total_of(F.col("__ops"), "M")), F.lit(0.0))
    counts = F.col("type").isin("P", "I") & (F.coalesce("tname", F.lit("*")) != "*")
    rows = settled(parsed.select("qname", "qlen", "qs", "qe", "strand", "tname", "ts", "te", "no", counts.alias("primary"), ((diff <= most) & (F.col("qe") - F.col("qs") >= segment)).alias("ok")), "lines")
    lengths = rows.groupBy("qname").agg(F.max_by("qlen", "no").alias("len"))
    counted = lengths.groupBy("len").agg(F.count("*").alias("n"))
    primary_rows = rows.where("primary").drop("primary")
    used = primary_rows.where("ok").drop("ok")
    first = used.groupBy("qname").agg(F.min("no").alias("first"))
    breaks = primary_rows.join(first, "qname").agg(F.count_if(F.col("no") > F.col("first")).alias("breaks"))
    target = used.select(F.col("tname").alias("contig"), F.col("ts").alias("st"), F.col("te").alias("en"))
    covered = intervals.cov_union(target).agg(F.coalesce(F.sum("covered"), F.lit(0)).alias("l_cov"))
    once = intervals.cov_once(target).agg(F.coalesce(F.sum("once"), F.lit(0)).alias("once"))
    on_query = intervals.cov_union(used.select(F.col("qname").alias("contig"), F.col("qs").alias("st"), F.col("qe").alias("en"))).agg(F.coalesce(F.sum("covered"), F.lit(0)).alias("q_cov"))
    steps = query_steps(used)
    blocks = steps.groupBy(F.col("length").alias("len")).agg(F.count("*").alias("n"))
    points = steps.agg(F.count_if((F.col("length") >= 500) & (F.col("gap") >= 0)).alias("bp"), F.count_if((F.col("length") >= 500) & (F.col("gap") >= 10_000)).alias("bp10k"))
    order = Window.orderBy(F.desc("len"))
    left = F.greatest(F.lit(0), F.lit(ref_len) - F.coalesce(F.sum(F.col("len") * F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    whole = F.least("n", F.floor(left / F.greatest(F.col("len"), F.lit(1))))
    rest = F.when(whole < F.col("n"), left - whole * F.col("len")).otherwise(0)
    aunga = blocks.select("len", whole.alias("w"), rest.alias("r")).agg(F.round(F.sum((F.col("w") * F.col("len") * F.col("len") + F.col("r") * F.col("r")).cast("double") / ref_len)).alias("aunga"))
    one = lengths.agg(F.sum("len").alias("length"))
    for part in (covered, once, on_query, _ng(counted, 0.75 * ref_len, "ng75"), _ng(counted, 0.5 * ref_len, "ng50"), _ng(blocks, 0.5 * ref_len, "nga50"), aunga, breaks, points):
        one = one.join(F.broadcast(part))  # each is one row
    percent = lambda a, b: F.round(F.try_divide(100.0 * a, b), 2)
    return one.select(
        "length", "l_cov", percent(F.col("l_cov"), F.lit(ref_len)).alias("rcov"), percent(F.col("l_cov") - F.col("once"), F.col("l_cov")).alias("rdup"), percent(F.col("q_cov"), F.col("length")).alias("qcov"),
        "ng75", "ng50", "nga50", "aunga", "breaks", "bp", "bp10k",
    )
