"""The queries over the driver's tables and their SQL. Each applies one operator to derived views (plans.views)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.functions import cigar, interval, seq, variants
from genoweave.operators import fusing, blocks, folds, intervals, kernels, multi, nets, posmap
from genoweave.operators.lineage import any_settled, dealt, settled, tidy
from genoweave.plans import annotate as annotation
from genoweave.plans import assess, calls, genotype, snp, tables
from genoweave.plans.views import register, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, views: str, sql: str | None = None):
    """Registers a function of the named views as a query, with its SQL over the same views."""

    def keep(f: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with tidy() as results:
                found = f(*register(spark, sf_dir, *views.split()).values())
                if any_settled():  # what it reads goes with the query's other tables
                    found = settled(found, name)
                    results.append(found)
            return found

        QUERIES[name] = run
        if sql:
            ORACLE[name] = with_views(sql, *views.split())
        return f

    return keep


# ---- intervals


@query("overlap_join", "v_iv v_feat", """
    SELECT f.id AS feat, count(*) AS n, CAST(sum(least(i.en, f.en) - greatest(i.st, f.st)) AS BIGINT) AS shared
    FROM v_iv i JOIN v_feat f ON i.contig = f.contig AND i.st < f.en AND f.st < i.en GROUP BY f.id""")
def _(iv: DataFrame, feat: DataFrame) -> DataFrame:
    both = intervals.overlap_join(iv.select("contig", "st", "en"), feat.select("contig", F.col("id").alias("feat"), F.col("st").alias("b_st"), F.col("en").alias("b_en")))
    return both.groupBy("feat").agg(F.count("*").alias("n"), F.sum(F.least("en", "b_en") - F.greatest("st", "b_st")).alias("shared"))


@query("overlap_self", "v_iv", """
    SELECT a.contig, count(*) AS pairs, CAST(sum(least(a.en, b.en) - greatest(a.st, b.st)) AS BIGINT) AS shared
    FROM v_iv a JOIN v_iv b ON a.contig = b.contig AND a.id < b.id AND a.st < b.en AND b.st < a.en GROUP BY a.contig""")
def _(iv: DataFrame) -> DataFrame:
    pairs = intervals.overlap_join(iv.select("contig", "id", "st", "en"), iv.select("contig", F.col("id").alias("b_id"), F.col("st").alias("b_st"), F.col("en").alias("b_en"))).where("id < b_id")
    return pairs.groupBy("contig").agg(F.count("*").alias("pairs"), F.sum(F.least("en", "b_en") - F.greatest("st", "b_st")).alias("shared"))


@query("overlap_mixed", "v_iv v_feat", """
    WITH i AS (SELECT DISTINCT id, contig, st, CASE WHEN qty = 50 THEN st + line * 2000 WHEN qty > 45 THEN st + line * 300 ELSE en END AS en FROM v_iv)
    SELECT f.id AS feat, count(*) AS n, CAST(sum(least(i.en, f.en) - greatest(i.st, f.st)) AS BIGINT) AS shared FROM i JOIN v_feat f ON i.contig = f.contig AND i.st < f.en AND f.st < i.en GROUP BY f.id""")
def _(iv: DataFrame, feat: DataFrame) -> DataFrame:
    """Intervals from a few to 14,000 positions long, met by bins of several sizes."""
    end = F.when(F.col("qty") == 50, F.col("st") + F.col("line") * 2000).when(F.col("qty") > 45, F.col("st") + F.col("line") * 300).otherwise(F.col("en"))
    mixed = iv.dropDuplicates(["id"]).select("contig", "st", end.alias("en"))
    both = intervals.overlap_join(mixed, feat.select("contig", F.col("id").alias("feat"), F.col("st").alias("b_st"), F.col("en").alias("b_en")), None)
    return both.groupBy("feat").agg(F.count("*").alias("n"), F.sum(F.least("en", "b_en") - F.greatest("st", "b_st")).alias("shared"))


@query("overlap_semi", "v_feat v_sp", """
    SELECT f.id, f.contig, f.st, f.en FROM v_feat f WHERE EXISTS (SELECT 1 FROM v_sp i WHERE i.contig = f.contig AND i.st < f.en AND f.st < i.en)""")
def _(feat: DataFrame, iv: DataFrame) -> DataFrame:
    return intervals.overlap_semi(feat, iv).select("id", "contig", "st", "en")


@query("overlap_anti", "v_feat v_sp", """
    SELECT f.id, f.contig, f.st, f.en FROM v_feat f WHERE NOT EXISTS (SELECT 1 FROM v_sp i WHERE i.contig = f.contig AND i.st < f.en AND f.st < i.en)""")
def _(feat: DataFrame, iv: DataFrame) -> DataFrame:
    return intervals.overlap_anti(feat, iv).select("id", "contig", "st", "en")


ISLANDS = """r AS (SELECT contig, st, en, max(en) OVER (PARTITION BY contig ORDER BY st, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM src),
    g AS (SELECT *, sum(CASE WHEN reach IS NULL OR st > reach THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY st, en ROWS UNBOUNDED PRECEDING) AS island FROM r),
    m AS (SELECT contig, min(st) AS st, max(en) AS en FROM g GROUP BY contig, island)"""
SWEEP = """e AS (SELECT contig, st AS pos, 1 AS d FROM src UNION ALL SELECT contig, en, -1 FROM src), s AS (SELECT contig, pos, sum(d) AS d FROM e GROUP BY contig, pos),
    runs AS (SELECT contig, pos AS st, lead(pos) OVER (PARTITION BY contig ORDER BY pos) AS en, CAST(sum(d) OVER (PARTITION BY contig ORDER BY pos) AS BIGINT) AS depth FROM s)"""
SRC = "src AS (SELECT contig, st, en FROM v_sp)"


@query("interval_merge", "v_sp", f"WITH {SRC}, {ISLANDS} SELECT contig, st, en FROM m")
def _(iv: DataFrame) -> DataFrame:
    return intervals.merge_intervals(iv)


@query("cov_union", "v_sp", f"WITH {SRC}, {ISLANDS} SELECT contig, CAST(sum(en - st) AS BIGINT) AS covered FROM m GROUP BY contig")
def _(iv: DataFrame) -> DataFrame:
    return intervals.cov_union(iv)


@query("cov_once", "v_sp", f"WITH {SRC}, {SWEEP} SELECT contig, CAST(sum(CASE WHEN depth = 1 THEN en - st ELSE 0 END) AS BIGINT) AS once FROM runs WHERE depth > 0 AND en IS NOT NULL GROUP BY contig")
def _(iv: DataFrame) -> DataFrame:
    return intervals.cov_once(iv)


@query("depth_runs", "v_sp", f"WITH {SRC}, {SWEEP} SELECT contig, depth, count(*) AS runs, CAST(sum(en - st) AS BIGINT) AS positions FROM runs WHERE depth > 0 AND en IS NOT NULL GROUP BY contig, depth")
def _(iv: DataFrame) -> DataFrame:
    return intervals.depth_runs(iv).groupBy("contig", "depth").agg(F.count("*").alias("runs"), F.sum(F.col("en") - F.col("st")).alias("positions"))


@query("interval_gaps", "v_sp", f"WITH {SRC}, {ISLANDS}, n AS (SELECT contig, en AS st, lead(st) OVER (PARTITION BY contig ORDER BY st) AS nx FROM m) SELECT contig, st, nx AS en FROM n WHERE nx IS NOT NULL")
def _(iv: DataFrame) -> DataFrame:
    return intervals.gaps(iv)


@query("bed_coverage", "v_feat v_sp", f"""
    WITH {SRC}, {ISLANDS} SELECT f.id, f.en - f.st AS length, CAST(coalesce(sum(CASE WHEN m.st IS NOT NULL THEN least(f.en, m.en) - greatest(f.st, m.st) END), 0) AS BIGINT) AS covered, count(m.st) AS hits
    FROM v_feat f LEFT JOIN m ON m.contig = f.contig AND m.st < f.en AND f.st < m.en GROUP BY f.id, f.en - f.st""")
def _(feat: DataFrame, iv: DataFrame) -> DataFrame:
    return intervals.bed_coverage(feat, iv)


@query("nx_length", "v_iv", """
    WITH c AS (SELECT contig, en - st AS len, count(*) AS n FROM v_iv GROUP BY 1, 2),
    r AS (SELECT contig, len, sum(len * n) OVER (PARTITION BY contig ORDER BY len DESC) AS run, sum(len * n) OVER (PARTITION BY contig) AS total FROM c)
    SELECT contig, max(len) AS nx FROM r WHERE run >= 0.5 * total GROUP BY contig""")
def _(iv: DataFrame) -> DataFrame:
    return intervals.nx(iv.select("contig", (F.col("en") - F.col("st")).alias("len")), 0.5, ("contig",))


@query("aun", "v_iv", "SELECT contig, round(CAST(sum((en - st) * (en - st)) AS DOUBLE) / CAST(sum(en - st) AS DOUBLE), 6) AS aun FROM v_iv GROUP BY contig")
def _(iv: DataFrame) -> DataFrame:
    return intervals.aun(iv.select("contig", (F.col("en") - F.col("st")).alias("len")), ("contig",)).select("contig", F.round("aun", 6).alias("aun"))


@query("gap_flanks", "v_iv", """
    SELECT id, st - coalesce(lag(en) OVER w, 0) AS five, coalesce(lead(st) OVER w, 100000000) - en AS three FROM v_iv WINDOW w AS (PARTITION BY contig, sample ORDER BY st, en, id)""")
def _(iv: DataFrame) -> DataFrame:
    wide = iv.select("id", "contig", "sample", "st", "en", F.lit(0).alias("lo"), F.lit(100_000_000).alias("hi"))
    return intervals.flanks(wide, ("contig", "sample"), "lo", "hi").select("id", "five", "three")


@query("gene_nr", "v_sp", """
    WITH r AS (SELECT id, contig, st, en, max(en) OVER (PARTITION BY contig ORDER BY st, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v_sp),
    g AS (SELECT *, sum(CASE WHEN reach IS NULL OR st >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY st, en ROWS UNBOUNDED PRECEDING) AS island FROM r)
    SELECT id, contig, st, en FROM (SELECT *, row_number() OVER (PARTITION BY contig, island ORDER BY en - st DESC, st, id) AS k FROM g) WHERE k = 1""")
def _(iv: DataFrame) -> DataFrame:
    return intervals.longest_of_overlapping(iv.select("id", "contig", "st", "en"))


@query("split_windows", "v_iv", """
    WITH c AS (SELECT pkey AS contig, max(en) AS length FROM v_iv GROUP BY pkey), w AS (SELECT contig, length, unnest(range(0, CAST(floor(length / 9000.0) AS BIGINT) + 1)) AS no FROM c), s AS (SELECT *, CASE WHEN no = 0 THEN 0 ELSE no * 9000 - 300 END AS start FROM w)
    SELECT contig, CAST(no AS INTEGER) AS no, start, least(CASE WHEN no > length / 9000.0 - 1 THEN length ELSE start + 9300 END, length) AS stop FROM s""")
def _(iv: DataFrame) -> DataFrame:
    return intervals.split_windows(iv.groupBy(F.col("pkey").alias("contig")).agg(F.max("en").alias("length")), 9000, 300)


@query("top_by_key", "v_iv", "SELECT okey, id, en - st AS len FROM (SELECT *, row_number() OVER (PARTITION BY okey ORDER BY en - st DESC, id) AS k FROM v_iv) WHERE k = 1")
def _(iv: DataFrame) -> DataFrame:
    best = iv.groupBy("okey").agg(F.max_by(F.struct("id", (F.col("en") - F.col("st")).alias("len")), F.struct((F.col("en") - F.col("st")).alias("l"), F.translate("id", "0123456789abcdef", "fedcba9876543210"))).alias("x"))
    return best.select("okey", "x.id", "x.len")


@query("overlap_rules", "v_iv v_feat", """
    SELECT i.id, f.id AS feat, round(CASE WHEN i.st > f.en THEN 0.0 WHEN i.st >= f.st AND i.en <= f.en THEN CAST(i.en - i.st AS DOUBLE) / (f.en - f.st) WHEN i.st >= f.st THEN CAST(f.en - i.st AS DOUBLE) / (f.en - f.st) END, 6) AS frac,
        greatest(0, least(i.en, f.en) - greatest(i.st, f.st)) AS len, round(CAST(least(i.en, f.en) - greatest(i.st, f.st) + 1 AS DOUBLE) / (i.en - i.st + 1), 6) AS incl,
        (2 * greatest(0, least(i.en, f.en) - greatest(i.st, f.st)) > i.en - i.st) OR (2 * greatest(0, least(i.en, f.en) - greatest(i.st, f.st)) > f.en - f.st) AS half
    FROM v_iv i JOIN v_feat f ON i.okey = f.id""")
def _(iv: DataFrame, feat: DataFrame) -> DataFrame:
    j = iv.join(feat.select(F.col("id").alias("feat"), F.col("st").alias("f_st"), F.col("en").alias("f_en")), F.col("okey") == F.col("feat"))
    at = [F.col(c) for c in ("st", "en", "f_st", "f_en")]
    return j.select("id", "feat", F.round(interval.overlap_frac(*at), 6).alias("frac"), interval.overlap_len(*at).alias("len"), F.round(interval.overlap_incl(*at), 6).alias("incl"), interval.overlap_half(*at).alias("half"))


@query("flank_buckets", "v_iv", """
    SELECT id, len, CASE WHEN len <= 100 THEN 100 WHEN len < 500 THEN 200 WHEN len < 2000 THEN 500 WHEN len < 5000 THEN 2000 ELSE 5000 END AS del_flank,
        CASE WHEN len < 1000 THEN 100 WHEN len < 5000 THEN 500 ELSE 800 END AS ins_flank, CASE WHEN len < 50 THEN 'small' WHEN len < 100000 THEN 'large' END AS class
    FROM (SELECT id, (en - st) * 30 AS len FROM v_iv)""")
def _(iv: DataFrame) -> DataFrame:
    n = F.col("len")
    return iv.select("id", ((F.col("en") - F.col("st")) * 30).alias("len")).select("id", "len", interval.flank_bucket_del(n).alias("del_flank"), interval.flank_bucket_ins(n).alias("ins_flank"), interval.size_class(n).alias("class"))


@query("flank_windows", "v_iv", """
    SELECT id, st - least(qty * 30, 1000) + 5 AS d_beg, en + (CASE WHEN line * 400 > 1000 THEN 1000 ELSE line * 400 END) - 5 AS d_end,
        st - (CASE WHEN qty * 30 >= 500 THEN 500 ELSE qty * 30 - 5 END) AS i_beg, en + (CASE WHEN line * 400 >= 500 THEN 500 ELSE line * 400 - 5 END) AS i_end FROM v_iv""")
def _(iv: DataFrame) -> DataFrame:
    five, three = F.col("qty") * 30, F.col("line") * 400
    d = interval.flank_window_del(F.col("st"), F.col("en"), five, three, F.lit(1000))
    i = interval.flank_window_ins(F.col("st"), F.col("en"), five, three, F.lit(500))
    return iv.select("id", d["beg0"].alias("d_beg"), d["end0"].alias("d_end"), i["beg0"].alias("i_beg"), i["end0"].alias("i_end"))


@query("asof_position", "v_pt v_feat", """
    WITH p AS (SELECT id, concat('c', CAST(user_id % 8 AS string)) AS contig, id * 13 % 100000 AS pos FROM v_pt), m AS (SELECT contig, st AS pos, max(id) AS mark FROM v_feat GROUP BY 1, 2)
    SELECT p.id, p.contig, p.pos, CASE WHEN p.pos - m.pos <= 500 THEN m.pos END AS mark_pos, CASE WHEN p.pos - m.pos <= 500 THEN m.mark END AS mark FROM p ASOF LEFT JOIN m ON p.contig = m.contig AND p.pos >= m.pos""")
def _(pt: DataFrame, feat: DataFrame) -> DataFrame:
    points = pt.select("id", F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string")).alias("contig"), (F.col("id") * 13 % 100_000).alias("pos"))
    return posmap.asof(points, feat.select("contig", F.col("st").alias("pos"), F.col("id").alias("mark")), bound=500)


# ---- sequences


@query("revcomp", "v_seq", "SELECT contig, reverse(translate(seq, 'ACGTNacgtn', 'TGCANtgcan')) AS rc FROM v_seq")
def _(seqs: DataFrame) -> DataFrame:
    return seqs.select("contig", seq.revcomp(F.col("seq")).alias("rc"))


@query("strand_flip", "v_blk", "SELECT block, q_size - (q_start + length(replace(q_text, '-', ''))) AS flipped FROM v_blk")
def _(blk: DataFrame) -> DataFrame:
    return blk.select("block", seq.strand_flip(F.col("q_start"), F.length(F.replace("q_text", F.lit("-"), F.lit(""))), F.col("q_size")).alias("flipped"))


@query("kmer_frac", "v_seq", """
    SELECT contig, round(CAST(len(list_filter(range(1, 10), lambda i: contains(substring(seq, 11, 22), substring(seq, i, 4)))) AS DOUBLE) / 9, 6) AS frac FROM v_seq""")
def _(seqs: DataFrame) -> DataFrame:
    return seqs.select("contig", F.round(seq.kmer_frac(F.substring("seq", 1, 12), F.substring("seq", 11, 22), 4), 6).alias("frac"))


@query("dup_class", "v_seq", """
    WITH p AS (SELECT contig, substring(seq, 1, 10) AS s, substring(seq, 6, 14) AS f5, substring(seq, 3, 20) AS f3 FROM v_seq),
    k AS (SELECT contig, s, f5, f3, reverse(translate(s, 'ACGTNacgtn', 'TGCANtgcan')) AS rc FROM p),
    n AS (SELECT contig, len(list_filter(range(1, 8), lambda i: contains(f5, substring(s, i, 4)))) AS a, len(list_filter(range(1, 8), lambda i: contains(f3, substring(s, i, 4)))) AS b,
        len(list_filter(range(1, 8), lambda i: contains(f5, substring(rc, i, 4)))) AS c, len(list_filter(range(1, 8), lambda i: contains(f3, substring(rc, i, 4)))) AS d FROM k)
    SELECT contig, CASE WHEN greatest(a, b) > 3.5 THEN CASE WHEN a > b THEN '5DUP' ELSE '3DUP' END WHEN greatest(c, d) > 3.5 THEN CASE WHEN c > d THEN '5INVDUP' ELSE '3INVDUP' END ELSE 'NONDUP' END AS class FROM n""")
def _(seqs: DataFrame) -> DataFrame:
    return seqs.select("contig", seq.dup_class(F.substring("seq", 1, 10), F.substring("seq", 6, 14), F.substring("seq", 3, 20), 4).alias("class"))


@query("pair_score", "v_blk", """
    WITH c AS (SELECT block, unnest(string_split(t_text, '')) AS t, unnest(string_split(q_text, '')) AS q, unnest(range(0, 32)) AS i FROM v_blk),
    s AS (SELECT *, CASE WHEN t = '-' AND q = '-' THEN NULL WHEN t = '-' THEN 1 WHEN q = '-' THEN 2 ELSE 0 END AS g FROM c),
    l AS (SELECT *, coalesce(lag(g IGNORE NULLS) OVER (PARTITION BY block ORDER BY i), 0) AS before FROM s)
    SELECT block, CAST(sum(CASE WHEN g IS NULL THEN 0 WHEN g > 0 THEN -30 - (CASE WHEN before = g THEN 0 ELSE 400 END)
        WHEN t = q THEN CASE WHEN t IN ('A', 'T') THEN 91 ELSE 100 END WHEN t || q IN ('AC', 'CA', 'GT', 'TG') THEN -114 WHEN t || q IN ('AG', 'GA', 'CT', 'TC') THEN -31
        WHEN t || q IN ('AT', 'TA') THEN -123 ELSE -125 END) AS INTEGER) AS score FROM l GROUP BY block""")
def _(blk: DataFrame) -> DataFrame:
    return blk.select("block", seq.pair_score(F.col("t_text"), F.col("q_text")).alias("score"))


@query("pos_to_col", "v_blk", """
    WITH c AS (SELECT block, unnest(string_split(t_text, '')) AS t, unnest(range(0, 32)) AS i FROM v_blk), n AS (SELECT block, i, row_number() OVER (PARTITION BY block ORDER BY i) AS k FROM c WHERE t <> '-')
    SELECT b.block, CAST(n.i AS INTEGER) AS col, length(replace(substring(b.t_text, 1, 10), '-', '')) AS bases FROM v_blk b LEFT JOIN n ON n.block = b.block AND n.k = b.block % 33 + 1""")
def _(blk: DataFrame) -> DataFrame:
    return blk.select("block", seq.pos_to_col(F.col("t_text"), F.col("t_start"), F.col("t_start") + F.col("block") % 33).alias("col"), seq.bases_before(F.col("t_text"), F.lit(10)).alias("bases"))


# ---- blocks and genotypes

COLS = """c AS (SELECT block, contig, sample, q_contig, q_strand, q_size, t_start, q_start, unnest(string_split(t_text, '')) AS t, unnest(string_split(q_text, '')) AS q, unnest(range(0, 32)) AS i FROM v_blk),
    p AS (SELECT *, t_start + sum(CASE WHEN t <> '-' THEN 1 ELSE 0 END) OVER w - (CASE WHEN t <> '-' THEN 1 ELSE 0 END) AS tp, q_start + sum(CASE WHEN q <> '-' THEN 1 ELSE 0 END) OVER w - (CASE WHEN q <> '-' THEN 1 ELSE 0 END) AS qp
        FROM c WINDOW w AS (PARTITION BY block ORDER BY i ROWS UNBOUNDED PRECEDING))"""
MAP = COLS + """, a AS (SELECT contig, sample, q_contig AS q_name, CAST(tp AS BIGINT) AS tp, CAST(CASE WHEN q_strand = '-' THEN q_size - 1 - qp ELSE qp END AS BIGINT) AS qq, q_strand FROM p WHERE t <> '-' AND q <> '-')"""


@query("posmap_runs", "v_blk", f"""
    WITH {COLS}, a AS (SELECT *, i - row_number() OVER (PARTITION BY block ORDER BY i) AS run FROM p WHERE t <> '-' AND q <> '-')
    SELECT sample, contig, CAST(min(tp) AS BIGINT) AS t_from, CAST(max(tp) AS BIGINT) AS t_to, q_contig AS q_name, CAST(CASE WHEN q_strand = '-' THEN q_size - 1 - min(qp) ELSE min(qp) END AS BIGINT) AS q_from, CASE WHEN q_strand = '-' THEN -1 ELSE 1 END AS step
    FROM a GROUP BY block, run, sample, contig, q_contig, q_strand, q_size""")
def _(blk: DataFrame) -> DataFrame:
    return posmap.position_runs(blk)


@query("genotype_indel", "v_blk v_indel", f"""
    WITH {MAP}, k AS (SELECT contig, sample, tp + 2 AS pos, CASE WHEN q_strand = '-' THEN qq ELSE qq + 2 END AS q FROM a),
    v AS (SELECT *, CASE WHEN kind = 'DEL' THEN beg ELSE beg - 2 END AS lo, fin + 2 AS hi FROM v_indel), s AS (SELECT DISTINCT sample FROM v_blk),
    g AS (SELECT v.contig, v.beg, v.fin, v.len, v.kind, x.sample, abs(y.q - x.q) AS d FROM v JOIN k x ON x.contig = v.contig AND x.pos = v.lo JOIN k y ON y.contig = v.contig AND y.pos = v.hi AND y.sample = x.sample),
    t AS (SELECT contig, beg, fin, len, kind, sample, CASE WHEN kind = 'DEL' THEN CASE WHEN d = len + 2 THEN '0|0' WHEN d <= 2 THEN '1|1' ELSE '.|.' END ELSE CASE WHEN d = len + 4 THEN '1|1' WHEN d <= 4 THEN '0|0' ELSE '.|.' END END AS gt FROM g)
    SELECT v.contig, v.beg, v.fin, v.len, v.kind, coalesce(max(CASE WHEN sample = 'S0' THEN gt END), '.|.') AS S0, coalesce(max(CASE WHEN sample = 'S1' THEN gt END), '.|.') AS S1, coalesce(max(CASE WHEN sample = 'S2' THEN gt END), '.|.') AS S2,
        coalesce(max(CASE WHEN sample = 'S3' THEN gt END), '.|.') AS S3, coalesce(max(CASE WHEN sample = 'S4' THEN gt END), '.|.') AS S4, coalesce(max(CASE WHEN sample = 'S5' THEN gt END), '.|.') AS S5
    FROM v_indel v LEFT JOIN t ON t.contig = v.contig AND t.beg = v.beg AND t.fin = v.fin AND t.len = v.len AND t.kind = v.kind GROUP BY v.contig, v.beg, v.fin, v.len, v.kind""")
def _(blk: DataFrame, indel: DataFrame) -> DataFrame:
    return genotype.indel_table(indel, posmap.position_runs(blk), [f"S{i}" for i in range(6)])


@query("snp_loci", "v_blk", f"WITH {COLS} SELECT DISTINCT contig, CAST(tp + 1 AS BIGINT) AS pos, upper(t) AS ref, upper(q) AS alt FROM p WHERE t <> '-' AND q <> '-' AND upper(t) <> upper(q)")
def _(blk: DataFrame) -> DataFrame:
    return snp.loci(posmap.aligned_runs(blk))


@query("snp_frequency", "v_blk", f"""
    WITH {COLS}, b AS (SELECT contig, sample, CAST(tp + 1 AS BIGINT) AS pos, upper(t) AS ref, upper(q) AS base FROM p WHERE t <> '-' AND q <> '-'),
    l AS (SELECT DISTINCT contig, pos, ref, base AS alt FROM b WHERE ref <> base)
    SELECT l.contig, l.pos, l.ref, l.alt, count(b.base) AS ns, count_if(b.base = l.alt) AS ac, floor(100.0 * count_if(b.base = l.alt) / count(b.base) + 0.000000001) AS percent
    FROM l JOIN b ON b.contig = l.contig AND b.pos = l.pos AND b.ref = l.ref GROUP BY ALL""")
def _(blk: DataFrame) -> DataFrame:
    runs = settled(posmap.aligned_runs(blk), "runs")
    found = snp.loci(runs)
    return snp.frequencies(snp.bases(found, runs), found)


@query("snp_matrix", "v_blk", f"""
    WITH {COLS}, b AS (SELECT contig, sample, CAST(tp + 1 AS BIGINT) AS pos, upper(t) AS ref, upper(q) AS base FROM p WHERE t <> '-' AND q <> '-'),
    l AS (SELECT contig, pos, ref, list_sort(list(DISTINCT base)) AS alts FROM b WHERE ref <> base GROUP BY 1, 2, 3)
    SELECT l.contig, l.pos, l.ref, array_to_string(alts, ',') AS alt, coalesce(max(CASE WHEN sample = 'S0' THEN base END), '-') AS S0, coalesce(max(CASE WHEN sample = 'S1' THEN base END), '-') AS S1, coalesce(max(CASE WHEN sample = 'S2' THEN base END), '-') AS S2, coalesce(max(CASE WHEN sample = 'S3' THEN base END), '-') AS S3,
        coalesce(max(CASE WHEN sample = 'S4' THEN base END), '-') AS S4, coalesce(max(CASE WHEN sample = 'S5' THEN base END), '-') AS S5
    FROM l JOIN b ON b.contig = l.contig AND b.pos = l.pos AND b.ref = l.ref GROUP BY l.contig, l.pos, l.ref, alts""")
def _(blk: DataFrame) -> DataFrame:
    runs = settled(posmap.aligned_runs(blk), "runs")
    found = snp.loci(runs)
    return snp.matrix(snp.bases(found, runs), found, [f"S{i}" for i in range(6)])


@query("window_identity", "v_blk", f"""
    WITH {COLS}, w AS (SELECT block, tp - t_start AS o, t, q FROM p WHERE t <> '-')
    SELECT block, round(CAST(count_if(o < 10 AND upper(t) = upper(q)) AS DOUBLE) / (count_if(o < 10 AND q <> '-') + 1), 6) AS id5, round(CAST(count_if(o >= 10 AND o < 20 AND upper(t) = upper(q)) AS DOUBLE) / (count_if(o >= 10 AND o < 20) + 1), 6) AS region,
        round(CAST(count_if(o >= 20 AND upper(t) = upper(q)) AS DOUBLE) / (count_if(o >= 20 AND q <> '-') + 1), 6) AS id3 FROM w GROUP BY block""")
def _(blk: DataFrame) -> DataFrame:
    w = genotype.window_identity(blk, F.lit(10), F.lit(20))
    return w.select("block", *[F.round(c, 6).alias(c) for c in ("id5", "region", "id3")])


@query("carrier_shortcut", "v_iv", """
    SELECT pkey, list_contains(list(DISTINCT sample), 'S' || CAST(pkey % 6 AS string)) AS carrier FROM v_iv GROUP BY pkey""")
def _(iv: DataFrame) -> DataFrame:
    members = iv.groupBy("pkey").agg(F.collect_set(F.concat("sample", F.lit(".x"))).alias("m"))
    return members.select("pkey", variants.carries(F.col("m"), F.concat(F.lit("S"), (F.col("pkey") % 6).cast("string"))).alias("carrier"))


@query("genotype_inv", "v_feat v_iv", """
    WITH x AS (SELECT f.id, i.sample, i.line % 2 AS q, i.strand, greatest(0, least(i.en, f.st) - greatest(i.st, f.st - 100)) AS a, greatest(0, least(i.en, f.en) - greatest(i.st, f.st)) AS b, greatest(0, least(i.en, f.en + 100) - greatest(i.st, f.en)) AS c
        FROM v_feat f JOIN v_iv i ON i.contig = f.contig AND i.st < f.en + 100 AND f.st - 100 < i.en WHERE i.sample <> 'S' || CAST(f.id % 6 AS string)),
    s AS (SELECT id, sample, q, sum(b) AS inner_len, sum(CASE WHEN strand = '-' THEN a ELSE 0 END) / CAST(sum(CASE WHEN strand = '+' THEN a ELSE 0 END) + 1 AS DOUBLE) AS r5, sum(CASE WHEN strand = '-' THEN b ELSE 0 END) / CAST(sum(CASE WHEN strand = '+' THEN b ELSE 0 END) + 1 AS DOUBLE) AS ri,
        sum(CASE WHEN strand = '-' THEN c ELSE 0 END) / CAST(sum(CASE WHEN strand = '+' THEN c ELSE 0 END) + 1 AS DOUBLE) AS r3 FROM x GROUP BY id, sample, q),
    t AS (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY inner_len DESC, q) AS k FROM s)
    SELECT id, sample, 'q' || CAST(q AS string) AS q_name, CASE WHEN r5 > 5 AND ri > 5 AND r3 > 5 THEN '0|0' WHEN r5 > 5 AND ri < 0.2 AND r3 > 5 THEN '1|1' WHEN r5 < 0.2 AND ri < 0.2 AND r3 < 0.2 THEN '0|0' WHEN r5 < 0.2 AND ri > 5 AND r3 < 0.2 THEN '1|1' ELSE '.|.' END AS gt FROM t WHERE k = 1
    UNION ALL SELECT id, 'S' || CAST(id % 6 AS string), NULL, '1|1' FROM v_feat""")
def _(feat: DataFrame, iv: DataFrame) -> DataFrame:
    held = feat.withColumn("members", F.array(F.concat(F.lit("S"), (F.col("id") % 6).cast("string"), F.lit(".c"))))
    return genotype.genotype_inv(held, iv.select("contig", "st", "en", "strand", "sample", F.concat(F.lit("q"), (F.col("line") % 2).cast("string")).alias("q_name")), bin_size=512)


@query("genotype_del", "v_blk v_indel", f"""
    WITH {MAP}, k AS (SELECT contig, sample, tp + 2 AS pos, CASE WHEN q_strand = '-' THEN qq ELSE qq + 2 END AS q FROM a), v AS (SELECT * FROM v_indel WHERE kind = 'DEL'), ca AS (SELECT contig, beg, fin, len, kind, 'S' || CAST(beg % 6 AS string) AS sample FROM v),
    e AS (SELECT v.contig, v.beg, v.fin, v.len, v.kind, x.sample, abs(y.q - x.q) - 6 AS span FROM v JOIN k x ON x.contig = v.contig AND x.pos = v.beg - 3 JOIN k y ON y.contig = v.contig AND y.pos = v.fin + 3 AND y.sample = x.sample),
    s AS (SELECT contig, beg, fin, len, kind, sample, CASE WHEN span < 2 THEN '1|1' WHEN span > len - 2 AND span < len + 2 THEN '0|0' ELSE '.|.' END AS gt FROM e WHERE span < 2 OR (span > len - 2 AND span < len + 2) OR span > 200000),
    w AS (SELECT v.contig, v.beg, v.fin, v.len, v.kind, p.sample, count_if(tp < beg - 1 AND q <> '-') AS h5, count_if(tp < beg - 1 AND q = t) AS m5, count_if(tp >= beg - 1 AND tp < fin AND q = t) AS mr,
        count_if(tp >= fin AND q <> '-') AS h3, count_if(tp >= fin AND q = t) AS m3, beg - 1 - greatest(0, beg - 9) AS n5
        FROM v JOIN v_blk b ON b.contig = v.contig AND b.t_start < v.fin + 8 AND b.t_start + 32 > v.beg - 9 JOIN p ON p.block = b.block AND p.t <> '-' AND p.tp >= greatest(0, v.beg - 9) AND p.tp < v.fin + 8
        GROUP BY v.contig, v.beg, v.fin, v.len, v.kind, p.sample),
    f AS (SELECT *, CAST(m5 AS DOUBLE) / (h5 + 1) >= 0.9 AND CAST(m3 AS DOUBLE) / (h3 + 1) >= 0.9 AND CAST(h5 AS DOUBLE) / (n5 + 1) >= 0.2 AND CAST(h3 AS DOUBLE) / 9 >= 0.2 AS flanks, CAST(mr AS DOUBLE) / (fin - beg + 2) AS region FROM w)
    SELECT *, '1|1' AS gt FROM ca UNION ALL SELECT * FROM s ANTI JOIN ca USING (contig, beg, fin, len, kind, sample) UNION ALL SELECT contig, beg, fin, len, kind, sample, CASE WHEN flanks AND region >= 0.5 THEN '0|0' WHEN flanks AND region < 0.1 THEN '1|1' ELSE '.|.' END
    FROM f ANTI JOIN s USING (contig, beg, fin, len, kind, sample) ANTI JOIN ca USING (contig, beg, fin, len, kind, sample)""")
def _(blk: DataFrame, indel: DataFrame) -> DataFrame:
    held = indel.where("kind = 'DEL'").withColumns({"five": F.lit(8), "three": F.lit(8), "members": F.array(F.concat(F.lit("S"), (F.col("beg") % 6).cast("string"), F.lit(".x")))})
    return genotype.genotype_deletions(held, blk, slack=2, flank=F.lit(8))


@query("genotype_ins", "v_blk v_indel", f"""
    WITH {COLS}, k AS (SELECT block, contig, sample, tp + 2 AS pos, CASE WHEN q_strand = '-' THEN CAST(q_size - 1 - qp AS BIGINT) ELSE CAST(qp + 2 AS BIGINT) END AS q, q_contig FROM p WHERE t <> '-' AND q <> '-'),
    v AS (SELECT *, 'S' || CAST(beg % 6 AS string) AS giver FROM v_indel WHERE kind = 'INS'),
    lo AS (SELECT v.contig, v.beg, v.fin, v.len, v.kind, k.sample, min(struct_pack(pos := k.pos, n := k.q_contig, q := k.q)) AS x FROM v JOIN k ON k.contig = v.contig AND k.pos BETWEEN v.beg - 3 AND v.beg WHERE k.sample <> v.giver GROUP BY 1, 2, 3, 4, 5, 6),
    hi AS (SELECT v.contig, v.beg, v.fin, v.len, v.kind, k.sample, max(struct_pack(pos := k.pos, n := k.q_contig, q := k.q)) AS x FROM v JOIN k ON k.contig = v.contig AND k.pos BETWEEN v.fin AND v.fin + 3 WHERE k.sample <> v.giver GROUP BY 1, 2, 3, 4, 5, 6),
    g AS (SELECT contig, beg, fin, len, kind, sample, lo.x AS a, hi.x AS b, abs(hi.x.q - lo.x.q) - 6 AS span FROM lo JOIN hi USING (contig, beg, fin, len, kind, sample))
    SELECT contig, beg, fin, len, kind, sample, CASE WHEN span < 2 THEN '0|0' WHEN span > 200000 OR a.n <> b.n OR a.q = b.q THEN '.|.' ELSE 'window' END AS gt FROM g""")
def _(blk: DataFrame, indel: DataFrame) -> DataFrame:
    wide = indel.where("kind = 'INS'").withColumns({"five": F.lit(8), "three": F.lit(8)})
    giver = wide.select(*genotype.KEY, F.concat(F.lit("S"), (F.col("beg") % 6).cast("string")).alias("sample"))
    return genotype.genotype_ins(wide, posmap.position_runs(dealt(blk)), slack=2).join(giver, [*genotype.KEY, "sample"], "left_anti")


@query("genotype_insertions", "v_blk v_indel")
def _(blk: DataFrame, indel: DataFrame) -> DataFrame:
    held = indel.where("kind = 'INS'").withColumns({"five": F.lit(8), "three": F.lit(8), "giver": F.concat(F.lit("S"), (F.col("beg") % 6).cast("string"))})
    held = held.withColumns({"members": F.array(F.concat("giver", F.lit(".q"))), "query": F.concat("giver", F.lit(".q")), "q_st": F.col("beg") % 1000 + 200, "q_en": F.col("beg") % 1000 + 200 + F.col("len")})
    # letters of the samples: each contig repeats a digest of its name
    text = lambda *c: F.repeat(F.translate(F.md5(F.concat(*c)), "0123456789abcdef", "ACGTACGTACGTACGT"), 64)
    own = blk.select("sample", F.col("q_contig").alias("contig")).distinct().withColumn("seq", text(F.col("sample"), F.col("contig")))
    given = held.select(F.col("giver").alias("sample"), F.col("query").alias("contig")).distinct().withColumn("seq", text(F.col("contig")))
    return genotype.genotype_insertions(held.drop("giver"), posmap.position_runs(dealt(blk)), own.unionByName(given), slack=2)


@query("threading", "v_multi", """
    SELECT sample, contig, count_if(t_start < coalesce(prev, -1) + 1) AS clashes FROM (SELECT *, lag(t_start + length(replace(t_text, '-', '')) - 1) OVER (PARTITION BY sample, contig ORDER BY t_start) AS prev FROM v_multi) GROUP BY sample, contig""")
def _(blk: DataFrame) -> DataFrame:
    return assess.threading(blk)


@query("vcf_text", "v_indel", """
    SELECT contig, beg, concat_ws(chr(9), contig, CAST(beg AS string), concat('SV', CAST(beg AS string)), 'N', concat('<', kind, '>'), '22', 'PASS', concat('SVTYPE=', kind, ';END=', CAST(fin AS string), ';SVLEN=', CAST(len AS string)), 'GT:GQ') AS line FROM v_indel""")
def _(indel: DataFrame) -> DataFrame:
    return indel.select("contig", "beg", variants.sv_line(F.col("contig"), F.col("beg"), F.lit("N"), F.concat(F.lit("<"), "kind", F.lit(">")), F.col("kind"), F.col("fin"), F.col("len")).alias("line"))


@query("single_coverage", "v_multi")
def _(blk: DataFrame) -> DataFrame:
    """Every sample's blocks are an alignment of their own: its name is part of both contigs'."""
    own = blk.withColumns({c: F.concat("sample", F.lit("."), c) for c in ("contig", "q_contig")})
    return kernels.single_coverage(own).select("block", "contig", "t_start", "t_text", "q_contig", "q_start", "q_strand", "q_text", "score")


@query("global_align", "v_multi")
def _(blk: DataFrame) -> DataFrame:
    """The letters of both rows of every block, aligned anew."""
    plain = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(""))
    return kernels.global_align(blk.select("block", plain("t_text").alias("a"), plain("q_text").alias("b")))


# ---- nets

@query("net_filter", "v_top v_gap v_child", """
    WITH t AS (SELECT fill FROM v_top WHERE t_size > 500000 AND CAST(ali AS DOUBLE) / t_size > 0.1), g AS (SELECT gap FROM v_gap WHERE fill IN (SELECT fill FROM t)),
    c AS (SELECT child, gap FROM v_child WHERE gap IN (SELECT gap FROM g) AND CASE kind WHEN 'nonSyn' THEN t_len > 20000 AND CAST(ali AS DOUBLE) / t_len > 0.1 WHEN 'syn' THEN t_len > 10000 AND CAST(ali AS DOUBLE) / t_len > 0.1
        ELSE (t_len > 10000 AND CAST(ali AS DOUBLE) / t_len > 0.1 AND q_over > 0 AND q_far < 5000000) OR (t_len > 50000 AND q_len > 50000 AND q_far < t_len) END)
    SELECT 1 AS depth, fill AS node FROM t UNION ALL SELECT 2, gap FROM g UNION ALL SELECT 3, child FROM c""")
def _(top: DataFrame, gap: DataFrame, child: DataFrame) -> DataFrame:
    kept = nets.filter_synteny(assess.net_nodes(top, gap, child), nonsyn_len=20_000, syn_len=10_000)
    return kept.select("depth", F.split_part("node", F.lit(":"), F.lit(2)).cast("long").alias("node"))


@query("net_partners", "v_top v_gap v_child", """
    SELECT concat('n', CAST(t.net AS string)) AS net, array_to_string(list_sort(list(DISTINCT c.q_name)), ',') AS partners FROM v_child c JOIN v_gap g ON g.gap = c.gap JOIN v_top t ON t.fill = g.fill WHERE c.kind = 'nonSyn' GROUP BY t.net""")
def _(top: DataFrame, gap: DataFrame, child: DataFrame) -> DataFrame:
    nodes = assess.net_nodes(top, gap, child).where("depth = 3")
    return nets.paired_chromosomes(nodes).select("net", F.array_join("partners", ",").alias("partners"))


@query("gap_bed", "v_top v_gap v_child", "SELECT concat('n', CAST(t.net AS string)) AS contig, g.t_start AS st, g.t_start + g.t_len AS en FROM v_gap g JOIN v_top t ON t.fill = g.fill")
def _(top: DataFrame, gap: DataFrame, child: DataFrame) -> DataFrame:
    return nets.gap_bed(assess.net_nodes(top, gap, child))


SUMS = """s AS (SELECT g.gap, g.t_len, g.q_len, count(c.child) AS n, CAST(coalesce(sum(c.t_len), 0) AS BIGINT) AS total_cov, CAST(coalesce(sum(CASE WHEN c.kind IN ('syn', 'inv') AND c.q_far < 2 * g.t_len THEN c.ali END), 0) AS BIGINT) AS ali,
    CAST(coalesce(sum(CASE WHEN c.kind = 'inv' AND c.q_far < 2 * g.t_len THEN c.ali END), 0) AS BIGINT) AS inv_len, min(CASE WHEN c.kind IN ('syn', 'inv') AND c.q_far < 2 * g.t_len THEN c.q_start END) AS q_min,
    max(CASE WHEN c.kind IN ('syn', 'inv') AND c.q_far < 2 * g.t_len THEN c.q_start + c.q_len END) AS q_max FROM v_gap g LEFT JOIN v_child c ON c.gap = g.gap GROUP BY g.gap, g.t_len, g.q_len)"""


@query("gap_fills", "v_gap v_child", f"WITH {SUMS} SELECT * FROM s WHERE n > 0")
def _(gap: DataFrame, child: DataFrame) -> DataFrame:
    return nets.gap_fills(gap.select("gap", "t_len", "q_len"), child).where("n > 0").select("gap", "t_len", "q_len", "n", "total_cov", "ali", "inv_len", "q_min", "q_max")


@query("sv_class", "v_gap v_child", f"""
    WITH {SUMS} SELECT gap, CASE WHEN n = 0 THEN CASE WHEN t_len / (q_len + CAST(0.01 AS DOUBLE)) > 2 THEN 'DEL_PAV' ELSE 'CMPLX_PAV' END
        WHEN t_len / (q_len + CAST(0.1 AS DOUBLE)) > 2 AND inv_len > (q_len + t_len) / CAST(4 AS DOUBLE) AND inv_len > 500 THEN 'InvCNV'
        WHEN t_len / (q_len + CAST(0.1 AS DOUBLE)) > 2 AND CAST(ali AS DOUBLE) / t_len > 0.25 AND ali > 500 THEN 'CNV'
        WHEN t_len / (q_len + CAST(0.1 AS DOUBLE)) > 2 AND t_len <= 20000 THEN CASE WHEN CAST(total_cov AS DOUBLE) / t_len < 0.1 AND t_len > 10000 THEN 'DEL_PAV' ELSE 'DEL' END
        WHEN CAST(total_cov AS DOUBLE) / t_len < 0.1 AND t_len > 10000 THEN 'CMPLX_PAV' ELSE 'CMPLX' END AS svtype FROM s""")
def _(gap: DataFrame, child: DataFrame) -> DataFrame:
    s = nets.gap_fills(gap.select("gap", "t_len", "q_len"), child)
    return s.select("gap", nets.gap_class(*[F.col(c) for c in ("t_len", "q_len", "n", "total_cov", "ali", "inv_len")]).alias("svtype"))


@query("trl_class", "v_child", """
    SELECT child, CASE WHEN kind IN ('syn', 'inv') THEN CASE WHEN t_len > 5000 AND q_far > 2 * t_len THEN 'IntraChr' END ELSE CASE WHEN t_len > 5000 THEN 'InterChr' END END AS class FROM v_child""")
def _(child: DataFrame) -> DataFrame:
    return child.select("child", nets.trl_class(F.lit(3), F.col("kind"), F.col("t_len"), F.col("q_far")).alias("class"))


@query("inversion_fills", "v_gap v_child", """
    SELECT c.child, c.gap FROM v_child c JOIN v_gap g ON g.gap = c.gap WHERE c.kind = 'inv' AND c.q_far < 2 * g.t_len AND (c.q_over >= 10000 OR (c.t_len > 20000 AND c.q_len > 20000)) AND c.ali >= 10000""")
def _(gap: DataFrame, child: DataFrame) -> DataFrame:
    return nets.inversion_fills(gap.select("gap", "t_len"), child).select("child", "gap")


@query("pairwise_sv", "v_top v_gap v_child", f"""
    WITH {SUMS}, f AS (SELECT fill, net, t_start AS f0, t_start + t_size AS f1 FROM v_top WHERE ali >= 20000),
    g AS (SELECT g.gap, f.fill, f.net, g.t_start, g.t_len, g.q_len, g.t_start - coalesce(lag(g.t_start + g.t_len) OVER w, f0) AS five, coalesce(lead(g.t_start) OVER w, f1) - (g.t_start + g.t_len) AS three
        FROM v_gap g JOIN f ON f.fill = g.fill WINDOW w AS (PARTITION BY g.fill ORDER BY g.t_start, g.t_len)),
    k AS (SELECT gap, CASE WHEN n = 0 THEN CASE WHEN t_len / (q_len + CAST(0.01 AS DOUBLE)) > 2 THEN 'DEL_PAV' ELSE 'CMPLX_PAV' END
        WHEN t_len / (q_len + CAST(0.1 AS DOUBLE)) > 2 AND inv_len > (q_len + t_len) / CAST(4 AS DOUBLE) AND inv_len > 500 THEN 'InvCNV'
        WHEN t_len / (q_len + CAST(0.1 AS DOUBLE)) > 2 AND CAST(ali AS DOUBLE) / t_len > 0.25 AND ali > 500 THEN 'CNV'
        WHEN t_len / (q_len + CAST(0.1 AS DOUBLE)) > 2 AND t_len <= 20000 THEN CASE WHEN CAST(total_cov AS DOUBLE) / t_len < 0.1 AND t_len > 10000 THEN 'DEL_PAV' ELSE 'DEL' END
        WHEN CAST(total_cov AS DOUBLE) / t_len < 0.1 AND t_len > 10000 THEN 'CMPLX_PAV' ELSE 'CMPLX' END AS sv FROM s),
    r AS (SELECT g.*, sv AS svtype FROM g JOIN k ON k.gap = g.gap UNION ALL SELECT g.*, CASE sv WHEN 'InvCNV' THEN 'DEL_invCNV' ELSE 'DEL_CNV' END FROM g JOIN k ON k.gap = g.gap WHERE sv IN ('InvCNV', 'CNV'))
    SELECT 'n' || CAST(net AS string) AS net, gap, fill, svtype, t_start, t_start + t_len AS t_end, CAST(NULL AS string) AS q_name, five, three FROM r
    UNION ALL SELECT 'n' || CAST(g.net AS string), g.gap, g.fill, 'INV', c.t_start, c.t_start + c.t_len, c.q_name, five, three FROM g JOIN v_child c ON c.gap = g.gap
    WHERE c.kind = 'inv' AND c.q_far < 2 * g.t_len AND (c.q_over >= 10000 OR (c.t_len > 20000 AND c.q_len > 20000)) AND c.ali >= 10000""")
def _(top: DataFrame, gap: DataFrame, child: DataFrame) -> DataFrame:
    number = lambda c: F.split_part(c, F.lit(":"), F.lit(2)).cast("long").alias(c)
    return nets.call_sv(assess.net_nodes(top, gap, child)).select("net", number("gap"), number("fill"), "svtype", "t_start", "t_end", "q_name", "five", "three")


@query("pairwise_trl", "v_top v_gap v_child", """
    SELECT 'n' || CAST(net AS string) AS net, t_start, t_start + t_size AS t_end, 'ChrEND' AS class, 1 AS depth FROM v_top WHERE ali >= 20000 AND t_size > 50000
    UNION ALL SELECT 'n' || CAST(t.net AS string), c.t_start, c.t_start + c.t_len, CASE WHEN c.kind = 'nonSyn' THEN 'InterChr' ELSE 'IntraChr' END, 3 FROM v_child c JOIN v_gap g ON g.gap = c.gap JOIN v_top t ON t.fill = g.fill
    WHERE c.ali >= 10000 AND c.t_len > 5000 AND (c.kind = 'nonSyn' OR c.q_far > 2 * c.t_len)""")
def _(top: DataFrame, gap: DataFrame, child: DataFrame) -> DataFrame:
    return nets.call_trl(assess.net_nodes(top, gap, child)).select("net", "t_start", "t_end", "class", "depth")


@query("pairwise_sequences", "v_top v_gap v_child v_seq", f"""
    WITH {SUMS}, refs AS (SELECT string_agg(seq, '' ORDER BY contig) AS seq FROM v_seq WHERE contig < 64), f AS (SELECT fill, net FROM v_top WHERE ali >= 20000),
    g AS (SELECT g.gap, f.net, f.fill, g.t_start, g.t_len, g.q_len FROM v_gap g JOIN f ON f.fill = g.fill), k AS (SELECT gap, n, inv_len, ali FROM s),
    c AS (SELECT g.*, g.gap * 31 % 1900 AS a, g.gap * 31 % 1900 + g.t_len % 90 AS b, g.gap * 17 % 1900 AS qa, g.gap * 17 % 1900 + g.q_len % 70 AS qb, g.gap % 2 = 1 AS back, refs.seq FROM g CROSS JOIN refs),
    x AS (SELECT *, substring(seq, CAST(a + 1 AS INTEGER), CAST(b + 1 - a AS INTEGER)) AS ref_seq, substring(seq, CAST(greatest(0, a - 20) + 1 AS INTEGER), CAST(a - greatest(0, a - 20) AS INTEGER)) AS t5, substring(seq, CAST(b + 1 AS INTEGER), 20) AS t3,
        substring(seq, CAST(qa + 1 AS INTEGER), CAST(qb + 1 - qa AS INTEGER)) AS qs, substring(seq, CAST(greatest(0, qa - 20) + 1 AS INTEGER), CAST(qa - greatest(0, qa - 20) AS INTEGER)) AS p5, substring(seq, CAST(qb + 1 AS INTEGER), 20) AS p3 FROM c)
    SELECT gap, fill, ref_seq, nullif(t5, '') AS t5, t3, CASE WHEN back THEN reverse(translate(qs, 'ACGT', 'TGCA')) ELSE qs END AS query_seq, nullif(CASE WHEN back THEN reverse(translate(p5, 'ACGT', 'TGCA')) ELSE p5 END, '') AS q5, CASE WHEN back THEN reverse(translate(p3, 'ACGT', 'TGCA')) ELSE p3 END AS q3 FROM x""")
def _(top: DataFrame, gap: DataFrame, child: DataFrame, seqs: DataFrame) -> DataFrame:
    """Every called gap once, with the letters of the gap and its flanks on both genomes; places are brought onto contigs of 2,048 letters."""
    number = lambda c: F.split_part(c, F.lit(":"), F.lit(2)).cast("long").alias(c)
    found = nets.call_sv(assess.net_nodes(top, gap, child)).where("svtype <> 'INV' AND svtype NOT LIKE 'DEL_CNV' AND svtype <> 'DEL_invCNV'")
    found = found.select("net", number("gap"), number("fill"), "strand", (F.col("g_end") - F.col("g_start")).alias("t_len"), (F.col("g_q1") - F.col("g_q0")).alias("q_len"))
    a, q = F.col("gap") * 31 % 1900, F.col("gap") * 17 % 1900
    calls_ = found.withColumns({"g_start": a, "g_end": a + F.col("t_len") % 90, "g_name": F.concat(F.lit("q"), (F.col("gap") % 3).cast("string")), "g_q0": q, "g_q1": q + F.col("q_len") % 70, "strand": F.when(F.col("gap") % 2 == 1, "-").otherwise("+")})
    whole = seqs.where("contig < 64").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("contig", "seq"))), lambda x: x["seq"]), "").alias("seq"))
    targets = found.select(F.col("net").alias("contig")).distinct().join(F.broadcast(whole))  # one sequence of 64 digests under every name
    queries = found.select(F.concat(F.lit("q"), (F.col("gap") % 3).cast("string")).alias("contig")).distinct().join(F.broadcast(whole))
    return nets.with_sequences(calls_, targets, queries).select("gap", "fill", "ref_seq", "t5", "t3", "query_seq", "q5", "q3")


# ---- greedy folds (no SQL; tests compare them with plain walks)


DELETIONS = """r AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY st, en, en - st, id) AS k FROM v_iv),
    w AS (SELECT contig, k, k AS head, st AS c_st, en AS c_en FROM r WHERE k = 1 UNION ALL
        SELECT r.contig, r.k, CASE WHEN j THEN head ELSE r.k END, CASE WHEN j THEN c_st ELSE r.st END, CASE WHEN j THEN c_en ELSE r.en END
        FROM (SELECT w.*, coalesce(r.st <= w.c_en AND CAST(least(r.en, w.c_en) - r.st AS DOUBLE) / (w.c_en - w.c_st) > 0.9 AND CAST(r.en - r.st AS DOUBLE) / (w.c_en - w.c_st) > 0.95 AND CAST(r.en - r.st AS DOUBLE) / (w.c_en - w.c_st) < 1.05, false) AS j
            FROM w JOIN r ON r.contig = w.contig AND r.k = w.k + 1) x JOIN r ON r.contig = x.contig AND r.k = x.k + 1)"""


@query("merge_deletions", "v_iv", f"""
    WITH RECURSIVE {DELETIONS}, m AS (SELECT w.contig, w.head, count(*) AS n, '[' || string_agg('{{"sample":"' || r.sample || '","beg":' || CAST(r.st AS VARCHAR) || ',"end":' || CAST(r.en AS VARCHAR) || ',"len":' || CAST(r.en - r.st AS VARCHAR) || '}}', ',' ORDER BY r.sample, r.st, r.en) || ']' AS members
        FROM w JOIN r ON r.contig = w.contig AND r.k = w.k GROUP BY w.contig, w.head)
    SELECT m.contig, r.st AS beg, r.en AS "end", r.en - r.st AS len, r.id, m.n, m.members FROM m JOIN r ON r.contig = m.contig AND r.k = m.head""")
def _(iv: DataFrame) -> DataFrame:
    """Digests travel as bytes, in the order of their digits."""
    rows = iv.select(F.unhex("id").alias("id"), "contig", F.col("st").alias("beg"), F.col("en").alias("end"), (F.col("en") - F.col("st")).alias("len"), "sample")
    return folds.merged(folds.merge_deletions(rows, numbered=False)).select("contig", "beg", "end", "len", F.lower(F.hex("id")).alias("id"), "n", F.to_json("members").alias("members"))


@query("merge_insertions", "v_iv v_seq")
def _(iv: DataFrame, seqs: DataFrame) -> DataFrame:
    text = seqs.select(F.col("contig").alias("pkey"), "seq")
    rows = iv.join(text, "pkey").select("id", "contig", F.col("st").alias("beg"), F.col("en").alias("end"), F.length("seq").cast("long").alias("len"), "sample", "seq", F.substring("seq", 1, 6).alias("five"), F.substring("seq", 20, 6).alias("three"))
    return folds.merged(folds.merge_insertions(rows, numbered=False)).select("contig", "beg", "end", "len", "id", "n", F.to_json("members").alias("members"))


@query("overlap_filter", "v_iv", """
    WITH RECURSIVE r AS (SELECT id, contig, sample, st, en, row_number() OVER (PARTITION BY contig, sample ORDER BY st, en, id) AS k FROM v_iv),
    w AS (SELECT contig, sample, k, true AS kept, st AS c_st, en AS c_en FROM r WHERE k = 1 UNION ALL
        SELECT contig, sample, k, ok, CASE WHEN ok THEN st ELSE c_st END, CASE WHEN ok THEN en ELSE c_en END
        FROM (SELECT r.contig, r.sample, r.k, r.st, r.en, w.c_st, w.c_en, NOT (CAST(least(r.en, w.c_en) - greatest(r.st, w.c_st) + 1 AS DOUBLE) / (r.en - r.st + 1) > 0.1) AS ok FROM w JOIN r ON r.contig = w.contig AND r.sample = w.sample AND r.k = w.k + 1) x)
    SELECT r.id, r.contig, r.sample, r.st, r.en FROM w JOIN r ON r.contig = w.contig AND r.sample = w.sample AND r.k = w.k WHERE w.kept""")
def _(iv: DataFrame) -> DataFrame:
    return folds.drop_overlaps(iv.select("id", "contig", "sample", "st", "en"), ["contig", "sample"])


@query("deletions_in_sql", "v_iv", f"""
    WITH RECURSIVE {DELETIONS.replace("FROM v_iv)", "FROM (SELECT DISTINCT id, contig, st, en FROM v_iv))")} SELECT r.contig, r.id, h.id AS cluster FROM w JOIN r ON r.contig = w.contig AND r.k = w.k JOIN r h ON h.contig = w.contig AND h.k = w.head""")
def _(iv: DataFrame) -> DataFrame:
    """The merge of deletions as a table function in SQL. No cluster goes beyond an island of overlapping rows, so islands, which are as many as the contigs are long, are walked each on its own."""
    spark = iv.sparkSession
    tables.register(spark)
    rows = intervals.islands(iv.dropDuplicates(["id"]).select("id", "contig", "st", "en"))
    rows.selectExpr("contig", "island", "st AS beg", "en AS end", "en - st AS len", "id").createOrReplaceTempView("v_calls")
    return spark.sql("SELECT * FROM merge_deletions(TABLE(SELECT * FROM v_calls) PARTITION BY (contig, island) ORDER BY (beg, end, len, id))")


@query("annotation_percent", "v_iv", """
    WITH e AS (SELECT pkey AS sv, strand AS kind, round(CAST(sum(en - st) AS DOUBLE) / 10000 * 100, 1) AS p FROM v_iv GROUP BY 1, 2)
    SELECT sv, array_to_string(list(kind || ':' || printf('%.1f', p) || '%' ORDER BY kind), ';') AS text FROM e GROUP BY sv""")
def _(iv: DataFrame) -> DataFrame:
    rows = folds.annotation_percent(iv.select(F.col("pkey").alias("sv"), F.col("strand").alias("kind"), "st", "en", F.lit(10_000).alias("len")))
    return rows.select("sv", F.array_join(F.transform("parts", lambda x: F.concat(x["kind"], F.lit(":"), F.format_string("%.1f", x["p"]), F.lit("%"))), ";").alias("text"))


@query("annotation_join", "v_indel v_feat", """
    SELECT v.contig, v.beg, v.kind, coalesce(CAST(max(f.id) AS string), 'NF') AS cds FROM v_indel v LEFT JOIN v_feat f ON f.contig = v.contig AND f.st = v.beg GROUP BY v.contig, v.beg, v.kind""")
def _(indel: DataFrame, feat: DataFrame) -> DataFrame:
    found = feat.groupBy("contig", F.col("st").alias("beg")).agg(F.max("id").alias("id"))
    return indel.select("contig", "beg", "kind").distinct().join(found, ["contig", "beg"], "left").select("contig", "beg", "kind", F.coalesce(F.col("id").cast("string"), F.lit("NF")).alias("cds"))


REFS = """refs AS (SELECT concat('c', CAST(contig AS string)) AS contig, repeat(seq, 64) AS seq FROM v_seq WHERE contig < 8)"""


def _refs(seqs: DataFrame) -> DataFrame:
    """Eight contigs that repeat a digest each."""
    return seqs.where("contig < 8").select(F.concat(F.lit("c"), F.col("contig").cast("string")).alias("contig"), F.repeat("seq", 64).alias("seq"))


def _marked(indel: DataFrame, seqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variants with the letters they add, on those contigs: random ones, copies of what stands before or after, and reverse complements of it; some are of nine letters."""
    refs = _refs(seqs)
    v = indel.select(F.col("contig").alias("chrom"), (F.col("beg") % 1900 + 40).alias("pos"), F.concat(F.lit("SV"), F.col("beg").cast("string"), "kind").alias("id"), "len", (F.col("beg") % 5).alias("how")).dropDuplicates(["chrom", "pos", "id"])
    v = v.join(refs.select(F.col("contig").alias("chrom"), "seq"), "chrom").withColumn("n", (F.col("len") * 8 + 1).cast("int"))
    before, after = (F.substring("seq", (F.col("pos") + d).cast("int"), F.col("n")) for d in (1 - F.col("n"), F.lit(1)))
    random = F.substring(F.translate(F.md5((F.col("pos") % 32).cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT"), F.lit(1), F.col("n"))
    text = F.when(F.col("how") == 1, before).when(F.col("how") == 2, after).when(F.col("how") == 3, seq.revcomp(before)).when(F.col("how") == 4, seq.revcomp(after)).otherwise(random)
    out = v.select("chrom", "pos", "id", "len", F.lit("A").alias("ref"), text.alias("alt"), F.concat(F.lit("SVLEN="), F.col("len").cast("string")).alias("info"))
    return out, refs


def _hits(v: DataFrame, iv: DataFrame) -> DataFrame:
    """Alignments of the variants' sequences to a library."""
    hits = v.select(annotation.name_of().alias("qname"), "pos").join(iv.select("pkey", "qty", "line"), F.col("pos") == F.col("pkey"))
    return hits.select("qname", F.lit(300).alias("qlen"), (F.col("line") * 20).alias("qs"), (F.col("line") * 20 + F.col("qty")).alias("qe"), F.concat(F.lit("x#T"), (F.col("qty") % 3).cast("string"), F.lit("/y")).alias("tname"))


@query("annotate", "v_indel v_seq v_iv")
def _(indel: DataFrame, seqs: DataFrame, iv: DataFrame) -> DataFrame:
    v, refs = _marked(indel, seqs)
    v = settled(v, "variants")  # read by copies, both libraries' hits and the result
    paf = _hits(v, iv)
    return annotation.annotate(v, refs, paf.where("qe % 2 = 0"), paf, "INS").select("chrom", "pos", "id", "alt", "info")


@query("tandem_copies", "v_indel v_seq", f"""
    WITH {REFS}, r AS (SELECT DISTINCT contig, beg % 1900 + 1 AS beg, beg % 1900 + 20 AS fin, contig AS query, beg % 1900 + (CASE beg % 3 WHEN 0 THEN 52 WHEN 1 THEN 24 ELSE 41 END) AS q_st FROM v_indel WHERE kind = 'INS'),
    s AS (SELECT r.*, q_st + 8 AS q_en, substring(seq, beg, 20) AS own, substring(seq, q_st - 19, 20) AS five, substring(seq, q_st + 9, 20) AS three FROM r JOIN refs ON refs.contig = r.contig),
    k AS (SELECT *, len(list_filter(range(1, 12), lambda i: contains(five, substring(own, i, 10)))) / CAST(11 AS DOUBLE) AS s5, len(list_filter(range(1, 12), lambda i: contains(three, substring(own, i, 10)))) / CAST(11 AS DOUBLE) AS s3 FROM s)
    SELECT contig, beg, fin, query, CASE WHEN s5 > s3 THEN q_st - 20 ELSE q_en END AS q_beg, CASE WHEN s5 > s3 THEN q_st ELSE q_en + 20 END AS q_end, CASE WHEN s5 > s3 THEN '5' ELSE '3' END AS side FROM k WHERE greatest(s5, s3) > 0.5""")
def _(indel: DataFrame, seqs: DataFrame) -> DataFrame:
    """Stretches of 20 letters whose copy stands before the place on the query, after it, or (in part) nowhere."""
    refs, at = _refs(seqs), F.col("beg") % 1900
    q_st = at + F.when(F.col("beg") % 3 == 0, 52).when(F.col("beg") % 3 == 1, 24).otherwise(41)
    rows = indel.where("kind = 'INS'").select("contig", (at + 1).alias("beg"), (at + 20).alias("fin"), F.col("contig").alias("query"), q_st.alias("q_st"), (q_st + 8).alias("q_en")).distinct()
    return annotation.tandem_copies(rows, refs, refs)


# ---- evaluation


NO = {"spark": "CAST(conv(substring(id, 1, 12), 16, 10) AS BIGINT)", "duck": "CAST('0x' || substring(id, 1, 12) AS BIGINT)"}
SIDE = """SELECT x.id, any_value(x.sz) AS sz, count(*) AS k, max(y.sz) AS m FROM {} x JOIN {} y ON x.contig = y.contig AND x.neg = y.neg AND y.st < x.en + 50 + x.sz // 2 AND y.en > greatest(0, x.st - 50 - x.sz // 2) WHERE x.sz >= 20 GROUP BY x.id"""


@query("sv_eval", "v_iv", f"""
    WITH u AS (SELECT DISTINCT id, contig, st, en, en - st AS sz, strand = '-' AS neg, sample FROM v_iv), b AS (SELECT * FROM u WHERE sample < 'S3'), c AS (SELECT * FROM u WHERE sample >= 'S3'),
    s1 AS ({SIDE.format("b", "c")}), s2 AS ({SIDE.format("c", "b")})
    SELECT (SELECT count(*) FROM b WHERE sz >= 20) AS base, (SELECT count(*) FROM s1 WHERE k > 1 OR abs(m - sz) < 20 OR CAST(abs(m - sz) AS DOUBLE) / sz < 0.5) AS found,
        (SELECT count(*) FROM c WHERE sz >= 20) AS call, (SELECT count(*) FROM s2 WHERE k > 1 OR abs(m - sz) < 20 OR CAST(abs(m - sz) AS DOUBLE) / sz < 0.5) AS right_calls""")
def _(iv: DataFrame) -> DataFrame:
    v = iv.select(F.unhex("id").alias("id"), "contig", "st", "en", "sample", F.when(F.col("strand") == "-", F.col("st") - F.col("en")).otherwise(F.col("en") - F.col("st")).alias("change"))
    v = settled(v.dropDuplicates(["id"]), "variants")  # both sets are read twice
    return assess.sv_counts(v.where("sample < 'S3'"), v.where("sample >= 'S3'"), window=50, least=20)


@query("junction_eval", "v_iv v_feat", """
    WITH e AS (SELECT contig || '.' || CAST(id % 50 AS string) AS tr, contig, st, st + 10 AS en FROM v_feat), n AS (SELECT *, lead(st) OVER (PARTITION BY tr, contig ORDER BY st, en) AS nx FROM e),
    a AS (SELECT DISTINCT contig, en AS st, nx AS en FROM n WHERE nx IS NOT NULL), r AS (SELECT id, contig, st + qty AS st, st + qty + line * 30 AS en, line FROM (SELECT DISTINCT id, contig, st, qty, line FROM v_iv)),
    h AS (SELECT r.id, max(CASE WHEN abs(r.st - a.st) <= 60 AND abs(r.en - a.en) <= 60 THEN 1 ELSE 0 END) AS hit FROM r JOIN a ON a.contig = r.contig AND a.st < r.en AND r.st < a.en WHERE line > 2 GROUP BY r.id)
    SELECT (SELECT count(*) FROM r) AS alignments, (SELECT count(*) FROM r WHERE line <= 2) AS singletons, (SELECT count(*) FROM r WHERE line > 2) AS introns,
        (SELECT count(*) FROM r WHERE line > 2 AND id NOT IN (SELECT id FROM h)) AS novel, (SELECT count(*) FROM h WHERE hit = 1) AS correct""")
def _(iv: DataFrame, feat: DataFrame) -> DataFrame:
    n = F.col("qty").cast("string")
    spliced = F.concat(n, F.lit("M"), (F.col("line") * 30).cast("string"), F.lit("N"), n, F.lit("M"))
    rows = iv.dropDuplicates(["id"]).select("id", "contig", F.col("st").alias("pos"), F.when(F.col("line") > 2, spliced).otherwise(F.concat(n, F.lit("M"))).alias("cigar"))
    exons = feat.select(F.concat_ws(".", "contig", (F.col("id") % 50).cast("string")).alias("transcript"), "contig", "st", (F.col("st") + 10).alias("en"))
    return assess.junction_eval(rows, exons, 60)


@query("junction_fuzzy", "v_iv v_feat", """
    SELECT i.id, max(CASE WHEN abs(i.st - f.st) <= 60 AND abs(i.en - f.en) <= 60 THEN 1 ELSE 0 END) AS hit FROM v_iv i JOIN v_feat f ON i.contig = f.contig AND i.st < f.en AND f.st < i.en GROUP BY i.id""")
def _(iv: DataFrame, feat: DataFrame) -> DataFrame:
    hits = assess.junction_hits(iv.select(F.unhex("id").alias("id"), "contig", "st", "en"), feat, 60, bin_size=512)
    return hits.select(F.lower(F.hex("id")).alias("id"), "hit")


@query("map_eval", "v_iv", f"""
    WITH u AS (SELECT DISTINCT id, okey, contig, st, en, strand, line, qty, {NO['duck']} AS no FROM v_iv), t AS (SELECT okey, arg_min(contig, no) AS c, arg_min(st, no) + okey % 5 * 40 AS s, arg_min(en, no) + okey % 5 * 40 AS e, arg_min(strand, no) AS d FROM u GROUP BY okey),
    x AS (SELECT u.*, least(60, line * 9) AS mapq, NOT (c = contig AND d = strand AND least(en, e) > greatest(st, s) AND CAST(least(en, e) - greatest(st, s) AS DOUBLE) / (greatest(en, e) - least(st, s)) > 0.1) AS wrong, row_number() OVER (PARTITION BY u.okey ORDER BY qty DESC, no) AS k FROM u JOIN t ON t.okey = u.okey),
    q AS (SELECT mapq, count(*) AS n, count_if(wrong) AS errors FROM x WHERE k = 1 GROUP BY mapq), p AS (SELECT *, count_if(errors > 0 OR mapq = (SELECT max(mapq) FROM q)) OVER (ORDER BY mapq DESC) AS part FROM q),
    g AS (SELECT part, max(mapq) AS mapq, sum(n) AS n, sum(errors) AS errors FROM p GROUP BY part)
    SELECT mapq, CAST(n AS BIGINT) AS n, CAST(errors AS BIGINT) AS errors, round(CAST(sum(errors) OVER (ORDER BY part) AS DOUBLE) / sum(n) OVER (ORDER BY part), 9) AS rate, CAST(sum(n) OVER (ORDER BY part) AS BIGINT) AS total FROM g""")
def _(iv: DataFrame) -> DataFrame:
    # one exchange by read: copies go, and the place that a read's name tells is read once, not for each of its alignments
    u = iv.select(F.unhex("id").alias("id"), "okey", "contig", "st", "en", "strand", "line", "qty", F.expr(NO["spark"]).alias("no")).repartition("okey").distinct()
    one = F.struct("no", "contig", "st", "en", "strand", "line", "qty")
    reads = u.groupBy("okey").agg(F.collect_list(one).alias("all")).withColumn("f", F.array_min("all"))
    far = F.col("okey") % 5 * 40
    name = F.concat_ws("!", F.concat(F.lit("r"), F.col("okey").cast("string")), "f.contig", (F.col("f.st") + far).cast("string"), (F.col("f.en") + far).cast("string"), "f.strand")
    rows = reads.withColumn("qname", name).withColumn("truth", assess.true_place(F.col("qname"))).select("qname", "truth", F.explode("all").alias("x")).select("qname", "truth", "x.*")
    found = assess.map_eval(rows.select("qname", "truth", "contig", "st", "en", "strand", (F.col("line") * 9).cast("int").alias("mapq"), F.col("qty").alias("score"), "no"))
    return found.withColumn("rate", F.round("rate", 9))


STEPS = f"""u AS (SELECT DISTINCT id, okey, line, line * 100 + qty AS qs, line * 100 + qty * 5 AS qe, qty, strand, 'c' || CAST(pkey % 2 AS string) AS tname, st AS ts, en AS te, {NO['duck']} AS no FROM v_iv)"""


@query("misjoins", "v_iv v_feat", f"""
    WITH RECURSIVE {STEPS}, c AS (SELECT DISTINCT 'c' || CAST(id % 2 AS string) AS contig, st, en FROM v_feat WHERE id % 7 = 0),
    o AS (SELECT u.id, sum(least(u.te, c.en) - greatest(u.ts, c.st)) AS cov FROM u JOIN c ON c.contig = u.tname AND c.st < u.te AND u.ts < c.en GROUP BY u.id),
    s AS (SELECT u.*, coalesce(o.cov, 0) >= (te - ts) * 0.5 AND tname IN (SELECT contig FROM c) AS cen FROM u LEFT JOIN o ON o.id = u.id WHERE 4 * qty >= 40),
    l AS (SELECT *, row_number() OVER w AS k, lag(tname) OVER w AS pt, lag(strand) OVER w AS ps, lag(qe) OVER w AS pq, lag(ts) OVER w AS p0, lag(te) OVER w AS p1, lag(cen) OVER w AS pc, lead(strand) OVER w AS nx FROM s WINDOW w AS (PARTITION BY okey ORDER BY qs, id)),
    w AS (SELECT okey, id, k, false AS skip FROM l WHERE k = 2 UNION ALL
        SELECT l.okey, l.id, l.k, NOT w.skip AND x.pt = x.tname AND x.ps <> x.strand AND coalesce(x.nx = x.ps, false) FROM w JOIN l x ON x.okey = w.okey AND x.k = w.k JOIN l ON l.okey = w.okey AND l.k = w.k + 1),
    r AS (SELECT l.id, CASE WHEN pt <> tname THEN 'contig' WHEN ps = strand THEN CASE WHEN abs((CASE WHEN strand = '+' THEN ts - p1 ELSE p0 - te END) - (qs - pq)) > 20000 THEN 'gap' END WHEN nx = ps THEN 'inversion' ELSE 'end' END AS kind, cen OR pc AS cen FROM w JOIN l ON l.id = w.id WHERE NOT skip)
    SELECT kind, count(*) AS n, count_if(cen) AS centromeric FROM r WHERE kind IS NOT NULL GROUP BY kind""")
def _(iv: DataFrame, feat: DataFrame) -> DataFrame:
    cen = feat.where("id % 7 = 0").select(F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("contig"), "st", "en").distinct()
    found = assess.misjoins(_steps(iv).withColumns({"blen": 4 * F.col("qty"), "id": F.unhex("id")}), cen, least=40, far=20_000)
    return found.groupBy("kind").agg(F.count("*").alias("n"), F.count_if("cen").alias("centromeric"))


def _steps(iv: DataFrame) -> DataFrame:
    """Alignments of each order's rows, as segments of one query."""
    n, qs = F.col("qty"), F.col("line") * 100 + F.col("qty")
    return iv.dropDuplicates(["id"]).select(
        "id", F.col("okey").alias("qname"), (1000 + F.col("okey") % 500).alias("qlen"), qs.alias("qs"), (qs + 4 * n).alias("qe"), "strand", F.concat(F.lit("c"), (F.col("pkey") % 2).cast("string")).alias("tname"),
        F.col("st").alias("ts"), F.col("en").alias("te"), "qty", "line", F.when(F.col("pkey") % 7 == 0, "S").otherwise("P").alias("type"), F.expr(NO["spark"]).alias("no"),
    )


@query("paf_compare", "v_iv", f"""
    WITH u AS (SELECT DISTINCT id, pkey * 10 + line AS pkey, 5000 + qty * 40 - 400 AS qlen, contig, st, en, line * 5 AS mapq, sample, okey % 5 = 0 AS s, {NO['duck']} AS no FROM v_iv), p AS (SELECT * FROM u WHERE NOT s),
    b AS (SELECT pkey, min(qlen) AS qlen, min(contig) AS contig, min(st) AS st, min(en) AS en, min(mapq) AS mapq FROM p WHERE sample < 'S2' GROUP BY pkey HAVING count(*) = 1), b1 AS (SELECT * FROM b WHERE qlen >= 5000),
    c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pkey ORDER BY no) AS k FROM p WHERE sample >= 'S2') WHERE k = 1 AND qlen >= 5000),
    x AS (SELECT b1.pkey AS bk, c.pkey AS ck, b1.mapq AS bq, c.mapq AS cq, b1.contig = c.contig AS same, CASE WHEN b1.st < c.st THEN b1.en - c.st ELSE c.en - b1.st END AS i, CASE WHEN b1.st < c.st THEN c.en - b1.st ELSE b1.en - c.st END AS s FROM b1 FULL JOIN c ON c.pkey = b1.pkey)
    SELECT count_if(bq >= 10) AS base, count_if(cq >= 10) AS test, count_if(bk IS NULL AND cq >= 10) AS out_high, count_if(bk IS NULL AND cq < 10) AS out_low, count_if(ck IS NOT NULL AND bq >= 10 AND same AND i > 0 AND i >= s * 0.5) AS hit,
        count_if(ck IS NOT NULL AND bq >= 10 AND NOT (same AND i > 0 AND i >= s * 0.5)) AS wrong, count_if(bq >= 10 AND ck IS NULL) AS miss FROM x""")
def _(iv: DataFrame) -> DataFrame:
    paf = iv.dropDuplicates(["id"]).select(
        (F.col("pkey") * 10 + F.col("line")).alias("qname"), (4600 + F.col("qty") * 40).alias("qlen"), F.col("contig").alias("tname"), F.col("st").alias("ts"), F.col("en").alias("te"), (F.col("line") * 5).alias("mapq"),
        F.when(F.col("okey") % 5 == 0, "S").otherwise("P").alias("type"), F.expr(NO["spark"]).alias("no"), "sample",
    )
    return assess.paf_compare(paf.where("sample < 'S2'"), paf.where("sample >= 'S2'"))


CIGAR = "concat(CAST(qty AS string), 'M', CAST(line AS string), 'D', CAST(qty % 5 + 1 AS string), 'M', CAST(qty % 3 + 1 AS string), 'I', '7M')"


@query("cigar_sums", "v_iv", f"""
    WITH c AS (SELECT id, {CIGAR} AS cg FROM v_iv), o AS (SELECT id, unnest(regexp_extract_all(cg, '([0-9]+)([MIDNSHP=X])', 1)) AS n, unnest(regexp_extract_all(cg, '([0-9]+)([MIDNSHP=X])', 2)) AS op FROM c)
    SELECT id, CAST(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN CAST(n AS BIGINT) ELSE 0 END) AS BIGINT) AS ref_len, CAST(sum(CASE WHEN op IN ('M', 'I', '=', 'X') THEN CAST(n AS BIGINT) ELSE 0 END) AS BIGINT) AS query_len,
        CAST(sum(CASE WHEN op IN ('I', 'D') THEN CAST(n AS BIGINT) ELSE 0 END) AS BIGINT) AS gaps, count_if(op IN ('I', 'D')) AS opens FROM o GROUP BY id""")
def _(iv: DataFrame) -> DataFrame:
    s = cigar.sums(F.expr(CIGAR))
    return iv.select("id", s["ref_len"].alias("ref_len"), s["query_len"].alias("query_len"), s["gaps"].alias("gaps"), s["opens"].cast("long").alias("opens"))


@query("gap_histogram", "v_iv", """
    SELECT CASE WHEN g < 50 THEN 50 WHEN g < 100 THEN 100 WHEN g < 300 THEN 300 WHEN g < 400 THEN 400 WHEN g < 1000 THEN 1000 END AS under, count(*) AS n FROM (SELECT (en - st) * line AS g FROM v_iv) GROUP BY 1""")
def _(iv: DataFrame) -> DataFrame:
    return iv.groupBy(cigar.gap_bucket((F.col("en") - F.col("st")) * F.col("line")).alias("under")).agg(F.count("*").alias("n"))


@query("vcf_stats", "v_seq v_indel", """
    WITH a AS (SELECT s.contig, substring(s.seq, 1, 1 + CAST(v.len AS INTEGER)) AS ref, substring(s.seq, 5, 1 + CAST(v.len * v.len * 3 AS INTEGER)) AS alt FROM v_indel v JOIN v_seq s ON s.contig = v.beg // 40),
    c AS (SELECT unnest(range(1, least(length(ref), length(alt)) + 1)) AS i, ref, alt FROM a), d AS (SELECT substring(ref, CAST(i AS INTEGER), 1) || substring(alt, CAST(i AS INTEGER), 1) AS s FROM c),
    k AS (SELECT CASE WHEN s IN ('AG', 'GA', 'CT', 'TC') THEN 'ts' ELSE 'tv' END AS metric, NULL AS within FROM d WHERE s[1] <> s[2]
        UNION ALL SELECT CASE WHEN length(alt) > length(ref) THEN 'ins' ELSE 'del' END, CASE WHEN n = 1 THEN 1 WHEN n = 2 THEN 2 WHEN n < 50 THEN 49 WHEN n < 1000 THEN 999 WHEN n < 7000 THEN 6999 END FROM (SELECT *, abs(length(alt) - length(ref)) AS n FROM a) WHERE n > 0)
    SELECT metric, within, count(*) AS n FROM k GROUP BY ALL""")
def _(seqs: DataFrame, indel: DataFrame) -> DataFrame:
    met = indel.withColumn("at", F.floor(F.col("beg") / 40)).join(seqs.select(F.col("contig").alias("at"), "seq"), "at")
    n, one = F.col("len").cast("int"), F.lit(1)
    return variants.allele_stats(met.select(F.substring("seq", one, n + 1).alias("ref"), F.array(F.substring("seq", F.lit(5), n * n * 3 + 1)).alias("alts")))


@query("vcf_select", "v_indel", "SELECT contig, beg, fin, len, kind FROM v_indel WHERE len >= 2 AND len <= 3")
def _(indel: DataFrame) -> DataFrame:
    wide = indel.withColumn("ref", F.when(F.col("kind") == "DEL", F.repeat(F.lit("A"), (F.col("len") + 1).cast("int"))).otherwise("A")).withColumn("alts", F.array(F.when(F.col("kind") == "DEL", "A").otherwise(F.repeat(F.lit("A"), (F.col("len") + 1).cast("int")))))
    return variants.select_by_length(wide, 2, 3).select("contig", "beg", "fin", "len", "kind")


@query("locus_union", "v_iv", "SELECT contig, st FROM v_iv WHERE sample < 'S3' UNION SELECT contig, st FROM v_iv WHERE sample >= 'S3'")
def _(iv: DataFrame) -> DataFrame:
    return iv.where("sample < 'S3'").select("contig", "st").union(iv.where("sample >= 'S3'").select("contig", "st")).distinct()


@query("covered_parts", "v_iv", """
    WITH a AS (SELECT id, contig, st, en FROM v_iv WHERE sample < 'S3'), b AS (SELECT contig, st, en FROM v_iv WHERE sample >= 'S3')
    SELECT a.id, greatest(a.st, b.st) AS st, least(a.en, b.en) AS en FROM a JOIN b ON a.contig = b.contig AND a.st < b.en AND b.st < a.en""")
def _(iv: DataFrame) -> DataFrame:
    b = iv.where("sample >= 'S3'").select("contig", F.col("st").alias("b_st"), F.col("en").alias("b_en"))
    both = intervals.overlap_join(iv.where("sample < 'S3'").select("id", "contig", "st", "en"), b)
    return both.select("id", F.greatest("st", "b_st").alias("st"), F.least("en", "b_en").alias("en"))


# ---- algebra of blocks


def _rows(df: DataFrame) -> DataFrame:
    return df.withColumn("rows", blocks.two_rows(F.lit(100_000_000)))


@query("block_slice", "v_blk", """
    SELECT block, t_start + length(replace(substring(t_text, 1, 5), '-', '')) AS t_start, substring(t_text, 6, 15) AS t_text, q_start + length(replace(substring(q_text, 1, 5), '-', '')) AS q_start, substring(q_text, 6, 15) AS q_text FROM v_blk""")
def _(blk: DataFrame) -> DataFrame:
    x = _rows(blk).select("block", blocks.slice_columns(F.col("rows"), F.lit(5), F.lit(20)).alias("r"))
    return x.select("block", F.col("r")[0]["start"].alias("t_start"), F.col("r")[0]["text"].alias("t_text"), F.col("r")[1]["start"].alias("q_start"), F.col("r")[1]["text"].alias("q_text"))


@query("block_flip", "v_blk", """
    WITH n AS (SELECT *, length(replace(t_text, '-', '')) AS tn, length(replace(q_text, '-', '')) AS qn FROM v_blk)
    SELECT block, q_contig AS src, CASE WHEN q_strand = '-' THEN 100000000 - q_start - qn ELSE q_start END AS start, CASE WHEN q_strand = '-' THEN reverse(translate(q_text, 'ACGT', 'TGCA')) ELSE q_text END AS text,
        CASE WHEN q_strand = '-' THEN 100000000 - t_start - tn ELSE t_start END AS other, q_strand AS other_strand FROM n""")
def _(blk: DataFrame) -> DataFrame:
    x = _rows(blk).select("block", blocks.flip(F.col("rows")).alias("r"))
    a, b = F.col("r")[0], F.col("r")[1]
    return x.select("block", a["src"].alias("src"), a["start"].alias("start"), a["text"].alias("text"), b["start"].alias("other"), b["strand"].alias("other_strand"))


@query("block_fuse", "v_blk", "SELECT contig, sample, q_contig, q_strand, t_start, t_text, q_start, q_text FROM v_blk")
def _(blk: DataFrame) -> DataFrame:
    """Each block is cut in two, which fuse puts together again."""
    again = blocks.fuse(posmap.pieces(blk, 16).withColumn("block", F.col("block") * 2))
    return again.select("contig", "sample", "q_contig", "q_strand", "t_start", "t_text", "q_start", "q_text")


@query("fused_blocks", "v_multi")
def _(blk: DataFrame) -> DataFrame:
    """The joint blocks of all samples, narrow ones fused; the samples' own rows can fill holes."""
    own = _pairwise(blk).select(F.slice("rows", 2, 1).alias("rows")).withColumn("no", F.xxhash64(F.to_json("rows")))
    return fusing.fuse_short(_merged(_once(blk)), own).select("score", F.to_json("rows").alias("rows"))


@query("uncovered", "v_sp", f"""
    WITH {SRC}, {ISLANDS}, z AS (SELECT contig, max(en) + 100 AS length FROM src GROUP BY contig), a AS (SELECT contig, st, en FROM m UNION ALL SELECT contig, length, length FROM z),
    n AS (SELECT contig, coalesce(lag(en) OVER (PARTITION BY contig ORDER BY st, en), 0) AS st, st AS en FROM a) SELECT * FROM n WHERE st < en""")
def _(iv: DataFrame) -> DataFrame:
    return blocks.uncovered(iv, iv.groupBy("contig").agg((F.max("en") + 100).alias("length")))


@query("interval_subtract", "v_feat v_sp", f"""
    WITH {SRC}, {ISLANDS}, a AS (SELECT f.id, f.contig, f.st, f.en, m.st AS b_st, m.en AS b_en FROM v_feat f JOIN m ON m.contig = f.contig AND m.st < f.en AND f.st < m.en UNION ALL SELECT id, contig, st, en, en, en FROM v_feat),
    n AS (SELECT id, contig, coalesce(lag(b_en) OVER (PARTITION BY id ORDER BY b_st, b_en), st) AS st, b_st AS en FROM a) SELECT * FROM n WHERE st < en""")
def _(feat: DataFrame, iv: DataFrame) -> DataFrame:
    return blocks.subtract(feat, iv)


def _pairwise(blk: DataFrame) -> DataFrame:
    """(sample, rows): blocks of the reference, on top on ref.c contigs, with a sample."""
    named = blk.withColumns({"contig": F.concat(F.lit("ref."), "contig"), "q_contig": F.concat("sample", F.lit("."), "q_contig")})
    return named.select("sample", blocks.two_rows(F.lit(100_000_000)).alias("rows"))


def _once(blk: DataFrame) -> DataFrame:
    """(sample, rows): each sample's blocks so that they cover nothing twice."""
    own = kernels.single_coverage(blk.withColumn("contig", F.concat("sample", F.lit("/"), "contig")).withColumn("q_contig", F.concat("sample", F.lit("/"), "q_contig")))
    return settled(_pairwise(own.withColumns({c: F.split_part(c, F.lit("/"), F.lit(2)) for c in ("contig", "q_contig")})), "once")


SAMPLES = ("S0", "S1", "S2", "S3", "S4", "S5")


def _merged(once: DataFrame) -> DataFrame:
    """Blocks of the reference and all six samples, joined along a guide tree."""
    return multi.merge_along(multi.parse_tree("(ref (((S0 S1) S2) ((S3 S4) S5)))"), "ref", {s: once.where(F.col("sample") == s).select("rows") for s in SAMPLES})


@query("merged_blocks", "v_multi")
def _(blk: DataFrame) -> DataFrame:
    return multi.topped(_merged(_once(blk))).select("contig", "st", "en", F.size("rows").alias("n"), F.to_json("rows").alias("rows"))


@query("region_rows", "v_multi v_indel")
def _(blk: DataFrame, indel: DataFrame) -> DataFrame:
    """Stretches of 60 letters around the variants, as a row for each genome with letters there."""
    ref = F.concat(F.lit("ref."), F.col("contig"))
    at = F.floor(F.col("beg") / 10)  # as far as the blocks reach
    regions = indel.select(F.struct("contig", "beg", "fin", "len", "kind").alias("id"), ref.alias("contig"), at.alias("st"), (at + 60).alias("en"))
    seqs = blk.groupBy(ref.alias("contig")).agg(F.max("t_start").alias("n")).select("contig", F.repeat(F.lit("N"), (F.col("n") + 100).cast("int")).alias("seq"))
    return multi.region_rows(_merged(_once(blk)), regions, seqs).select("id.*", "genome", "text")


@query("evidence", "v_multi")
def _(blk: DataFrame) -> DataFrame:
    """How many of the pairs of rows of each joint block the pairwise alignments agree with."""
    found = _merged(_once(blk)).withColumn("id", F.md5(F.to_json("rows")))
    return multi.evidence(found, _pairwise(blk).select("rows"), bin_size=64).select("id", F.size("rows").alias("n"), "share")


@query("covered_blocks", "v_multi")
def _(blk: DataFrame) -> DataFrame:
    """The parts of a sample's blocks that another one's, single-covered, lie on."""
    once = _once(blk).where("sample = 'S2'").select("rows")
    return multi.covered(_pairwise(blk.where("sample = 'S1'")).select("rows"), once, bin_size=64).select("score", F.to_json("rows").alias("rows"))


@query("nested_blocks", "v_multi")
def _(blk: DataFrame) -> DataFrame:
    """The lists of two samples as they come, not single-covered: every overlap is joined, and what no join used stays."""
    lists = {s: _pairwise(blk.where(F.col("sample") == s)).select("rows") for s in ("S1", "S2")}
    return multi.merge_nested(lists["S1"], lists["S2"], bin_size=64).select("kind", "score", F.to_json("rows").alias("rows"))


# ---- calls from alignments

PAF = """p AS (SELECT id, contig AS tname, st AS ts, en AS te, en - st AS blen, 60 AS mapq, sample AS qname, CAST(0 AS BIGINT) AS qs, en - st AS qe, strand, qty FROM v_iv WHERE qty >= 2)"""


def _paf(iv: DataFrame) -> DataFrame:
    """An alignment of each interval: a substitution after a quarter, two letters gone after half of it and two more right after."""
    n = F.col("qty").cast("string")
    cs = F.concat(F.lit(":"), n, F.lit("*ac:"), n, F.lit("-gg+tt:"), (2 * F.col("qty") - 3).cast("string"))
    rows = iv.where("qty >= 2").select("id", F.col("contig").alias("tname"), F.col("st").alias("ts"), F.col("en").alias("te"), (F.col("en") - F.col("st")).alias("blen"), F.lit(60).alias("mapq"), F.col("sample").alias("qname"), F.lit(0).cast("long").alias("qs"), (F.col("en") - F.col("st")).alias("qe"), "strand", cs.alias("cs"))
    return rows.dropDuplicates(["id"])


CALLED = f"""WITH {PAF}, u AS (SELECT DISTINCT * FROM p),
    d AS (SELECT id, tname, ts + qty AS st, ts + qty + 1 AS en, 'a' AS ref, 'c' AS alt, ts, te, CASE WHEN strand = '-' THEN qe - qty - 1 ELSE qs + qty END AS qs FROM u
        UNION ALL SELECT id, tname, ts + 2 * qty + 1, ts + 2 * qty + 3, 'gg', '-', ts, te, CASE WHEN strand = '-' THEN qe - 2 * qty - 1 ELSE qs + 2 * qty + 1 END FROM u
        UNION ALL SELECT id, tname, ts + 2 * qty + 3, ts + 2 * qty + 3, '-', 'tt', ts, te, CASE WHEN strand = '-' THEN qe - 2 * qty - 3 ELSE qs + 2 * qty + 1 END FROM u),
    m AS (SELECT d.id, d.st, d.ref, count(*) AS more FROM d JOIN u j ON j.tname = d.tname AND j.id <> d.id AND j.ts <= d.st AND j.te >= d.st
        WHERE CASE WHEN (j.ts, j.te, j.id) < (d.ts, d.te, d.id) THEN j.te > d.st ELSE j.te >= d.en AND j.ts < d.en END GROUP BY 1, 2, 3)"""


@query("paf_variants", "v_iv", f"""
    {CALLED}
    SELECT d.id, d.tname AS contig, d.st, d.en, d.ref, d.alt, d.qs, coalesce(m.more, 0) + 1 AS depth FROM d LEFT JOIN m ON m.id = d.id AND m.st = d.st AND m.ref = d.ref""")
def _(iv: DataFrame) -> DataFrame:
    return calls.call_variants(_paf(iv), cover=1, long=1).select("id", "contig", "st", "en", "ref", "alt", "qs", "depth")


@query("call_statistics", "v_iv", f"""
    {CALLED}, c AS (SELECT d.* FROM d LEFT JOIN m ON m.id = d.id AND m.st = d.st AND m.ref = d.ref WHERE coalesce(m.more, 0) = 0)
    SELECT kind, within, count(*) AS n FROM (SELECT CASE WHEN ref = '-' THEN 'ins' WHEN alt = '-' THEN 'del' WHEN ref || alt IN ('ag', 'ga', 'ct', 'tc') THEN 'ts' ELSE 'tv' END AS kind,
        CASE WHEN ref = '-' THEN length(alt) WHEN alt = '-' THEN length(ref) END AS within FROM c) GROUP BY kind, within""")
def _(iv: DataFrame) -> DataFrame:
    return calls.call_statistics(calls.call_variants(_paf(iv), cover=1, long=1))


@query("paf_covered_once", "v_iv", """
    WITH u AS (SELECT DISTINCT id, contig, st, en FROM v_iv WHERE qty >= 2), e AS (SELECT contig, st AS pos, 1 AS d, CASE WHEN en - st >= 100 THEN 1 ELSE 0 END AS l FROM u UNION ALL SELECT contig, en, -1, CASE WHEN en - st >= 100 THEN -1 ELSE 0 END FROM u),
    s AS (SELECT contig, pos, sum(d) AS d, sum(l) AS l FROM e GROUP BY contig, pos),
    r AS (SELECT contig, pos AS st, lead(pos) OVER w AS en, sum(d) OVER w AS depth, sum(l) OVER w AS lng FROM s WINDOW w AS (PARTITION BY contig ORDER BY pos)) SELECT contig, st, en FROM r WHERE depth = 1 AND lng = 1 AND en IS NOT NULL""")
def _(iv: DataFrame) -> DataFrame:
    return calls.covered_once(_paf(iv), long=100)


@query("lift_regions", "v_iv", """
    WITH u AS (SELECT DISTINCT id, sample, strand, contig, st, en, qty FROM v_iv WHERE qty >= 2), r AS (SELECT DISTINCT sample AS contig, line * 4 - 1 AS st, line * 4 + 2 AS en FROM v_iv),
    x AS (SELECT u.*, r.st AS r0, r.en AS r1, 4 * qty AS n FROM u JOIN r ON r.contig = u.sample AND r.st < 4 * u.qty)
    SELECT contig, CASE WHEN strand = '+' THEN st + r0 WHEN r1 <= n THEN st + n - r1 ELSE st END AS st, CASE WHEN strand = '-' THEN st + n - r0 WHEN r1 <= n THEN st + r1 ELSE en END AS en, strand,
        CASE WHEN r1 <= n THEN '' WHEN strand = '-' THEN '_t5' ELSE '_t3' END AS clamped, count(*) AS n FROM x GROUP BY ALL""")
def _(iv: DataFrame) -> DataFrame:
    n = F.col("qe").cast("string")
    paf = _paf(iv).withColumn("qlen", F.col("qe")).withColumn("cg", F.concat(n, F.lit("M"))).withColumn("nmatch", F.col("qe"))
    regions = iv.select(F.col("sample").alias("contig"), (F.col("line") * 4 - 1).alias("st"), (F.col("line") * 4 + 2).alias("en")).distinct()
    lifted = calls.lift_regions(paf, regions, length=1, bin_size=256).withColumn("clamped", F.regexp_extract("name", "(_t5|_t3)$", 1))
    return lifted.groupBy("contig", "st", "en", "strand", "clamped").agg(F.count("*").alias("n"))


@query("overlap_eval", "v_iv", """
    WITH f AS (SELECT DISTINCT least(okey, pkey) AS a, greatest(okey, pkey) AS b FROM v_iv WHERE line <= 3 AND okey <> pkey), t AS (SELECT DISTINCT least(okey, pkey) AS a, greatest(okey, pkey) AS b FROM v_iv WHERE line >= 2 AND okey <> pkey)
    SELECT (SELECT count(*) FROM t) AS truths, (SELECT count(*) FROM f) AS found, (SELECT count(*) FROM t JOIN f USING (a, b)) AS both""")
def _(iv: DataFrame) -> DataFrame:
    pair = iv.select(F.col("okey").alias("a"), F.col("pkey").alias("b"), "line")
    return calls.overlap_counts(pair.where("line <= 3").drop("line"), pair.where("line >= 2").drop("line"))


GENES = f"""u AS (SELECT DISTINCT id, pkey AS gene, 100 + pkey % 120 AS qlen, line * 10 AS qs, line * 10 + qty * 4 AS qe, qty * 4 - okey % 3 AS nmatch, qty * 4 AS blen, contig AS tname, st AS ts, en AS te, sample, {NO['duck']} AS no FROM v_iv),
    ok AS (SELECT * FROM u WHERE nmatch >= blen * CAST(0.97 AS DOUBLE)), iv AS (SELECT *, sample < 'S3' AS r, max(qe) OVER (PARTITION BY gene, sample < 'S3' ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ok),
    cv AS (SELECT gene, r, CAST(sum(greatest(0, qe - greatest(qs, coalesce(reach, qs)))) AS DOUBLE) / max(qlen) AS share, count_if(qe - qs >= qlen * CAST(0.9 AS DOUBLE)) AS whole FROM iv GROUP BY gene, r)"""


@query("gene_status", "v_iv", f"""
    WITH RECURSIVE {GENES}, p AS (SELECT gene, arg_max(tname, no) AS tname, arg_max(ts, no) AS ts, arg_max(te, no) AS te, any_value(qlen) AS qlen FROM u WHERE sample < 'S3' GROUP BY gene),
    n AS (SELECT *, row_number() OVER (PARTITION BY tname ORDER BY ts, gene) AS k FROM p),
    w AS (SELECT tname, k, gene, te, qlen, CAST(NULL AS BIGINT) AS done FROM n WHERE k = 1 UNION ALL
        SELECT n.tname, n.k, CASE WHEN n.ts >= w.te OR n.qlen > w.qlen THEN n.gene ELSE w.gene END, CASE WHEN n.ts >= w.te OR n.qlen > w.qlen THEN n.te ELSE w.te END, CASE WHEN n.ts >= w.te OR n.qlen > w.qlen THEN n.qlen ELSE w.qlen END, CASE WHEN n.ts >= w.te THEN w.gene END
        FROM w JOIN n ON n.tname = w.tname AND n.k = w.k + 1),
    keep AS (SELECT done AS gene FROM w WHERE done IS NOT NULL UNION SELECT arg_max(gene, k) FROM w GROUP BY tname),
    x AS (SELECT a.gene, a.whole AS held, coalesce(b.whole, 0) AS n, coalesce(b.share, 0) AS share FROM cv a JOIN keep USING (gene) LEFT JOIN cv b ON b.gene = a.gene AND NOT b.r WHERE a.r AND a.whole >= 1),
    y AS (SELECT CASE WHEN n = 1 THEN 'full_sgl' WHEN n > 1 THEN 'full_dup' WHEN share >= 0.9 THEN 'frag' WHEN share >= 0.5 THEN 'part50+' WHEN share >= 0.1 THEN 'part10+' ELSE 'part10-' END AS metric FROM x WHERE held = 1)
    SELECT metric, count(*) AS n FROM y GROUP BY metric UNION ALL SELECT 'dup_cnt', count_if(n > 1) FROM x WHERE held > 1 UNION ALL SELECT 'dup_sum', CAST(coalesce(sum(n), 0) AS BIGINT) FROM x WHERE held > 1""")
def _(iv: DataFrame) -> DataFrame:
    n = F.col("qty") * 4
    paf = iv.dropDuplicates(["id"]).select(
        F.col("pkey").alias("qname"), (100 + F.col("pkey") % 120).alias("qlen"), (F.col("line") * 10).alias("qs"), (F.col("line") * 10 + n).alias("qe"), (n - F.col("okey") % 3).alias("nmatch"), n.alias("blen"),
        F.col("contig").alias("tname"), F.col("st").alias("ts"), F.col("en").alias("te"), "sample", F.expr(NO["spark"]).alias("no"),
    )
    paf = settled(paf, "genes")  # read for every part
    ref, own = paf.where("sample < 'S3'"), paf.where("sample >= 'S3'")
    return calls.gene_counts(calls.gene_status(calls.gene_cover(ref, 0.9, 0.97), calls.gene_cover(own, 0.9, 0.97), calls.distinct_genes(ref), 0.9))


@query("alignment_stats", "v_iv", f"""
    WITH {STEPS}, r AS (SELECT *, (okey % 3 > 0) AS pri, 1000 + okey % 500 AS qlen FROM u), iv AS (SELECT *, max(qe) OVER (PARTITION BY okey ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r WHERE pri)
    SELECT count(DISTINCT okey) AS queries, count(*) AS primary, (SELECT count(*) FROM r WHERE NOT pri) AS secondary, 0 AS long_cigars, (SELECT CAST(sum(l) AS BIGINT) FROM (SELECT max(qlen) AS l FROM r WHERE pri GROUP BY okey)) AS length,
        CAST(sum(greatest(0, qe - greatest(qs, coalesce(reach, qs)))) AS BIGINT) AS covered, CAST(sum(greatest(0, qty % 4 - qty % 2)) AS BIGINT) AS subs FROM iv""")
def _(iv: DataFrame) -> DataFrame:
    n = F.col("qty")
    cg = F.concat((3 * n).cast("string"), F.lit("M"), F.col("line").cast("string"), F.lit("D"), n.cast("string"), F.lit("M"))
    return calls.alignment_stats(_steps(iv).withColumns({"cg": cg, "nm": F.col("line") + n % 4, "nn": n % 2, "s2": F.when(F.col("qname") % 3 > 0, 1)}))


@query("gap_counts", "v_iv", f"""
    WITH c AS (SELECT {CIGAR} AS cg FROM v_iv), o AS (SELECT CAST(unnest(regexp_extract_all(cg, '([0-9]+)([MIDNSHP=X])', 1)) AS BIGINT) AS n, unnest(regexp_extract_all(cg, '([0-9]+)([MIDNSHP=X])', 2)) AS op FROM c)
    SELECT op, CASE WHEN n < 50 THEN 50 WHEN n < 100 THEN 100 WHEN n < 300 THEN 300 WHEN n < 400 THEN 400 WHEN n < 1000 THEN 1000 END AS under, count(*) AS n, CAST(sum(n) AS BIGINT) AS letters FROM o WHERE op IN ('I', 'D') GROUP BY 1, 2""")
def _(iv: DataFrame) -> DataFrame:
    return calls.gap_counts(iv.select(F.expr(CIGAR).alias("cg")))


@query("assembly_stats", "v_iv", f"""
    WITH {STEPS}, z AS (SELECT * REPLACE (qs * 10 AS qs, qe * 10 AS qe), CAST(1000 + okey % 500 AS BIGINT) * 10 AS qlen, CAST(substring(tname, 2) AS BIGINT) AS tn FROM u), t AS (SELECT z.* FROM z JOIN (SELECT DISTINCT id, pkey FROM v_iv) x ON x.id = z.id WHERE x.pkey % 7 <> 0),
    ok AS (SELECT * FROM t WHERE qty * 4 >= 40 AND CAST(qty % 3 + 1 AS DOUBLE) / (4 * qty + 1) <= 0.05), f AS (SELECT okey, min(no) AS first FROM ok GROUP BY okey),
    src AS (SELECT tname AS contig, ts AS st, te AS en FROM ok), {ISLANDS}, {SWEEP}, qsrc AS (SELECT okey, qs, qe, max(qe) OVER (PARTITION BY okey ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ok),
    lens AS (SELECT okey, max(qlen) AS len FROM z GROUP BY okey), ran AS (SELECT len, sum(len) OVER (ORDER BY len DESC, okey) AS run FROM lens),
    pv AS (SELECT *, lag(qe) OVER (PARTITION BY okey ORDER BY qs, no) AS pe FROM ok), kp AS (SELECT *, CASE WHEN qs < pe THEN qe - pe ELSE qe - qs END AS len FROM pv WHERE pe IS NULL OR qs >= pe OR qe >= pe),
    st AS (SELECT *, lag(qe) OVER w AS lq, lag(strand) OVER w AS ls, lag(tname) OVER w AS lt, lag(ts) OVER w AS l0, lag(te) OVER w AS l1 FROM kp WINDOW w AS (PARTITION BY okey ORDER BY qs, no)),
    gp AS (SELECT len, CASE WHEN lq IS NULL THEN NULL WHEN ls = strand AND lt = tname THEN abs((qs - lq) - (CASE WHEN strand = '+' THEN ts - l1 ELSE l0 - te END)) ELSE 1000000000 END AS gap FROM st),
    br AS (SELECT len, sum(len) OVER (ORDER BY len DESC, rn) AS run FROM (SELECT len, row_number() OVER () AS rn FROM kp))
    SELECT (SELECT CAST(sum(len) AS BIGINT) FROM lens) AS length, (SELECT CAST(sum(en - st) AS BIGINT) FROM m) AS l_cov, (SELECT round(100.0 * sum(en - st) / 600000, 2) FROM m) AS rcov,
        (SELECT round(100.0 * (a - b) / a, 2) FROM (SELECT CAST(sum(CASE WHEN depth > 0 THEN en - st ELSE 0 END) AS DOUBLE) AS a, sum(CASE WHEN depth = 1 THEN en - st ELSE 0 END) AS b FROM runs WHERE en IS NOT NULL)) AS rdup,
        (SELECT round(100.0 * (SELECT sum(greatest(0, qe - greatest(qs, coalesce(reach, qs)))) FROM qsrc) / sum(len), 2) FROM lens) AS qcov,
        (SELECT max(len) FROM ran WHERE run > 450000) AS ng75, (SELECT max(len) FROM ran WHERE run > 300000) AS ng50, (SELECT max(len) FROM br WHERE run > 300000) AS nga50,
        (SELECT round(CAST(sum(greatest(0, least(len, 600000 - (run - len))) * greatest(0, least(len, 600000 - (run - len)))) AS DOUBLE) / 600000) FROM br) AS aunga,
        (SELECT count(*) FROM t JOIN f ON f.okey = t.okey WHERE t.no > f.first) AS breaks, (SELECT count(*) FROM gp WHERE len >= 500 AND gap >= 0) AS bp, (SELECT count(*) FROM gp WHERE len >= 500 AND gap >= 10000) AS bp10k""")
def _(iv: DataFrame) -> DataFrame:
    n = F.col("qty")
    paf = _steps(iv).withColumns({c: F.col(c) * 10 for c in ("qs", "qe", "qlen")}).withColumn("cg", F.concat((3 * n).cast("string"), F.lit("M"), F.col("line").cast("string"), F.lit("D"), n.cast("string"), F.lit("M"))).withColumn("nm", F.col("line") + n % 3)
    return calls.assembly_stats(paf, 600_000, segment=400, most=0.05)
