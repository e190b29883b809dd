"""Plain walks, and what plans may hold, of the queries mended after round 3."""

import random

from pyspark import TaskContext
from pyspark.sql import functions as F

from genoweave.operators import aligners, folds, intervals, kernels, tiles
from genoweave.plans import assess, calls, catalog, genotype

rnd = random.Random(77)
PAF = "id string, qname string, qs long, qe long, strand string, tname string, ts long, te long, blen long, mapq int, cs string"


def paf_rows(n, reach, tiles):
    out = []
    for i in range(n):
        ops, size = [], 0
        for _ in range(rnd.choice((1, 3, 30))):
            k = rnd.randint(1, 9)
            ops += [f":{k}", rnd.choice(("*ac", "-gga", "+tt", "-g"))]
            size += k + {"*": 1, "-": len(ops[-1]) - 1, "+": 0}[ops[-1][0]]
        ts = rnd.randrange(reach)
        out.append((f"r{i}", "q", 0, 500, rnd.choice("+-"), rnd.choice(tiles), ts, ts + size, size, 60, "".join(ops)))
    return out


def plain_depths(rows):
    out = []
    for r in rows:
        t, q = r[6], 0
        for op, arg, on_t, on_q in calls._steps(r[10]):
            if op in "*+-":
                st, en, depth = t, t + on_t, 1
                for o in rows:
                    if o[5] == r[5] and o[0] != r[0] and o[6] <= st <= o[7]:
                        depth += o[7] > st if (o[6], o[7], o[0]) < (r[6], r[7], r[0]) else o[7] >= en and o[6] < en
                out.append((r[0], r[5], st, en, depth, r[3] - q - on_q if r[4] == "-" else r[2] + q))
            t, q = t + on_t, q + on_q
    return sorted(out)


def test_depths_by_tiles(spark, monkeypatch):
    """Alignments over many tiles, with a cs that goes in pieces, against all pairs; nothing is joined (before: four joins)."""
    monkeypatch.setattr(calls, "UNCUT", 40)
    rows = paf_rows(300, 400, ["t", "u"])
    found = calls.call_variants(spark.createDataFrame(rows, PAF), cover=1, long=1, bin_size=16)
    assert sorted((r["id"], r["contig"], r["st"], r["en"], r["depth"], r["qs"]) for r in found.collect()) == plain_depths(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Join" not in plan and "Union" not in plan


def test_islands_of_equal_rows(spark, monkeypatch):
    """Equal rows that come in another order in each pass are of one island."""
    real, passes = intervals.beside, []

    def turned(df, *args, **kwargs):
        passes.append(1)
        order = F.asc("id") if len(passes) % 2 else F.desc("id")
        return real(df.orderBy(order).limit(99), *args, **kwargs)

    monkeypatch.setattr(intervals, "beside", turned)
    rows = [("a", "c", 0, 5), ("b", "c", 10, 20), ("d", "c", 10, 20), ("e", "c", 10, 20), ("f", "c", 19, 30)]
    df = spark.createDataFrame(rows, "id string, contig string, st long, en long")
    assert {(r["id"], r["island"]) for r in intervals.islands(df, touch=False).collect()} == {("a", 0), *((x, 10) for x in "bdef")}


def test_islands_stream_through_a_task(spark):
    """Islands longer than a batch are cut as in one; no task starts a group for each island."""
    rows = [(i, "t", 10 * i + i // 40 * 100, "ACGT" * 8 if i % 3 else "ACGA" * 8, "S0", "q", 50 * i, "-" if i % 5 == 0 else "+", 100_000, "ACGT" * 8) for i in range(120)]
    df = spark.createDataFrame(rows, "block long, contig string, t_start long, t_text string, sample string, q_contig string, q_start long, q_strand string, q_size long, q_text string")
    once = lambda: kernels.single_coverage(df)
    whole = sorted(once().collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(once().collect()) == whole and len(whole) > 20
        plan = once()._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "MapInArrow" in plan and "FlatMapGroupsInArrow" not in plan


def block_pair(n):
    """Two blocks of gapped rows with the same letters on top."""
    seq = [rnd.choice("ACGT") for _ in range(n)]

    def block(rows):
        cols = []
        for c in seq:
            while rnd.random() < 0.1:
                cols.append(["-", *(rnd.choice("ACGT-") for _ in range(rows))])
            cols.append([c, *(rnd.choice([c, c, c, "N", "-"]) for _ in range(rows))])
        cols = [c for c in cols if set(c) != {"-"}]
        return ["".join(c[i] for c in cols) for i in range(rows + 1)]

    return block(rnd.randint(1, 4)), block(rnd.randint(1, 4))


def test_blocks_aligned_side_by_side(monkeypatch):
    """Many narrow pairs at a time give the rows of each alone, in bands of any width and however many go together."""
    pairs = [block_pair(rnd.randint(1, 45)) for _ in range(150)] + [(["ACGT", "AC-T"], ["ACGT", "----"]), (["A"], ["A"]), block_pair(400)]
    for radius, together in ((30, 1 << 22), (2, 1 << 12), (1, 1)):
        monkeypatch.setattr(aligners, "TOGETHER", together)
        assert aligners.align_many(pairs, radius) == [aligners.align_blocks(a, b, radius) for a, b in pairs]


def test_junctions_are_not_broadcast(spark):
    """However small the planner takes the annotated junctions to be, their bins do not pass through the driver."""
    j = spark.createDataFrame([("a", "c", 10, 5000), ("b", "c", 90, 400)], "id string, contig string, st long, en long")
    ann = spark.createDataFrame([("c", 12, 4990), ("c", 300, 700)], "contig string, st long, en long")
    found = assess.junction_hits(j, ann, 20)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r["id"], r["hit"]) for r in found.collect()} == {("a", 1), ("b", 0)}


def test_overlaps_of_many_keys_are_dropped_as_in_a_walk(spark, monkeypatch):
    """Short and long keys, keys over the borders of tasks and of batches, a key over several tasks, equal rows; only rows of keys at borders are walked (before: all)."""
    rows = [(f"k{rnd.randrange(90):02d}" if rnd.random() < 0.6 else rnd.choice(("k07", None)), f"i{i % 900}", s := rnd.randrange(3000), s + rnd.randrange(0, 40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "sv string, id string, st long, en long")
    want, last = [], {}
    for k, i, s, e in sorted(rows, key=lambda r: (r[0] or "", r[2], r[3], r[1])):
        p = last.get(k)
        if not p or (min(e, p[1]) - max(s, p[0]) + 1) / (e - s + 1) <= 0.1:
            want.append((k or "", s, e, i))
            last[k] = (s, e)
    walked = []
    real = folds.walk
    monkeypatch.setattr(folds, "walk", lambda d, *a, **k: walked.append(d.count()) or real(d, *a, **k))
    for size in ("10000", "50"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        for parts in (1, 3, 12, 40):
            found = folds.drop_overlaps_of_many(df, ["sv"], parts=parts)
            assert sorted((r["sv"] or "", r["st"], r["en"], r["id"]) for r in found.collect()) == sorted(want)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert walked[1] < len(rows)
    few = df.where("sv <> 'k07'")
    n = len(walked)
    folds.drop_overlaps_of_many(few, ["sv"], parts=3).count()
    assert walked[n] < few.count() / 5


def test_insertions_are_ruled_out_before_their_words_are_looked_up(spark, monkeypatch):
    """What cannot share half of its 4-mers is not compared word by word (before: all of the last 21 are), and nothing that shares them is ruled out."""
    text = lambda n: "".join(rnd.choice("ACGT" if rnd.random() < 0.9 else "AaN") for _ in range(n))
    for _ in range(4000):
        a = text(rnd.randrange(0, 60)) if rnd.random() < 0.7 else text(3) * rnd.randrange(1, 18)
        b = a[: rnd.randrange(len(a) + 1)] + text(rnd.randrange(0, 30))
        size = rnd.randrange(6, 50)
        assert folds._may_share(a, size, b) or not folds.kmers_shared(a, b, 4, size) > 0.5
    far = [(text(32), text(32)) for _ in range(500)]
    assert sum(folds._may_share(a, 32, b) for a, b in far) < 50


def test_each_stretch_of_a_walk_has_a_task(spark):
    """Twelve stretches are walked by twelve tasks, or nearly (before: by hash, and put together while they are few bytes)."""
    df = spark.range(6000).select(F.lit("k").alias("k"), F.col("id"))
    found = folds.walk(df, ["k"], ["id"], lambda: None, lambda s, r: (None, TaskContext.get().partitionId()), "task", "int", ["id"], parts=12)
    assert found.select("task").distinct().count() >= 9


def test_deletions_in_sql_are_walked_island_by_island(spark, tmp_path):
    """No task has a contig's rows only because they are of one contig (before: PARTITION BY contig); clusters are those of one walk."""
    rows = [(rnd.randrange(4), rnd.choice((1, 2, 3, 40, 41, 90)), i % 7, i, 1.0 + rnd.randrange(50), 1.0, "A", "2020-01-01") for i in range(300)]
    kind = "l_suppkey long, l_partkey long, l_linenumber long, l_orderkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate string"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(1).write.parquet(str(tmp_path / "part.parquet"))  # looked for, not read
    got = catalog.QUERIES["deletions_in_sql"](spark, str(tmp_path))
    assert "island" in got._jdf.queryExecution().analyzed().toString()
    calls_ = spark.table("v_calls")
    plain = spark.sql("SELECT * FROM merge_deletions(TABLE(SELECT contig, beg, end, len, id FROM v_calls) PARTITION BY contig ORDER BY (beg, end, len, id))")
    assert calls_.select("contig", "island").distinct().count() > calls_.select("contig").distinct().count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def _exchanges(df):
    """The exchanges of whole rows in a plan, and its joins."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("RepartitionBy"), plan.count("Join")


def test_flanks_by_one_exchange(spark, monkeypatch):
    """Neighbours over many tiles, empty ones too, against a plain walk; rows are joined with nothing (before: a join for each side)."""
    monkeypatch.setattr(intervals, "TILE", 64)
    rows = [(f"i{k}", rnd.choice(["c", "d", None]), st, st + rnd.randint(1, 90), 0, 5000) for k, st in enumerate(rnd.choices([*range(300), *range(2000, 2300)], k=200))]
    df = spark.createDataFrame(rows, "id string, contig string, st long, en long, lo int, hi int")
    found = intervals.flanks(df, ("contig",), "lo", "hi")
    assert _exchanges(found)[1] == 0
    plain = {}
    for c in ("c", "d", None):
        own = sorted((r[2], r[3], r[0]) for r in rows if r[1] == c)
        for k, (st, en, i) in enumerate(own):
            plain[i] = (st - (own[k - 1][1] if k else 0), (own[k + 1][0] if k + 1 < len(own) else 5000) - en)
    assert {r["id"]: (r["five"], r["three"]) for r in found.collect()} == plain


def test_carries_without_a_join(spark):
    """Sums, least and largest before and after each row, over tiles and a NULL group (before: rows were joined with their tiles)."""
    rows = [(k, rnd.choice(["c", None]), rnd.randrange(400), rnd.randint(-5, 5)) for k in range(150)]
    df = spark.createDataFrame(rows, "id long, contig string, pos long, x int")
    for before in (True, False):
        values = {"s": ("sum", F.col("x")), "hi": ("max", F.col("x")), "lo": ("min", F.struct("x", "id"))}
        found = tiles.beside(df, ("contig",), "pos", ["pos", "id"], values, before=before, tile=16)
        assert _exchanges(found)[1] == 0
        for r in found.collect():
            key = (r["pos"], r["id"])
            other = [o for o in rows if o[1] == r["contig"] and ((o[2], o[0]) < key if before else (o[2], o[0]) > key)]
            lo = min(((o[3], o[0]) for o in other), default=None)
            assert (r["s"], r["hi"], r["lo"] and tuple(r["lo"])) == (sum(o[3] for o in other), max((o[3] for o in other), default=None), lo)


def test_assembly_lines_are_read_once(spark):
    """The lines are put together once, however many figures read them (before: once for each)."""
    rows = [(f"q{k % 9}", 1000, 10 * k, 10 * k + 450, "+", "t", 40 * k, 40 * k + 450, "P", "440M5D10M", 7, k) for k in range(40)]
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(rows, "qname string, qlen long, qs long, qe long, strand string, tname string, ts long, te long, type string, cg string, nm int, no long")

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    calls.assembly_stats(df.mapInArrow(count, df.schema), 5000, segment=400, most=0.05).collect()
    assert seen.value == len(rows)


def test_indels_as_a_table(spark):
    """Ends in runs of other bins, unmapped ends and variants that nothing holds, as pivot gives them; one reading of the variants and no join of the calls (before: two of each)."""
    runs = [("S0", "c", 0, 1021, "q", 100, 1), ("S0", "c", 1022, 1100, "q", 1130, 1), ("S1", "c", 0, 3000, "q", 9000, -1), ("S2", "d", 5, 90, "q", 5, 1), ("S0", "c", 1030, 1040, "q", 500, 1)]
    runs = spark.createDataFrame(runs, "sample string, contig string, t_from long, t_to long, q_name string, q_from long, step int")
    rows = [("c", b, b + (n if kind == "DEL" else 0), n, kind) for b in (3, 1018, 1019, 1020, 1021, 1022, 1024, 1035, 2990, 4000) for n in (1, 3, 6) for kind in ("DEL", "INS")] + [("d", 1, 2, 1, "DEL"), (None, 4, 5, 1, "DEL")]
    variants = spark.createDataFrame(rows, "contig string, beg long, fin long, len long, kind string")
    samples = ["S0", "S1", "S2"]
    table = genotype.indel_table(variants, runs, samples)
    assert _exchanges(table)[1] == 1
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, table.collect()), key=key) == sorted([*map(tuple, genotype.pivot(genotype.genotype_indel(variants, runs), variants, samples).where("contig IS NOT NULL").collect()), (None, 4, 5, 1, "DEL", ".|.", ".|.", ".|.")], key=key)
    ends = genotype._ends(variants, runs, F.when(F.col("kind") == "DEL", F.col("beg")).otherwise(F.col("beg") - 2), F.col("fin") + 2)
    both = ends.groupBy(*genotype.KEY, "sample").agg(genotype._end(False).alias("a"), genotype._end(True).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    assert both.select(*genotype.KEY, "sample").exceptAll(genotype.genotype_indel(variants, runs).select(*genotype.KEY, "sample")).count() == 0


def test_calls_meet_by_sign(spark):
    """Calls of the two signs in one place, against all pairs; the sign is part of the join's key (before: a filter behind it)."""
    rows = [(k, rnd.choice("cd"), st, st + rnd.randint(0, 60), rnd.choice((-1, 1)) * rnd.randint(0, 60)) for k, st in enumerate(rnd.choices(range(900), k=120))]
    sides = [rows[:60], rows[60:]]
    base, call = (spark.createDataFrame(r, "id long, contig string, st long, en long, change long") for r in sides)
    found = assess._sv_matches(base, call, 50, 20, 0.5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and "__sign" in line for line in plan.split("\n"))
    right = 0
    for _, c, st, en, change in (r for r in sides[0] if abs(r[4]) >= 20):
        w = 50 + abs(change) // 2
        near = [abs(o[4]) for o in sides[1] if o[1] == c and o[4] * change > 0 and max(0, st - w) < o[3] and o[2] < en + w]
        right += len(near) > 1 or (len(near) == 1 and (abs(near[0] - abs(change)) < 20 or abs(near[0] - abs(change)) / abs(change) < 0.5))
    assert tuple(found.first()) == (sum(abs(r[4]) >= 20 for r in sides[0]), right)


def test_segments_are_read_once(spark):
    """The segments are put together once, whatever reads them (before: for the centromeres and for the rows)."""
    rows = [(k, f"q{k % 5}", 10 * k, 10 * k + 9, rnd.choice("+-"), rnd.choice("tu"), 50 * k, 50 * k + 40, 45) for k in range(40)]
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(rows, "id long, qname string, qs long, qe long, strand string, tname string, ts long, te long, blen long")

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    cen = spark.createDataFrame([("t", 100, 400)], "contig string, st long, en long")
    found = {tuple(r) for r in assess.misjoins(df.mapInArrow(count, df.schema), cen, least=40, far=20).collect()}
    assert seen.value == len(rows)
    plain = {(r["id"], r["kind"]) for r in assess.misjoins(df, None, least=40, far=20).collect()}
    assert {f[:2] for f in found} == plain and any(f[2] for f in found) and not all(f[2] for f in found)


def test_digests_travel_as_bytes(spark):
    """Half the bytes of their digits (before: digits)."""
    found = catalog.QUERIES["junction_fuzzy"](spark, "/root/testdata/sf0.001")
    assert "unhex(" in found._jdf.queryExecution().optimizedPlan().toString()
    assert all(len(r["id"]) == 32 and r["id"] == r["id"].lower() for r in found.limit(50).collect())
