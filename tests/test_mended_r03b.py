"""What plans may hold, of the queries mended in the third pass on the findings of round 3."""

import random

from genoweave.operators import intervals
from genoweave.plans import calls, catalog, genotype

TINY = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cigars_are_read_once_for_each_alignment(spark):
    """The operations are at hand where alignments meet regions (before: read again for every pair)."""
    paf = "qname string, qlen long, qs long, qe long, strand string, tname string, ts long, te long, nmatch long, blen long, mapq int, cg string"
    rows = [("q", 20, 0, 20, "+", "t", 100, 120, 20, 20, 60, "10M2I2D8M"), ("q", 20, 0, 20, "-", "t", 300, 320, 20, 20, 60, "20M")]
    regions = spark.createDataFrame([("q", 3, 6), ("q", 10, 14)], "contig string, st long, en long")
    found = calls.lift_regions(spark.createDataFrame(rows, paf), regions, length=1)
    assert sorted((r["st"], r["en"], r["strand"]) for r in found.collect()) == [(103, 106, "+"), (110, 114, "+"), (306, 310, "-"), (314, 317, "-")]
    plan = plan_of(found)
    assert "regexp_extract_all" in plan[plan.index("Join") :] and "regexp_extract_all" not in plan[: plan.index("Join")]


def test_reads_meet_their_first_alignment_without_a_join(spark):
    """The table is read once and the reads' places are told by the rows themselves (before: read twice, joined)."""
    plan = plan_of(catalog.QUERIES["map_eval"](spark, TINY))
    assert "Join" not in plan and plan.count("Relation [") == 1


def test_inversions_are_summed_where_they_meet(spark):
    """A member's rows go without a join with the members; a genome without members counts (before: joined again, all pairs exchanged)."""
    v = spark.createDataFrame([(1, "c", 100, 200, ["A.x", "B.y"]), (2, "c", 1000, 1100, None)], "id long, contig string, st long, en long, members array<string>")
    rows = [(s, q, "c", st, st + n, d) for s in "ABC" for q in ("p", "q") for st, n, d in ((50, 50, "+"), (100, 100 if q == "q" else 90, "-"), (200, 50, "+"), (1000, 100, "+"))]
    df = spark.createDataFrame(rows, "sample string, q_name string, contig string, st long, en long, strand string")
    found = genotype.genotype_inv(v, df)
    want = {(1, "A", None, "1|1"), (1, "B", None, "1|1"), (1, "C", "q", "1|1"), *((2, s, "p", "0|0") for s in "ABC")}
    assert {tuple(r) for r in found.collect()} == want
    assert {tuple(r) for r in genotype.genotype_inv(v.drop("members"), df).collect()} == {(1, s, "q", "1|1") for s in "ABC"} | {(2, s, "p", "0|0") for s in "ABC"}
    assert "LeftAnti" not in plan_of(found)


def test_deletions_send_no_blocks_through_the_driver(spark):
    """Neither runs nor pieces are broadcast, however small their file is (before: both were), and blocks are dealt out first."""
    blk = catalog.register(spark, TINY, "v_blk")["v_blk"]
    v = catalog.register(spark, TINY, "v_indel")["v_indel"].where("kind = 'DEL'").selectExpr("*", "8 AS five", "8 AS three")
    plan = genotype.genotype_deletions(v, blk, slack=2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan and "REPARTITION_BY_NUM" in plan


def test_islands_by_one_exchange(spark, monkeypatch):
    """Islands that go through many tiles, some of which begin none, against a walk; no island is grouped or exchanged (before: grouped twice, exchanged once)."""
    monkeypatch.setattr(intervals, "TILE", 8)
    rnd = random.Random(5)
    rows = [(c, st, st + rnd.choice((0, 1, 2, 5, 9, 60))) for c in ("a", "b", None) for st in (rnd.randrange(1500) for _ in range(150))]
    rows += [("z", 5, 900), ("z", 7, 10), ("z", 899, 1000), ("z", 1001, 1002), ("y", 3, 3), ("y", 3, 3), ("x", 0, 100), ("x", 90, 95)]
    want = []
    for c, st, en in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if want and want[-1][0] == c and st <= want[-1][2]:
            want[-1][2] = max(want[-1][2], en)
        else:
            want.append([c, st, en])
    found = intervals.merge_intervals(spark.createDataFrame(rows, "contig string, st long, en long"))
    assert sorted(map(list, found.collect()), key=str) == sorted(want, key=str)
    plan = plan_of(found)
    assert "__run" not in plan and not any("Aggregate [contig" in x and ", st#" in x.split("]")[0] for x in plan.splitlines())


def test_insertions_deal_out_their_blocks(spark, monkeypatch):
    """The blocks' file is few bytes, so one task made all runs (before)."""
    seen, real = [], catalog.posmap.position_runs
    monkeypatch.setattr(catalog.posmap, "position_runs", lambda b: seen.append(plan_of(b)) or real(b))
    catalog.QUERIES["genotype_ins"](spark, TINY)
    assert seen and seen[0].startswith("Repartition")
