"""Operator 11: sources mixed to target weights by systematic sampling.

A source's target follows its weight; what exceeds `most` times the source's size is shared again among the others. All
documents of a source expect the same number of copies, target / size of the source. Laid out by size, their expected copies are summed up,
one random offset for each source is added, and a document is emitted once for each integer that the sum crosses at it. Order by size
makes neighbours alike, so the words taken differ from the target by at most the source's longest document.

Ranks come from a range partitioning by source and size: a source's rows lie in as many tasks as its share asks for, and only one row for
each source and task is summed up along the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import cut, drop_cut

WORD = r"[^\x20\x09-\x0D]+"
#: Copies are counted in units of 1 / UNIT, so that sums are exact; a source may have 2^38 documents.
UNIT = 1 << 24


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, parts): the rows written in order, with `part` and `at`; and for each group and part the rows `before` it in its
    group and the `first` of its own. A row's rank from 0 is before + at - first. No task holds a whole group."""
    laid = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    laid = cut(laid.withColumn("at", F.monotonically_increasing_id()), "laid").withColumn("part", F.shiftright("at", 33))
    parts = laid.groupBy(*group, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    along = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return laid, parts.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))).drop("n")


def targets(totals: DataFrame, share: float, most: float) -> DataFrame:
    """totals (source_size, weight, ...) with `target`: weight times a level, at most `most` times source_size; the level makes the
    targets sum to `share` of all sizes. Each round fixes the sources that are above at the present level."""
    cap, level, fixed = F.col("source_size") * F.lit(float(most)), 0.0, -1
    wanted = float(share) * float(totals.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        held, open_weight, n = totals.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if not open_weight or n == fixed:
            break
        level, fixed = (wanted - (held or 0.0)) / float(open_weight), n
    return totals.withColumn("target", F.when(F.lit(not open_weight) | full, cap).otherwise(F.lit(level) * F.col("weight")).cast("double"))


def sampled(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 11, carry: Sequence[str] | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, size, source_size, target, copies) for each document; `row` holds its columns named in `carry` (all, if None).

    Sources in order of code points, null last, have the weights, again and again. Size is the number of words of the whole text,
    0 for null and empty ones; those are drawn like others and add nothing. Sources without words have target 0 and no copies. Repeated rows are
    documents each, with equal keys in either order. `share` over `most` gives every source `most` times its size. Rows with null
    key or source take part. Very long texts are whole documents: a source's words differ from its target by at most its longest one. Columns
    may have any names. An empty table gives none.
    """
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    flat = docs.toDF(*plain.values())
    kept = docs.columns if carry is None else list(carry)
    src, id_ = F.col(plain[source]).cast("string"), F.col(plain[key]).cast("string")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_, F.lit(""))), 256)
    rows = flat.select(
        F.struct(*[F.col(plain[c]).alias(c) for c in kept]).alias("row"), words(plain[text]).alias("size"), src.isNull().alias("none"), F.coalesce(src, F.lit("")).alias("src"),
        F.substring(mark, 1, 16).alias("mark"), F.col(plain[key]).alias("id"), F.monotonically_increasing_id().alias("no"),  # the last splits equal rows among tasks
    )
    laid, parts = ranked(rows, ("none", "src"), ("size", "mark", "id", "no"))
    totals = cut(laid.groupBy("none", "src").agg(F.sum("size").alias("source_size")), "totals")
    placed, before = ranked(totals, (), ("none", "src"))
    turn = (F.col("before") + F.col("at") - F.col("first")) % len(weights)
    weighed = cut(placed.join(before, "part").select("none", "src", "source_size", F.element_at(F.lit([float(w) for w in weights]), (turn + 1).cast("int")).alias("weight")), "weighed")
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT + 0.5)).otherwise(0).cast("long")
    offset = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("none").cast("string"), F.lit(":"), F.col("src")), 256), 1, 6), 16, 10).cast("long")
    known = targets(weighed, share, most).select("none", "src", "source_size", "target", expected.alias("each"), offset.alias("offset"))
    met = laid.join(parts.join(known, ["none", "src"]), ["none", "src", "part"])
    rank = F.col("before") + F.col("at") - F.col("first")
    crossed = F.shiftright((rank + 1) * F.col("each") + F.col("offset"), 24) - F.shiftright(rank * F.col("each") + F.col("offset"), 24)
    out = cut(met.select("row", "size", "source_size", "target", crossed.alias("copies")), "mix")
    for used in (laid, totals, placed, weighed):
        drop_cut(used)
    return out


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: each document's columns, once for each copy taken (see `sampled`)."""
    taken = sampled(docs, **parameters).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
