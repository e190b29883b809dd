"""Greedy folds as table functions in SQL: PARTITION BY and ORDER BY of the call give the walk's keys and order.

    SELECT * FROM merge_deletions(TABLE(SELECT contig, beg, end, len, id FROM calls) PARTITION BY contig ORDER BY (beg, end, len, id))

A function has one partition's rows in a task, one after the other, and holds the fold's state only; operators.folds walks a key in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from genoweave.operators import folds


class MergeDeletions:
    """(contig, id, cluster) of rows (contig, beg, end, len, id): cluster is the id of the cluster's first row."""

    def __init__(self) -> None:
        self.rep: tuple | None = None

    def eval(self, row: Row) -> Iterator[tuple]:
        joins = False
        if self.rep:
            share = folds._share(row["beg"], row["end"], self.rep[0], self.rep[1])
            joins = share is not None and share > 0.9 and bool(self.rep[2]) and 0.95 < row["len"] / self.rep[2] < 1.05
        if not joins:
            self.rep = (row["beg"], row["end"], row["len"], row["id"])
        yield row["contig"], row["id"], self.rep[3]


class MergeInsertions:
    """(contig, id, cluster) of rows (contig, beg, end, len, id, seq, five, three)."""

    def __init__(self) -> None:
        self.reps: list[dict] = []

    def eval(self, row: Row) -> Iterator[tuple]:
        own = row.asDict()
        for rep in self.reps:
            if folds.same_insertion(rep, own):
                yield row["contig"], row["id"], rep["id"]
                return
        self.reps = [own, *self.reps[:20]]
        yield row["contig"], row["id"], row["id"]


class DropOverlaps:
    """(contig, st, en, id): the rows (contig, st, en: closed, id) whose overlap with the last kept one is at most a tenth of their own length."""

    def __init__(self) -> None:
        self.last: tuple | None = None

    def eval(self, row: Row) -> Iterator[tuple]:
        st, en = row["st"], row["en"]
        if self.last and (min(en, self.last[1]) - max(st, self.last[0]) + 1) / (en - st + 1) > 0.1:
            return
        self.last = (st, en)
        yield row["contig"], st, en, row["id"]


FUNCTIONS = {
    "merge_deletions": (MergeDeletions, "contig string, id string, cluster string"),
    "merge_insertions": (MergeInsertions, "contig string, id string, cluster string"),
    "drop_overlaps": (DropOverlaps, "contig string, st bigint, en bigint, id string"),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL."""
    for name, (handler, schema) in FUNCTIONS.items():
        spark.udtf.register(name, udtf(handler, returnType=schema))
