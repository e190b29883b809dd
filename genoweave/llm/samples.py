"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import cut, drop_cut

#: Of the sampled rows' texts at most so many bytes of each label reach the driver.
BYTES = 64 << 20


def one_each(docs: DataFrame, picked: DataFrame, columns: tuple[str, ...], key: str = "doc_id", most: int = BYTES) -> list[tuple]:
    """(key, y, *columns) of the picked (key, y), a bounded number, sorted by key.

    Of several rows of a key the one with the shortest first column counts (ties: the least), so one row of each reaches the driver. Of each y, keys are
    taken by their hash while the first column's bytes stay within `most`; a row that would go beyond is left out as a whole."""
    size = F.coalesce(F.octet_length(F.col(columns[0]).cast("string")), F.lit(0)).cast("long")
    rows = docs.select(F.col(key).alias("key"), F.struct(size.alias("bytes"), *columns).alias("row")).join(F.broadcast(picked.select(F.col(key).alias("key"), "y")), "key")
    rows = cut(rows.groupBy("key", "y").agg(F.min("row").alias("row")), "sample")
    order = F.xxhash64(F.col("key").cast("string"), F.lit("sample"))
    sizes = sorted((r["y"], r["o"], r["key"], r["n"]) for r in rows.select("key", "y", order.alias("o"), F.col("row.bytes").alias("n")).collect())
    held: dict[int, int] = {}
    taken = []
    for y, _, k, n in sizes:
        if held.get(y, 0) + n <= most:
            held[y] = held.get(y, 0) + n
            taken.append((k,))
    chosen = rows
    if len(taken) < len(sizes):
        chosen = rows.join(F.broadcast(docs.sparkSession.createDataFrame(taken, f"key {rows.schema['key'].dataType.simpleString()}")), "key", "left_semi")
    out = sorted((r["key"], r["y"], *r["row"][1:]) for r in chosen.collect())
    drop_cut(rows)
    return out


def known(labels: DataFrame, label: str, key: str, where: Column | None) -> DataFrame:
    """(key, y): keys with a label 0 or 1; of repeated labels of a key the largest counts."""
    found = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("y"))
    return found.where(where) if where is not None else found


def labelled(docs: DataFrame, labels: DataFrame, label: str, size: int, where: Column | None = None, key: str = "doc_id", columns: tuple[str, ...] = ("text",), most: int = BYTES) -> list[tuple]:
    """At most `size` rows of each label 0 and 1 as (key, label, *columns), least hash of the key first, in all at most `most` bytes of the first column of each.

    Rows without key or label take no part; of repeated labels of a key the largest counts, of repeated documents one.
    """
    order = F.xxhash64(F.col(key).cast("string"), F.lit("sample"))
    sides = [known(labels, label, key, where).where(f"y = {y}").orderBy(order, key).limit(size).select(key, "y") for y in (0, 1)]
    return one_each(docs, sides[0].union(sides[1]), columns, key, most)


def counts(labels: DataFrame, label: str, key: str = "doc_id", where: Column | None = None) -> dict[int, int]:
    return {r["y"]: r["n"] for r in known(labels, label, key, where).groupBy("y").agg(F.count("*").alias("n")).collect()}
