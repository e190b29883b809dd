"""Ordered walks along contigs without one sort for each contig: windows run inside tiles of a contig, and what comes from the tiles
before (or after) is carried in from a small table of one row for each tile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 1 << 20

#: What can be carried: aggregates of aggregates.
CARRIED: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "max": F.max, "min": F.min}


def beside(df: DataFrame, by: tuple[str, ...], pos: str, order: list[str], values: dict[str, tuple[str, Column]], before: bool = True, tile: int = TILE) -> DataFrame:
    """df with, for each (name: (sum, max or min, value)), that of the value over all rows before the row in its group's order (or
    after it), NULL (0 for a sum) if there are none. The order begins with `pos`; rows whose group is NULL make a group."""
    cut = df.withColumn("__tile", F.floor(F.col(pos) / tile))
    cut = cut.withColumns({f"__v_{n}": v for n, (_, v) in values.items()})
    # what comes after is what comes before in the other direction: a frame that shrinks is summed anew for each row
    rows, way = (Window.unboundedPreceding, -1), (F.asc if before else F.desc)
    parts = cut.groupBy(*by, "__tile").agg(*[CARRIED[f](F.col(f"__v_{n}")).alias(f"__p_{n}") for n, (f, _) in values.items()])
    along = Window.partitionBy(*by).orderBy(way("__tile")).rowsBetween(*rows)
    # what a tile is given stands in front of its rows, so that the rows cross one exchange and are joined with nothing
    carry = parts.select(*by, "__tile", *[CARRIED[f](F.col(f"__p_{n}")).over(along).alias(f"__v_{n}") for n, (f, _) in values.items()], F.lit(0).alias("__own"))
    inside = Window.partitionBy(*by, "__tile").orderBy("__own", *map(way, order)).rowsBetween(*rows)
    met = cut.withColumn("__own", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    over = {n: CARRIED[f](F.col(f"__v_{n}")).over(inside) for n, (f, _) in values.items()}
    out = {n: F.coalesce(c, F.lit(0)) if values[n][0] == "sum" else c for n, c in over.items()}
    return met.withColumns(out).where("__own = 1").select(*df.columns, *values)
