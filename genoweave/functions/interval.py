"""Interval rules as Column expressions. Intervals are half-open unless a function says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_frac(c1: Column, c2: Column, c3: Column, c4: Column) -> Column:
    """How much of the representative [c3, c4] the row [c1, c2] covers; NULL if the row begins before it or it is empty."""
    size = (c4 - c3).cast("double")
    share = F.when(c1 > c4, 0.0).when((c1 >= c3) & (c2 <= c4), F.try_divide((c2 - c1).cast("double"), size))
    return share.when((c1 >= c3) & (c2 > c4), F.try_divide((c4 - c1).cast("double"), size))


def overlap_len(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """The length two intervals share."""
    return F.greatest(F.lit(0), F.least(a2, b2) - F.greatest(a1, b1))


def overlap_incl(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """The share of the first of two closed intervals that lies in the second; not positive if they are apart."""
    return (F.least(e1, e2) - F.greatest(s1, s2) + 1).cast("double") / (e1 - s1 + 1)


def overlap_half(a1: Column, a2: Column, b1: Column, b2: Column, enough: int = 300) -> Column:
    """Whether the shared length is over half of either interval, or `enough`."""
    n = overlap_len(a1, a2, b1, b2)
    return (2 * n > a2 - a1) | (2 * n > b2 - b1) | (n >= enough)


def jaccard_over(a1: Column, a2: Column, b1: Column, b2: Column, ratio: float) -> Column:
    """Whether the shared length over the length of both together exceeds the ratio."""
    n = overlap_len(a1, a2, b1, b2)
    return n.cast("double") / F.greatest(F.lit(1), F.greatest(a2, b2) - F.least(a1, b1)) > ratio


def overlaps(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    return (a1 < b2) & (b1 < a2)


def size_class(length: Column) -> Column:
    """small under 50, large under 100000, NULL beyond."""
    return F.when(length < 50, "small").when(length < 100_000, "large")


def flank_bucket_del(length: Column) -> Column:
    return F.when(length <= 100, 100).when(length < 500, 200).when(length < 2000, 500).when(length < 5000, 2000).otherwise(5000)


def flank_bucket_ins(length: Column) -> Column:
    return F.when(length < 1000, 100).when(length < 5000, 500).otherwise(800)


def flank_window_del(beg: Column, end: Column, five: Column, three: Column, extend: Column, cap: int = 1000) -> Column:
    """Struct of the flanks used and the ends looked up: the left flank is cut at `extend`, the right one only beyond `cap`."""
    fiv = F.least(five, extend)
    thr = F.when(three > cap, extend).otherwise(three)
    return F.struct(fiv.alias("five"), thr.alias("three"), (beg - fiv + 5).alias("beg0"), (end + thr - 5).alias("end0"))


def flank_window_ins(beg: Column, end: Column, five: Column, three: Column, flank: Column) -> Column:
    """Struct of the ends looked up and the length between them that is not inserted: a side with enough flank goes out by
    it, another one by its own flank less 5."""
    left = F.when(five >= flank, flank).otherwise(five - 5)
    right = F.when(three >= flank, flank).otherwise(three - 5)
    return F.struct((beg - left).alias("beg0"), (end + right).alias("end0"), (left + right).alias("extended"))


def inversion_call(five: Column, inner: Column, three: Column) -> Column:
    """The call from the minus-to-plus rates of the left flank, the interval and the right flank."""
    high = lambda c: c > 5
    low = lambda c: c < 0.2
    return (
        F.when(high(five) & high(inner) & high(three), "0|0")
        .when(high(five) & low(inner) & high(three), "1|1")
        .when(low(five) & low(inner) & low(three), "0|0")
        .when(low(five) & high(inner) & low(three), "1|1")
        .otherwise(".|.")
    )


def deletion_span_call(span: Column, length: Column, slack: int = 13, far: int = 200_000) -> Column:
    """The call from the query span of a deletion; 'window' if the alignment has to be looked at."""
    return F.when(span < slack, "1|1").when((span > length - slack) & (span < length + slack), "0|0").when(span > far, ".|.").otherwise("window")


def insertion_span_call(span: Column, slack: int = 13, far: int = 200_000) -> Column:
    return F.when(span < slack, "0|0").when(span > far, ".|.").otherwise("window")


def y_intercept(x1: Column, y1: Column, x2: Column, y2: Column, at: Column) -> Column:
    """The partner position at `at` on the line through two points; the first point's for equal x."""
    slope = F.try_divide((y2 - y1).cast("double"), x2 - x1)
    return F.coalesce(F.floor(y1 + slope * (at - x1)), y1).cast("long")


def af_text(alt: Column, total: Column) -> Column:
    """An allele frequency cut (not rounded) after two decimals, without trailing zeros."""
    hundredths = F.floor(F.try_divide((alt * 100).cast("double"), total) + 1e-9).cast("long")
    return F.when(hundredths >= 100, "1").when(hundredths % 10 == 0, F.when(hundredths == 0, "0").otherwise(F.concat(F.lit("0."), (hundredths / 10).cast("int").cast("string")))).otherwise(F.concat(F.lit("0."), F.lpad(hundredths.cast("string"), 2, "0")))
