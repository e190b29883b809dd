"""Sequence functions as Column expressions; none needs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements of each alphabet, as (from, to). "merge" reads U as T and writes u's complement as a.
ALPHABETS = {
    "dna": ("ACGTNacgtn", "TGCANtgcan"),
    "merge": ("ACGTUacgtu", "TGCAAtgcaa"),
    "iupac": ("ACGTUNRYSWKMBDHVacgtunryswkmbdhv", "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"),
}

# Substitution scores of aligned bases (rows and columns A, C, G, T), gap opening and extension.
BASES = "ACGT"
SUBSTITUTION = ((91, -114, -31, -123), (-114, 100, -125, -31), (-31, -125, 100, -114), (-123, -31, -114, 91))
OTHER, GAP_OPEN, GAP_EXTEND = -100, 400, 30


def revcomp(s: Column, alphabet: str = "dna") -> Column:
    """The reverse complement; characters outside the alphabet stay as they are."""
    return F.reverse(F.translate(s, *ALPHABETS[alphabet]))


def strand_flip(start: Column, size: Column, src_size: Column) -> Column:
    """A start counted from the other end of the source."""
    return src_size - (start + size)


def kmer_hits(a: Column, b: Column, k: int, length: Column | None = None) -> Column:
    """How many of the k-mers of a, at all its places, occur anywhere in b. `length` stands for a's, if given."""
    n = F.length(a) if length is None else length
    word = lambda i: F.substring(a, i, F.lit(k))
    held = lambda i: b.contains(word(i)) if length is None else b.contains(word(i)) & (F.length(word(i)) == k)
    each = lambda acc, i: acc + F.when(held(i), 1).otherwise(0)
    return F.when(n >= k, F.aggregate(F.sequence(F.lit(1), (n - k + 1).cast("int")), F.lit(0), each)).otherwise(0)


def kmer_frac(a: Column, b: Column, k: int, length: Column | None = None) -> Column:
    """The share of the k-mers of a that occur in b; NULL if a is shorter than k."""
    n = F.length(a) if length is None else length
    return F.when(n >= k, kmer_hits(a, b, k, length).cast("double") / (n - k + 1))


def choose_k(length: Column) -> tuple[Column, Column]:
    """Whether sequences of a length are compared by 4-mers (over 5 and under 50) or by 10-mers (over 50)."""
    return (length > 5) & (length < 50), length > 50


def dup_class(seq: Column, five: Column, three: Column, k: int = 10) -> Column:
    """Where a sequence is a copy of its neighbourhood: the larger k-mer share of both flanks decides, ties to the right;
    over one half is a duplicate, else the reverse complement is tried, else it is none."""

    def side(s: Column) -> tuple[Column, Column]:
        a, b = F.coalesce(kmer_frac(s, five, k), F.lit(0.0)), F.coalesce(kmer_frac(s, three, k), F.lit(0.0))
        return F.greatest(a, b), F.when(a > b, F.lit("5")).otherwise(F.lit("3"))

    best, end = side(seq)
    best_rc, end_rc = side(revcomp(seq))
    return F.when(best > 0.5, F.concat(end, F.lit("DUP"))).when(best_rc > 0.5, F.concat(end_rc, F.lit("INVDUP"))).otherwise("NONDUP")


def chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def substitution(a: Column, b: Column) -> Column:
    """The score of two aligned letters, whatever their case."""
    x, y = F.instr(F.lit(BASES), F.upper(a)), F.instr(F.lit(BASES), F.upper(b))
    table = F.array(*[F.lit(v) for row in SUBSTITUTION for v in row])
    return F.when((x > 0) & (y > 0), F.element_at(table, ((x - 1) * 4 + y).cast("int"))).otherwise(OTHER)


def pair_score(a: Column, b: Column) -> Column:
    """The score of two aligned rows: substitutions, less an opening for each gap and an extension for each gap letter.

    Columns with a dash in both rows count nothing and do not end a gap."""
    start = F.struct(F.lit(0).alias("score"), F.lit(0).alias("gap"))

    def add(acc: Column, x: Column) -> Column:
        u, v = x["a"] == "-", x["b"] == "-"
        side = F.when(u, 1).when(v, 2).otherwise(0)
        change = F.when(u & v, 0).when(side == 0, _pair(x)).otherwise(-GAP_EXTEND - F.when(acc["gap"] == side, 0).otherwise(GAP_OPEN))
        return F.struct((acc["score"] + change).alias("score"), F.when(u & v, acc["gap"]).otherwise(side).alias("gap"))

    return F.aggregate(F.arrays_zip(chars(a).alias("a"), chars(b).alias("b")), start, add, lambda acc: acc["score"])


def _pair(x: Column) -> Column:
    """Substitution inside a fold: a CASE over the sixteen pairs, so that no table is built for each letter."""
    out = F.lit(OTHER)
    key = F.concat(F.upper(x["a"]), F.upper(x["b"]))
    for i, p in enumerate(BASES):
        for j, q in enumerate(BASES):
            out = F.when(key == p + q, SUBSTITUTION[i][j]).otherwise(out)
    return out


def parse_num(s: Column) -> Column:
    """1.5m, 50k, 2g or a plain number as a long."""
    n = F.regexp_extract(s, r"^([0-9.]+)", 1).cast("double")
    unit = F.lower(F.regexp_extract(s, r"^[0-9.]+([kmgKMG])", 1))
    return F.floor(n * F.when(unit == "k", 1e3).when(unit == "m", 1e6).when(unit == "g", 1e9).otherwise(1.0) + 0.499).cast("long")


def pos_to_col(text: Column, start: Column, pos: Column) -> Column:
    """The 0-based column of a 0-based position in a gapped row that begins at `start`; NULL outside the row."""
    first = F.struct(F.lit(-1).alias("col"), F.lit(-1).alias("seen"), F.lit(-1).alias("hit"))

    def step(acc: Column, c: Column) -> Column:
        seen = acc["seen"] + F.when(c == "-", 0).otherwise(1)
        return F.struct((acc["col"] + 1).alias("col"), seen.alias("seen"), F.when((acc["hit"] < 0) & (seen == pos - start) & (c != "-"), acc["col"] + 1).otherwise(acc["hit"]).alias("hit"))

    found = F.aggregate(chars(text), first, step, lambda acc: acc["hit"])
    return F.when(found >= 0, found)


def bases_before(text: Column, col: Column) -> Column:
    """How many letters other than dashes stand before a 0-based column."""
    return F.length(F.replace(F.substring(text, F.lit(1), col), F.lit("-"), F.lit("")))


def is_fasta_text(s: Column) -> Column:
    return s.rlike("^[ACGTUNRYSWKMBDHVacgtunryswkmbdhv]*$")
