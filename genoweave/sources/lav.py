"""lav files: alignments of two sequences as stanzas of gap-free pieces, read into blocks and written from them.

A section names two sequences (s), their headers (h) and holds alignments (a). Lines are rows, in the order of their file; what a line belongs to is carried
along the file in tiles, so no section is one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.functions.seq import revcomp
from genoweave.operators import blocks
from genoweave.operators.lineage import settled
from genoweave.operators.seqs import chunked, letters
from genoweave.operators.tiles import beside
from genoweave.sources.convert import lav_stanza


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, block, no, value): lines in the order of (block, no) of their file."""
    rows = spark.read.text(path)
    meta = rows.metadataColumn("_metadata")
    return rows.select(meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("no"), "value")


def read_lav(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, id, no, score, name1, dir1, contig1, name2, dir2, contig2, head1, head2, t_from, q_from, t_to, q_to, identity): the gap-free pieces (1-based, closed, on the strand
    that dir, 0 or 1, names) of each alignment (id) with what its section says."""
    rows = settled(_lines(spark, path), "lines")
    order = ["block", "no"]
    place = F.struct("block", "no")
    opens = F.regexp_extract("value", r"^([a-z]) \{\s*$", 1)
    opener = F.when(opens != "", F.struct("block", "no", opens.alias("kind")))
    rows = settled(beside(rows, ("path",), "block", order, {"stanza": ("max", opener), "prev": ("max", F.struct("block", "no", "value"))}), "lines")
    first = F.regexp_extract("prev.value", r"^([a-z]) \{\s*$", 1) != ""
    of = lambda kind, one: (F.col("stanza.kind") == kind) & (first if one else ~first) & (opens == "") & ~F.col("value").rlike("^[}#]")
    named = r'^\s*"(.*)"\s+\S+\s+\S+\s+(\d+)\s+(\d+)'
    told = {}
    for i, one in ((1, True), (2, False)):
        name = F.regexp_extract("value", named, 1)
        turned = F.regexp_extract("value", named, 2).try_cast("int")
        name = F.when(turned == 1, F.regexp_replace(name, "-$", "")).otherwise(name)
        told[f"s{i}"] = ("max", F.when(of("s", one), F.struct("block", "no", name.alias("name"), turned.alias("dir"), F.regexp_extract("value", named, 3).try_cast("int").alias("contig"))))
        told[f"h{i}"] = ("max", F.when(of("h", one), F.struct("block", "no", F.regexp_extract("value", r'^\s*"(.*)"', 1).alias("head"))))
    told["score"] = ("max", F.when(of("a", True), F.struct("block", "no", F.regexp_extract("value", r"s\s+(-?[\d.]+)", 1).try_cast("double").alias("s"))))
    rows = beside(rows, ("path",), "block", order, told)
    line = r"^\s*l\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)(?:\s+(\d+))?"
    number = lambda i: F.regexp_extract("value", line, i).try_cast("long")
    return rows.where((F.col("stanza.kind") == "a") & F.col("value").rlike(line)).select(
        "path", F.struct("stanza.block", "stanza.no").alias("id"), place.alias("no"), F.col("score.s").alias("score"),
        *[F.col(f"s{i}.{c}").alias(f"{c}{i}") for i in (1, 2) for c in ("name", "dir", "contig")], *[F.col(f"h{i}.head").alias(f"head{i}") for i in (1, 2)],
        *[number(i + 1).alias(c) for i, c in enumerate(("t_from", "q_from", "t_to", "q_to", "identity"))],
    )


def header_parts(head: Column) -> Column:
    """struct(src, start, strand, size) of a sequence's header: '>genome:contig:start:strand:size' tells where the sequence lies (start 1-based), any other
    header is the name of a whole sequence (size NULL)."""
    plain = F.regexp_replace(F.regexp_replace(head, r"^>\s*", ""), r" \(reverse complement\)$", "")
    form = r"^([^:\s]+):([^:\s]+):(\d+):([+-]):(\d+)"
    part = lambda i: F.regexp_extract(plain, form, i)
    full = plain.rlike(form)
    src = F.when(~full, F.regexp_extract(plain, r"^(\S*)", 1)).when(part(1) == part(2), part(1)).otherwise(F.concat(part(1), F.lit("."), part(2)))
    return F.struct(src.alias("src"), F.when(full, part(3).try_cast("long")).otherwise(1).alias("start"), F.when(full, part(4)).otherwise("+").alias("strand"), F.when(full, part(5).try_cast("long")).alias("size"))


def lav_to_maf(pieces: DataFrame, targets: DataFrame, queries: DataFrame) -> DataFrame:
    """(score, rows): a block of each alignment of read_lav, its letters taken by chunks from the sequences (head: as in the file, seq). What a sequence's header
    says of its place decides starts, strands and sizes; the alignment of a sequence with itself from end to end is left out. Sequences that are not given
    leave their alignments out. Scores are those of the columns."""
    ends = pieces.groupBy("path", "id", "head1", "head2", "dir1", "dir2").agg(
        F.min("t_from").alias("t0"), F.max("t_to").alias("t1"), F.min("q_from").alias("q0"), F.max("q_to").alias("q1"), F.array_sort(F.collect_list(F.struct("t_from", "q_from", "t_to", "q_to"))).alias("runs")
    )
    for i, seqs, c in ((1, targets, "t"), (2, queries, "q")):
        plain = lambda h: F.regexp_replace(h, r" \(reverse complement\)$", "")
        sizes = seqs.select(plain(F.col("head")).alias(f"k{i}"), F.length("seq").cast("long").alias(f"len{i}"))
        ends = ends.withColumn(f"k{i}", plain(F.col(f"head{i}"))).join(sizes, f"k{i}")
        back = F.col(f"dir{i}") == 1
        size = F.col(f"len{i}")
        ends = ends.withColumns({f"lo{i}": F.when(back, size - F.col(f"{c}1")).otherwise(F.col(f"{c}0") - 1), f"hi{i}": F.when(back, size - F.col(f"{c}0") + 1).otherwise(F.col(f"{c}1"))})
        parts = chunked(seqs.select(plain(F.col("head")).alias(f"k{i}"), "seq"), (f"k{i}",))
        ends = letters(ends, parts, f"x{i}", f"lo{i}", f"hi{i}", (f"k{i}",)).withColumn(f"x{i}", F.when(back, revcomp(F.col(f"x{i}"), "iupac")).otherwise(F.col(f"x{i}")))
    cut = lambda c, a, b: F.substring(f"x{1 if c == 't' else 2}", (a - F.col(f"{c}0") + 1).cast("int"), F.greatest(F.lit(0), b - a + 1).cast("int"))
    first = F.struct(F.col("t0").alias("t"), F.col("q0").alias("q"), F.lit("").alias("one"), F.lit("").alias("two"))

    def add(acc: Column, r: Column) -> Column:
        gap_t, gap_q = cut("t", acc["t"], r["t_from"] - 1), cut("q", acc["q"], r["q_from"] - 1)
        one = F.concat(acc["one"], gap_t, F.repeat(F.lit("-"), F.length(gap_q)), cut("t", r["t_from"], r["t_to"]))
        two = F.concat(acc["two"], F.repeat(F.lit("-"), F.length(gap_t)), gap_q, cut("q", r["q_from"], r["q_to"]))
        return F.struct((r["t_to"] + 1).alias("t"), (r["q_to"] + 1).alias("q"), one.alias("one"), two.alias("two"))

    whole = ends.withColumn("text", F.aggregate("runs", first, add))

    def row(i: int, c: str, text: Column) -> Column:
        h, n = header_parts(F.col(f"k{i}")), F.col(f"len{i}")
        size = F.coalesce(h["size"], n)
        turned = F.col(f"dir{i}") == 1
        # the sequence itself lies at h.start - 1 on its strand; turned, it begins as far from the other end
        begin = F.when(turned, size - (h["start"] - 1) - n).otherwise(h["start"] - 1)
        strand = F.when((h["strand"] == "+") != turned, "+").otherwise("-")
        return F.struct(h["src"].alias("src"), (begin + F.col(f"{c}0") - 1).alias("start"), (F.col(f"{c}1") - F.col(f"{c}0") + 1).alias("size"), strand.alias("strand"), size.alias("src_size"), text.alias("text"))

    a, b = row(1, "t", F.col("text.one")), row(2, "q", F.col("text.two"))
    found = whole.withColumn("rows", F.array(a, b))
    x, y = F.col("rows")[0], F.col("rows")[1]
    itself = (x["src"] == y["src"]) & (x["start"] == y["start"]) & (x["size"] == y["size"]) & (x["src_size"] == y["src_size"]) & (x["size"] == F.col("len1")) & (y["size"] == F.col("len2"))
    return found.where(~itself).select(blocks.score_of_all(F.col("rows")).cast("double").alias("score"), "rows")


def maf_to_lav(maf: DataFrame) -> DataFrame:
    """(target, query, turned, no, text): two-row blocks (score, rows; the first on the plus strand) as sections, one for each pair of sequences and strand of the second: a
    head (no 0), a stanza of each block in order (no 1), and an end (no 2). Written sorted by all columns, they are a lav file."""
    x, y = F.col("rows")[0], F.col("rows")[1]
    rows = maf.where(F.size("rows") == 2).select(
        x["src"].alias("target"), y["src"].alias("query"), (y["strand"] == "-").alias("turned"), x["src_size"].alias("n"), y["src_size"].alias("m"), x["start"].alias("at"), y["start"].alias("q_at"), lav_stanza(F.col("score"), F.col("rows")).alias("text")
    )
    name = lambda c, n, back, k: F.concat(F.lit('  "'), c, F.when(back, "-").otherwise(""), F.lit('" 1 '), n.cast("string"), F.lit(" "), back.cast("int").cast("string"), F.lit(f" {k}"))
    head = lambda c, back: F.concat(F.lit('  ">'), c, F.when(back, " (reverse complement)").otherwise(""), F.lit('"'))
    key = ["target", "query", "turned"]
    t, q, back, no = F.col("target"), F.col("query"), F.col("turned"), F.lit(False)
    sections = rows.groupBy(*key).agg(F.max("n").alias("n"), F.max("m").alias("m"))
    start = F.concat_ws("\n", F.lit("#:lav"), F.lit("s {"), name(t, F.col("n"), no, 1), name(q, F.col("m"), back, 1), F.lit("}"), F.lit("h {"), head(t, no), head(q, back), F.lit("}"))
    zero = F.lit(0).cast("long")
    out = sections.select(*key, F.lit(0).alias("no"), zero.alias("at"), zero.alias("q_at"), start.alias("text"))
    out = out.unionByName(rows.select(*key, F.lit(1).alias("no"), "at", "q_at", "text"))
    return out.unionByName(sections.select(*key, F.lit(2).alias("no"), zero.alias("at"), zero.alias("q_at"), F.lit("x {\n  n 0\n}").alias("text")))


def write_lav(maf: DataFrame, path: str) -> None:
    """Blocks as lav text, in order of sequences, strand and place, in files that follow one another."""
    lines = maf_to_lav(maf)
    order = ["target", "query", "turned", "no", "at", "q_at", "text"]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("text").write.text(path)
