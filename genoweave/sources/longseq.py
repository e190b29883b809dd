"""Long sequences by byte offsets: files are cut into splits of bytes, and every row holds a piece of at most `piece` letters, however long a line or a contig is.

A Python data source plans the splits from the files' sizes and reads them with a file system that knows offsets. Which contig a piece belongs to, and where
it begins in it, is told afterwards by sums of lengths along the file, carried from tile to tile. Packed files tell places by arithmetic, so
only the bytes of the range asked for are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from genoweave.functions.seq import revcomp
from genoweave.operators.lineage import settled
from genoweave.operators.seqs import CHUNK
from genoweave.operators.tiles import beside

#: A line that begins so many bytes before a split, or earlier, is a sequence: headers are shorter.
HEADER = 1 << 16
#: Bytes read at a time.
BLOCK = 1 << 20
# Signature of packed files in either byte order, their header's bytes, and the letters of a half byte.
SIGNATURE, HEAD, LETTERS = 0x6BE93D3A, 8, "TCAGN???tcagn???"


def _open(path: str):
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, at


@dataclass
class Split(InputPartition):
    path: str
    begin: int
    end: int


class SequencePieces(DataSource):
    """Options: path (several separated by line ends), kind (fasta or nib), split (bytes), piece (letters); of nib also first and last (letters, from 0, closed)."""

    @classmethod
    def name(cls) -> str:
        return "sequence_pieces"

    def schema(self) -> str:
        return "path string, offset long, header string, part string"

    def reader(self, schema) -> DataSourceReader:
        return PieceReader(dict(self.options))


class PieceReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options["path"].split("\n") if p]
        self.kind = options.get("kind", "fasta")
        self.split, self.piece = int(options.get("split", 16 << 20)), int(options.get("piece", CHUNK))
        self.first, self.last = int(options.get("first", 0)), int(options.get("last", -1))
        if self.kind not in ("fasta", "nib"):
            raise ValueError(f"not a kind of file: {self.kind}")

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            system, at = _open(path)
            if self.kind == "nib":
                with system.open_input_file(at) as f:
                    size = _packed_size(f.read_at(HEAD, 0), path)
                lo, hi = max(0, self.first) // 2 * 2, size if self.last < 0 else min(size, self.last + 1)
                step = 2 * self.split
            else:
                lo, hi, step = 0, system.get_file_info(at).size, self.split
            out += [Split(path, a, min(a + step, hi)) for a in range(lo, hi, step)]
        return out or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[tuple]:
        if partition.path:
            system, at = _open(partition.path)
            with system.open_input_file(at) as f:
                yield from (self._packed if self.kind == "nib" else self._text)(f, partition)

    def _packed(self, f, s: Split) -> Iterator[tuple]:
        table = np.array([[ord(LETTERS[b >> 4]), ord(LETTERS[b & 15])] for b in range(256)], np.uint8)
        step = max(2, self.piece // 2 * 2)
        for a in range(s.begin, s.end, step):
            b = min(a + step, s.end)
            raw = np.frombuffer(f.read_at((b - a + 1) // 2, HEAD + a // 2), np.uint8)
            text = table[raw].tobytes()[: b - a].decode("ascii")
            skip = max(0, self.first - a)
            if text[skip:]:
                yield s.path, a + skip, None, text[skip:]

    def _text(self, f, s: Split) -> Iterator[tuple]:
        size = f.size()
        # where the split begins: at a line's beginning, inside a header, or inside a sequence
        state = "line"
        if s.begin:
            before = f.read_at(min(HEADER, s.begin), s.begin - min(HEADER, s.begin))
            cut = before.rfind(b"\n")
            if cut < len(before) - 1:
                known = cut >= 0 or s.begin <= HEADER
                state = "skip" if known and before[cut + 1 : cut + 2] == b">" else "sequence"
        held, held_at = bytearray(), s.begin
        at = s.begin
        while at < s.end:
            raw = f.read_at(min(BLOCK, s.end - at), at)
            i = 0
            while i < len(raw):
                stop = raw.find(b"\n", i)
                if state == "line" and raw[i : i + 1] == b">":
                    if held:
                        yield s.path, held_at, None, held.decode("ascii", "replace")
                        held = bytearray()
                    here = at + i
                    head, p = bytearray(), here + 1  # the whole header, also beyond the split
                    while p < size and b"\n" not in head:
                        head += f.read_at(min(HEADER, size - p), p)
                        p += HEADER
                    head = head.partition(b"\n")[0]
                    yield s.path, here, head.decode("utf-8", "replace").strip(), None
                    state = "skip"
                if state == "skip":
                    if stop < 0:
                        break
                    i, state = stop + 1, "line"
                    continue
                part = raw[i : stop if stop >= 0 else len(raw)]
                clean = b"".join(part.split())
                for k in range(0, len(clean), self.piece):
                    if not held:
                        held_at = at + i + k  # near enough to order pieces; two never begin at the same place
                    held += clean[k : k + self.piece]
                    while len(held) >= self.piece:
                        yield s.path, held_at, None, bytes(held[: self.piece]).decode("ascii", "replace")
                        held, held_at = held[self.piece :], held_at + self.piece
                i = stop + 1 if stop >= 0 else len(raw)
                state = "line" if stop >= 0 else "sequence"
            at += len(raw)
        if held:
            yield s.path, held_at, None, held.decode("ascii", "replace")


def _packed_size(head: bytes, path: str) -> int:
    """Letters of a packed file, from its header in either byte order."""
    for order in ("little", "big"):
        if int.from_bytes(head[:4], order) == SIGNATURE:
            return int.from_bytes(head[4:8], order)
    raise ValueError(f"not a packed sequence: {path}")


def pieces(spark: SparkSession, paths: str | list[str], **options: str | int) -> DataFrame:
    """(path, offset, header, part): the headers and pieces of sequences of some files, in order of their offset."""
    spark.dataSource.register(SequencePieces)
    listed = paths if isinstance(paths, str) else "\n".join(paths)
    return spark.read.format("sequence_pieces").options(path=listed, **{k: str(v) for k, v in options.items()}).load()


def placed(rows: DataFrame) -> DataFrame:
    """(path, contig, start, part): pieces of FASTA files with the first word of their header and where they begin behind it."""
    size = F.coalesce(F.length("part"), F.lit(0)).cast("long")
    ran = beside(settled(rows, "pieces"), ("path",), "offset", ["offset"], {"before": ("sum", size)})
    head = F.when(F.col("header").isNotNull(), F.struct("offset", "header", "before"))
    ran = beside(settled(ran, "placed"), ("path",), "offset", ["offset"], {"head": ("max", head)})
    found = ran.where("part IS NOT NULL AND head IS NOT NULL")
    return found.select("path", F.regexp_extract("head.header", r"^(\S*)", 1).alias("contig"), (F.col("before") - F.col("head.before")).alias("start"), "part")


def read_chunks(spark: SparkSession, paths: str | list[str], size: int = CHUNK, **options: int) -> DataFrame:
    """(contig, chunk, part) of FASTA files, as operators.seqs.chunked gives them: pieces of `size` letters, numbered from 0, for
    operators.seqs.letters. Contigs of any length, on one line or many; letters before the first header are left out, contigs without letters have no rows."""
    rows = placed(pieces(spark, paths, kind="fasta", **options))
    last = F.col("start") + F.length("part") - 1
    wide = rows.withColumn("chunk", F.explode(F.sequence((F.col("start") / size).cast("int"), (last / size).cast("int"))))
    lo = F.col("chunk").cast("long") * size - F.col("start")
    cut = F.substring("part", (F.greatest(F.lit(0), lo) + 1).cast("int"), (F.lit(size) + F.least(F.lit(0), lo)).cast("int"))
    each = wide.select("contig", "chunk", F.struct("start", cut.alias("s")).alias("x"))
    return each.groupBy("contig", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["s"]), "").alias("part"))


def contig_sizes(chunks: DataFrame) -> DataFrame:
    """(contig, length) of chunks."""
    return chunks.groupBy("contig").agg(F.sum(F.length("part")).cast("long").alias("length"))


def nib_range(spark: SparkSession, path: str, first: int, last: int, **options: int) -> DataFrame:
    """(no, part): letters first..last (1-based, closed) of a packed file in pieces, in the order of `no`; reverse-complemented if first is after last. Only their bytes
    are read; what lies beyond the sequence is left out."""
    lo, hi = min(first, last), max(first, last)
    if lo < 1:
        raise ValueError("places begin at 1")
    rows = pieces(spark, path, kind="nib", first=lo - 1, last=hi - 1, **options)
    if first > last:
        return rows.select((-F.col("offset")).alias("no"), revcomp(F.col("part"), "iupac").alias("part"))
    return rows.select(F.col("offset").alias("no"), "part")


def range_lines(name: str, first: int, last: int, size: int, parts: DataFrame, width: int = 50) -> DataFrame:
    """(no, line): a header, >name:first-last:+:size, and the letters of nib_range in lines of `width`."""
    size_of = F.length("part").cast("long")
    ran = beside(settled(parts, "parts"), (), "no", ["no"], {"before": ("sum", size_of)})
    last_letter = F.col("before") + size_of - 1
    wide = ran.withColumn("line_no", F.explode(F.sequence(F.floor(F.col("before") / width), F.floor(last_letter / width))))
    lo = F.col("line_no") * width - F.col("before")
    cut = F.substring("part", (F.greatest(F.lit(0), lo) + 1).cast("int"), (F.lit(width) + F.least(F.lit(0), lo)).cast("int"))
    lines = wide.groupBy((F.col("line_no") + 1).alias("no")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("before", cut.alias("s")))), lambda x: x["s"]), "").alias("line"))
    head = parts.sparkSession.createDataFrame([(0, f">{name}:{first}-{last}:+:{size}")], "no long, line string")
    return head.unionByName(lines)
