"""Operator 6: best-fit packing by the sum of squares.

A document's tokens are cut into pieces of at most `capacity`; a piece goes to the open bin, or to a new one, after
which the sum over residual gaps of the squared number of open bins with that gap is smallest. Pieces are dealt by
hash into groups of bounded size that are packed on their own; all pieces of a group are seen in order of length.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import cut, drop_cut, slices

NEVER = np.iinfo(np.int64).max
assert array("I").itemsize == 4 and sys.byteorder == "little"

#: Of a Latin-1 chunk without apostrophes: the parts into which the tokenizer splits it before it looks for merges.
PARTS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Latin-1 characters that the pattern and the tokenizer class differently.
ODD = frozenset("\u00b2\u00b3\u00b9\u00bc\u00bd\u00be\x1c\x1d\x1e\x1f\x85\xa0'\u2019<")


#: Fixed: the normalizers, the first pattern and the kinds of pre-tokenizers of the tokenizer whose texts may be cut into parts.
KNOWN = [
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    ["Split", "ByteLevel"],
]


class Tokens:
    """Token ids of texts, by way of remembered chunks and their parts.

    For a tokenizer that normalises to NFC and lower case, drops white space, and takes runs of letters, single digits and
    runs of other characters apart. A chunk stands between spaces, tabs or line ends, so its tokens depend on it alone.
    Chunks beyond Latin-1 or with an apostrophe or a possible special token go to the tokenizer whole, others in parts.
    Any other tokenizer (see KNOWN) gets each text whole.
    """

    def __init__(self, path: str, bound: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        split = (rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.split = [(rules["normalizer"] or {}).get("normalizers"), split[0].get("pattern"), [p.get("type") for p in split]] == KNOWN
        self.parts: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.bound = bound

    def learn(self, parts: set[str]) -> None:
        new = parts.difference(self.parts)
        if len(self.parts) + len(new) > self.bound:
            self.parts.clear()
            new = parts
        todo = list(new)
        for i in range(0, len(todo), 20_000):
            part = todo[i : i + 20_000]
            for text, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.parts[text] = array("I", e.ids).tobytes()

    @staticmethod
    def apart(chunk: str) -> list[str]:
        try:
            chunk.encode("latin-1")
        except UnicodeEncodeError:
            return [chunk]
        return PARTS.findall(chunk) if ODD.isdisjoint(chunk) else [chunk]

    def look_up(self, chunks: list[str]) -> list[bytes]:
        fresh = {c: self.apart(c) for c in set(chunks).difference(self.chunks)}
        if len(self.chunks) + len(fresh) > self.bound:
            self.chunks.clear()
            fresh = {c: self.apart(c) for c in chunks}
        if fresh:
            self.learn(set().union(*fresh.values()))
            for c, parts in fresh.items():
                self.chunks[c] = self.parts[parts[0]] if len(parts) == 1 else b"".join([self.parts[p] for p in parts])
        return list(map(self.chunks.__getitem__, chunks))

    @staticmethod
    def folded(text: str) -> str:
        """Lower case where that is what the tokenizer does too (Latin-1 without special tokens); spaces for other gaps."""
        try:
            text.encode("latin-1")
            text = text if "<|" in text else text.lower()
        except UnicodeEncodeError:
            pass
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")

    def of(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text. Each different chunk is looked up once."""
        if not self.split:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lists = pc.split_pattern(pa.array([self.folded(t) for t in texts], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        known = self.look_up(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = np.frombuffer(b"".join(known), "<u4")
        place = coded.indices.to_numpy()
        own = size[place]
        ends = np.cumsum(own)
        first = (np.cumsum(size) - size)[place] - (ends - own)
        all_ids = ids[np.repeat(first, own) + np.arange(int(ends[-1]))] if len(own) else ids
        marks = np.concatenate(([0], ends))[lists.offsets.to_numpy()].tolist()
        return [all_ids[a:b].tobytes() for a, b in zip(marks[:-1], marks[1:], strict=True)]


def in_bulk(rows: Iterable[tuple], chars: int = 4_000_000) -> Iterator[list[tuple]]:
    """Lists of rows whose texts (the second field) come to about as many characters."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[1])
        if size > chars:
            yield held
            held, size = [], 0
    if held:
        yield held


_TOKENS: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """One for each worker process, so that what it has learnt serves its later tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int = 1, key: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of the tokens of each text, an end token added."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens(tokenizer)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows = ((d, t or "") for part in slices(batch) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
            for part in in_bulk(rows):
                out: tuple[list, ...] = ([], [], [], [], [])
                for (doc, _), ids in zip(part, coder.of([r[1] for r in part]), strict=True):
                    ids += last
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut_ids = ids[at : at + 4 * capacity]
                        for col, v in zip(out, (doc, i, at // 4, len(cut_ids) // 4, zlib.crc32(cut_ids)), strict=True):
                            col.append(v)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["key", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, taken in the given order. Full bins no longer count; of equal choices the
    smallest remaining gap is taken, so that the fullest bin grows."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by residual gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, opened = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        # a bin of gap g becomes one of gap g - size: -2 n(g) + 1 + 2 n(g - size) + 1; a gap of 0 isn't counted
        change = 2 * (count[: capacity - size + 1] - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change[count[size:] == 0] = NEVER
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        best = int(change.argmin())
        if change[best] <= fresh:
            gap = best + size
            count[gap] -= 1
            at = stacks[gap].pop()
        else:
            gap, at = capacity, opened
            opened += 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > size:
            count[gap - size] += 1
            stacks[gap - size].append(at)
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1, group: int = 1 << 15, key: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece.

    Any tokenizer of the library `tokenizers` will do. Very long texts are read whole. Null and blank texts are a piece of one end token. Only documents longer than `capacity` are cut; their full
    pieces fill a sequence each. Repeated rows are packed each. Rows with a null doc_id are packed like others.
    An empty table gives none. Other columns, of any names, take no part.
    `group` bounds the pieces that one task packs; each group leaves a few bins part full, out of thousands.
    """
    written = cut(pieces(docs, tokenizer, capacity, end, key), "pieces")
    rows = written.withColumn("row", F.monotonically_increasing_id())
    full = rows.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long")).drop("row")
    part = rows.where(F.col("length") < capacity)
    groups = max(1, -(-part.count() // group))
    dealt = part.withColumn("deal", F.pmod(F.xxhash64("row"), F.lit(groups))).drop("row")

    def run(deal: tuple, found: pa.Table) -> pa.Table:
        found = found.sort_by([("length", "descending"), ("key", "ascending"), ("piece", "ascending")])
        bins, offsets = sum_of_squares(found.column("length").to_numpy(), capacity)
        return found.drop_columns(["deal"]).append_column("sequence_id", pa.array(bins + (deal[0].as_py() << 32))).append_column("offset", pa.array(offsets))

    out = dealt.groupBy("deal").applyInArrow(run, "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    packed = cut(out.unionByName(full).withColumnRenamed("key", key), "packed")
    drop_cut(written)
    return packed
