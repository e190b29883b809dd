"""Operator 3: SimHash near-duplicates by the generalised pigeonhole principle.

With m groups of bits and thresholds t_1..t_m that add up to radius - m + 1, two fingerprints within the radius differ
in at most t_i bits in at least one group i (a threshold of -1 leaves the group out). Bits that go together are put
into one group; dynamic programming gives each group its own threshold, so that the estimated number of candidates is
least; the groups are then probed and every candidate is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoweave.llm.common import WordHashes, components, cut, drop_cut, signed, slices, windows_hash, words_of

BITS = 64
#: Rows of a bucket that one task compares at a time; larger buckets are dealt out as pairs of blocks.
BLOCK = 2048


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of `size` words joined by one space; all words if there are fewer; none if none."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([digest(b" ".join(words), 42)], np.uint64)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array([digest(text[a:b], 42) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)], np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set; in parts, so that a very long text needs little memory."""
    total = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; 0 for no hashes."""
    if not len(hashes):
        return 0
    return int(np.packbits((2 * bit_counts(hashes) > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, fp long) for each row; null and blank texts have fingerprint 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(words_of(t, lower=True), size)) for part in slices(batch) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(signed(np.array(fps, np.uint64)))], ["key", "fp"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(column).cast("string").alias("text")).mapInArrow(run, "key long, fp long").withColumnRenamed("key", key)


# ---- grouping bits and allocating thresholds


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and the 64 x 64 counts of bits set together, summed over all rows of fps(fp)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += (bits.T @ bits).astype(np.float64)
            n += len(x)
        cell = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.append(both.ravel(), n).astype(np.int64))], ["cell", "n"])

    # one bounded row set (4,097 counts) from each task, summed before it reaches the driver
    rows = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal width; each group grows by the bit that correlates most with it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for i in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - i)
        seed = max(left, key=lambda b: (corr[b, sorted(left)].sum(), -b))
        group = [seed]
        left.discard(seed)
        while len(group) < width:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], radius: int) -> list[int]:
    """Thresholds of least total cost that add up to radius - parts + 1; costs[i][t + 1] is the cost of threshold t in part i."""
    parts = len(costs)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (c, chosen) in best.items():
            for t in range(-1, len(cost) - 1):
                now = (c + cost[t + 1], [*chosen, t])
                if total + t not in step or now < step[total + t]:
                    step[total + t] = now
        best = step
    return best[radius - parts + 1][1]


def part_key(column, bits: list[int]):
    """The bits of a group packed into a long (SQL; runs of neighbouring bits move together)."""
    out, at, i = F.lit(0).cast("long"), 0, 0
    while i < len(bits):
        j = i
        while j + 1 < len(bits) and bits[j + 1] == bits[j] + 1:
            j += 1
        run = j - i + 1
        piece = F.shiftrightunsigned(column, bits[i]).bitwiseAND(F.lit((1 << run) - 1 if run < 64 else -1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(piece, at))
        at, i = at + run, j + 1
    return out


def estimate(items: DataFrame, groups: list[list[int]], radius: int) -> list[list[float]]:
    """Candidate counts of each threshold: exact for 0 from the counts of all part values, and for more bits as if the
    values within t bits were as full as the value itself. A probe costs as much as a candidate."""
    keys = items.select(F.explode(F.array(*[F.struct(F.lit(i).alias("part"), part_key(F.col("fp"), g).alias("k")) for i, g in enumerate(groups)])).alias("x")).select("x.part", "x.k")
    counts = keys.groupBy("part", "k").agg(F.count("*").cast("double").alias("c"))
    found = {r["part"]: (r["n"], r["pairs"]) for r in counts.groupBy("part").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("pairs")).collect()}
    costs = []
    for i, g in enumerate(groups):
        n, pairs = found.get(i, (0.0, 0.0))
        near = [sum(1 for _ in combinations(range(len(g)), t)) if t < 3 else len(g) ** t / 6 for t in range(radius + 1)]
        costs.append([0.0, *((n + pairs) * sum(near[: t + 1]) for t in range(radius + 1))])
    return costs


# ---- probing and verifying


def spanning(fp: np.ndarray, radius: int) -> list[tuple[int, int, int]]:
    """A minimum spanning forest (Prim) of the rows whose fingerprints are within the radius: (i, j, distance)."""
    n = len(fp)
    dist = np.full(n, 255, np.int64)
    link = np.full(n, -1, np.int64)
    todo = np.ones(n, bool)
    out = []
    at = 0
    for _ in range(n):
        todo[at] = False
        d = np.bitwise_count(fp ^ fp[at]).astype(np.int64)
        better = todo & (d < dist)
        dist[better], link[better] = d[better], at
        masked = np.where(todo, dist, 256)
        at = int(masked.argmin())
        if not todo[at]:
            break
        if masked[at] <= radius:
            out.append((int(link[at]), at, int(masked[at])))
    return out


#: Bits of a parity sketch, distinct shingles from which on they are sampled, and standard deviations allowed for sampling.
SKETCH, DENSE, SIGMAS = 512, 512, 6.0


def sketch(own: np.ndarray) -> bytes:
    """Number and two parity sketches of a shingle set: bit b is the parity of the shingles that fall on b.

    Two sets differ in at least as many shingles as their sketches in bits. Larger sets are sampled, so that the sketch is not full:
    one shingle in 4^level. The second sketch is of the next level, for sets of similar size that have that one."""
    n, level = len(own), 0
    while n >= DENSE << 2 * level:
        level += 1
    out = [np.array([n, level], "<u8").tobytes()]
    for k in (level, level + 1):
        some = own[(own >> np.uint32(9)) & np.uint32((1 << 2 * min(k, 11)) - 1) == 0]
        parity = np.bincount((some & np.uint32(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
        out.append(np.packbits(parity.astype(np.uint8), bitorder="little").tobytes())
    return b"".join(out)


class Sketches:
    """Sketches of the rows of a bucket; which pairs can have the similarity."""

    def __init__(self, blobs: Iterable[bytes], threshold: float):
        x = np.frombuffer(b"".join(blobs), "<u8").reshape(-1, 2 + 2 * SKETCH // 64)
        self.n, self.level, self.bits = x[:, 0].astype(np.float64), x[:, 1].astype(np.int64), x[:, 2:].reshape(len(x), 2, -1)
        self.threshold = threshold

    def possible(self, i: int, rest: np.ndarray) -> np.ndarray:
        """Those of `rest` whose similarity to i can reach the threshold: none that reaches it is left out while sets are not
        sampled, and of sampled ones those whose sampled difference is over SIGMAS deviations from the mean."""
        t, n, level = self.threshold, self.n[rest], self.level[rest]
        rest = rest[(np.minimum(n, self.n[i]) >= t * np.maximum(n, self.n[i]) - 1e-9) & (np.abs(level - self.level[i]) <= 1)]
        if not len(rest):
            return rest
        level = self.level[rest]
        up = np.maximum(level, self.level[i])
        apart = np.bitwise_count(self.bits[i][up - self.level[i]] ^ self.bits[rest, up - level]).sum(axis=1, dtype=np.int64)
        most = (self.n[rest] + self.n[i]) * (1 - t) / (1 + t) * 0.25**up
        return rest[apart <= most + np.where(up > 0, SIGMAS * np.sqrt(most) + SIGMAS, 0) + 1e-9]


def forest(blobs: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links that connect all rows which pairs of possible similarity connect."""
    x = Sketches(blobs, threshold)
    left, out = np.arange(1, len(blobs)), []
    queue = [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        at = queue.pop()
        near = x.possible(at, left)
        if len(near):
            out += [(at, j) for j in near.tolist()]
            queue += near.tolist()
            left = np.setdiff1d(left, near, assume_unique=True)
    return out


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of each run of equal keys; the rows of a partition are sorted by the keys, groups may span batches."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        same = np.ones(len(cols[0]) - 1, bool)
        for c in cols[:keys]:
            same &= c[1:] == c[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(~same) + 1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a > 1:
                yield [c[a:b] for c in cols]
        held = [c[cuts[-1] :] for c in cols]
    if held and len(held[0]) > 1:
        yield held


def gph_links(items: DataFrame, radius: int, parts: int, sketches: DataFrame | None = None, threshold: float = 0.8, block: int = BLOCK) -> DataFrame:
    """Links (a, b, d) between items (id, fp).

    Two items with fingerprints within the radius meet in at least one bucket. In each bucket (or pair of blocks of a
    large bucket) a spanning forest is kept, so a group of n similar items gives at most n - 1 links a bucket
    and keeps all its connections: of fp within the radius, or, where sketches (id, sim) are given, of any two items whose
    shingle sets can have the similarity (d is 0 then).
    """
    n, both = bit_statistics(items)
    groups = group_bits(n, both, parts)
    costs = estimate(items, groups, radius)
    thresholds = allocate(costs, radius)
    entries = []
    for i, (g, t) in enumerate(zip(groups, thresholds, strict=True)):
        if t < 0:
            continue
        key = part_key(F.col("fp"), g)
        flips = [sum(1 << b for b in c) for r in range(t + 1) for c in combinations(range(len(g)), r)]
        entries += [F.struct(F.lit(i).alias("part"), key.bitwiseXOR(F.lit(f).cast("long")).alias("k")) for f in flips]
    sketched = sketches is not None
    own = ["id"] if sketched else ["id", "sim"]
    rows = items.select("id", F.col("fp").alias("sim"), F.explode(F.array(*entries)).alias("x")).select("x.part", "x.k", *own)
    rows = rows.withColumn("h", F.xxhash64("part", "k")).select("h", *own)
    counts = rows.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    rows = rows.join(counts, "h")
    # sketches are joined to the rows that met only
    rows = rows.hint("merge").join(sketches.hint("merge"), "id") if sketched else rows
    met = rows.withColumn("blocks", F.ceil(F.col("c") / block).cast("int")).withColumn("own", F.pmod(F.hash("id", "sim"), F.col("blocks")))
    small = met.where("blocks = 1").select("h", F.lit(0).alias("i"), F.lit(0).alias("j"), "id", "sim")
    large = met.where("blocks > 1").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.select("h", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "id", "sim")
    dealt = small.unionByName(large).repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, d = [], [], []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.int32())], ["a", "b", "d"])
            a.clear(), b.clear(), d.clear()
            return out

        for _, _, _, ids, sims in _groups(batches, 3):
            if sketched:
                links = [(i, j, 0) for i, j in forest(sims, threshold)]
            else:
                f = sims.astype(np.int64).view(np.uint64)
                if len(f) == 2:
                    links = [(0, 1, x)] if (x := int(np.bitwise_count(f[0] ^ f[1]))) <= radius else []
                else:
                    links = spanning(f, radius)
            for i, j, x in links:
                if ids[i] != ids[j]:
                    a.append(min(ids[i], ids[j])), b.append(max(ids[i], ids[j])), d.append(x)
            if len(a) > 50_000:
                yield flush()
        yield flush()

    return dealt.mapInArrow(run, "a long, b long, d int").dropDuplicates(["a", "b"])


def simhash_components(docs: DataFrame, size: int = 3, radius: int = 2, parts: int = 3, key: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links of at most `radius` differing bits.

    Rows with the same fingerprint are linked; only different fingerprints are compared. Null or blank texts have
    fingerprint 0 and are linked like any other; very long texts are read whole. Repeated rows stay. Other columns, of any names, take no part. A row with a null doc_id keeps its row; it takes
    part in linking, and its component is the smallest doc_id there (null if there is none). An empty table gives none.
    """
    fps = cut(fingerprints(docs, size, key), "fps")
    least = cut(fps.groupBy("fp").agg(F.min(key).alias("first")), "least")
    links = gph_links(least.select(F.col("fp").alias("id"), "fp"), radius, parts)
    nodes = components(links.select("a", "b"))
    rooted = least.join(nodes, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted, "rooted")
    roots = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = cut(rooted.join(roots, "root").select("fp", "component_id"), "classes")
    out = cut(fps.join(of, "fp").select(key, "fp", "component_id"), "linked")
    for table in (least, nodes, rooted, fps, of):
        drop_cut(table)
    return out


# ---- near-duplicate documents at a shingle similarity


#: Words whose hashes a task remembers: a worker's memory beside what it reads.
KNOWN = 60_000


def pack_text(docs: DataFrame, column: str = "text") -> DataFrame:
    """docs with the text compressed (zstd), for an exchange; null stays null. Column names without dots."""
    at = docs.columns.index(column)
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if i == at else f.dataType) for i, f in enumerate(docs.schema.fields)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coder = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch):
                blobs = [None if t is None else coder.compress(t.encode("utf-8", "surrogatepass")) for t in part.column(at).to_pylist()]
                yield part.set_column(at, column, pa.array(blobs, pa.binary()))

    return docs.mapInArrow(run, schema)


def unpacked(blobs: list[bytes | None]) -> list[str | None]:
    import zstandard

    coder = zstandard.ZstdDecompressor()
    return [None if b is None else coder.decompress(b).decode("utf-8", "surrogatepass") for b in blobs]


def unpack_text(docs: DataFrame, schema: T.StructType, column: str = "text") -> DataFrame:
    at = schema.names.index(column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.set_column(at, column, pa.array(unpacked(part.column(at).to_pylist()), pa.string()))

    return docs.select(*schema.names).mapInArrow(run, schema)


#: Words of a sampled window.
WINDOW = 8
#: Texts of fewer words are sampled at all windows, those of up to SHORT words at the least of any NEAR neighbouring
#: windows, longer ones at the least of any FAR.
TINY, NEAR, SHORT, FAR = 24, 13, 128, 24


def samples(hashes: np.ndarray) -> np.ndarray:
    """SimHashes of sampled windows of a text's words; which are sampled depends on their words only.

    The least hash of any so many neighbouring windows is a sample (winnowing), so two texts with a common run of 20
    words share a sample, or of 31 words if one of them has over 128. One inserted, left out or replaced word makes at least nine
    shingles differ, four or more in each text. So texts that differ in e such places have at most 1 - 9 e / (s + 9 e) in common
    (s shared shingles in e + 1 runs): at 0.8, e is at most s / 36, and the longest run has at least s / (e + 1) shingles. That
    is 16 or more (20 words) from 24 words on, and 27 or more (31 words) from 100 shared shingles on. Texts of under 24 words
    are sampled at all windows. A text of fewer words than a window is one sample."""
    n = len(hashes)
    if n < WINDOW:
        return windows_hash(hashes, n) if n else np.zeros(0, np.uint64)
    w = windows_hash(hashes, WINDOW)
    if n < TINY:
        starts = np.arange(len(w))
    else:
        wide = min(NEAR if n <= SHORT else FAR, len(w))
        least, starts = np.lib.stride_tricks.sliding_window_view(w, wide), []
        for i in range(0, len(least), 1 << 14):  # in parts, for very long texts
            part = least[i : i + (1 << 14)]
            starts.append(np.unique(part.argmin(axis=1) + np.arange(i, i + len(part))))
        starts = np.unique(np.concatenate(starts))
    inner = WINDOW - 2
    three = windows_hash(hashes, 3)[starts[:, None] + np.arange(inner)]
    bits = np.unpackbits(three.astype("<u8").view(np.uint8).reshape(len(starts), inner, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int8)
    return np.unique(np.packbits(2 * bits > inner, axis=1, bitorder="little").view("<u8")[:, 0])


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles (32-bit hashes, sorted) of a text's words; one of all words if there are fewer than `size`."""
    return np.unique((windows_hash(hashes, min(size, max(1, len(hashes)))) >> np.uint64(32)).astype(np.uint32))


def joined(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Links (i, j) that join all sets that similar pairs connect; every pair not yet joined is compared."""
    n = len(sets)
    of = np.arange(n)
    can = Sketches(map(sketch, sets), threshold)
    out = []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        for j in can.possible(i, rest[of[rest] != of[i]]).tolist():
            if of[j] == of[i]:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if shared >= threshold * (len(sets[i]) + len(sets[j]) - shared):
                out.append((i, j))
                of[of == of[j]] = of[i]
    return out


def similar(sets: DataFrame, groups: DataFrame, threshold: float, block: int = 256) -> DataFrame:
    """Links (a, b) between the sets (key, set) of each group (node, root), a text in one group at most.

    All pairs of a group are compared, except those that links of the same task join already. Larger groups are dealt
    out as pairs of blocks, so no task holds more than two blocks."""
    counts = groups.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = groups.join(counts, "root").select("root", F.col("node").alias("key"), "blocks", F.pmod(F.hash("node"), F.col("blocks")).alias("own"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("root", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "key")
    dealt = placed.hint("merge").join(sets.hint("merge"), "key").select("root", "i", "j", "key", "set").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "key")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, keys, blobs in _groups(batches, 3):
            links = joined([np.frombuffer(x, np.uint32) for x in blobs], threshold)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([int(keys[x[k]]) for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5, radius: int = 1, parts: int = 2, key: str = "doc_id") -> DataFrame:
    """(doc_id, component_id): groups of texts that link at a Jaccard similarity of `threshold` of their word shingles.

    A pair above the threshold differs in few places, so it has sampled windows in common (see `samples`, where this is proved for texts
    that differ by words put in, left out or replaced): windows whose
    SimHashes lie within `radius` bits (generalised pigeonhole) bring two texts together, unless sketches of their shingle
    sets rule the similarity out. Of each bucket a spanning forest of these pairs is kept, which connects all texts that such
    pairs connect; each group so connected is then compared pair by pair on the shingle sets (32-bit hashes of all shingles).
    Texts with the same words are one class and linked without comparison. Null and blank texts are each their own group;
    texts of under five words are one shingle. Very long texts are taken whole. Repeated rows and ties stay and share a
    component. Rows with a null doc_id are groups of their own (component null). An empty table gives none. Other columns,
    of any names, take no part. Several texts under one doc_id are each compared, and a link
    of one of them holds for the doc_id.
    """
    import xxhash

    source = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes(KNOWN)
        for batch in batches:
            for part in slices(batch):
                ids, cls, sims, runs = [], [], [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = words_of(t, lower=True)
                    h = known.of(words)
                    ids.append(d)
                    cls.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else b"")
                    sims.append(sketch(shingle_set(h, size)))
                    runs.append(signed(samples(h)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(cls, pa.binary()), pa.array(sims, pa.binary()), pa.array(runs, pa.list_(pa.int64()))],
                    ["key", "cls", "sim", "runs"],
                )
        pa.default_memory_pool().release_unused()  # workers live on: what Arrow keeps for them counts

    described = cut(source.mapInArrow(describe, "key long, cls binary, sim binary, runs array<long>"), "described")
    named = described.where("key is not null and cls <> X''")
    classes = cut(named.groupBy("cls").agg(F.min("key").alias("first")), "classes")
    reps = named.join(classes.hint("merge"), "cls").where("key = first")
    reps = cut(reps.select(F.col("key").alias("id"), "sim", "runs"), "reps")
    items = cut(reps.select("id", F.explode("runs").alias("fp")), "items")
    met = components(gph_links(items, radius, parts, reps.select("id", "sim"), threshold).select("a", "b"))

    def shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes(KNOWN)
        for batch in batches:
            for part in slices(batch):
                sets = [shingle_set(known.of(words_of(t, lower=True)), size).tobytes() for t in unpacked(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["key", "set"])
        pa.default_memory_pool().release_unused()

    # joins on keys of unproven number are sorted, never broadcast; texts cross the exchange compressed
    ends = met.select(F.col("node").alias("key"))
    sets = cut(pack_text(source).join(ends.hint("merge"), "key", "left_semi").mapInArrow(shingles, "key long, set binary").dropDuplicates(["key", "set"]), "sets")
    nodes = components(similar(sets, met, threshold))
    rooted = cut(classes.join(nodes, F.col("first") == F.col("node"), "left").select("cls", "first", F.coalesce("root", "first").alias("root")), "rooted")
    member = described.select("key", "cls").hint("merge").join(rooted.hint("merge"), "cls", "left")
    out = cut(member.select(F.col("key").alias(key), F.when(F.col("key").isNotNull(), F.coalesce("root", "key")).alias("component_id")), "groups")
    for table in (classes, reps, items, met, sets, nodes, described, rooted):
        drop_cut(table)
    return out


def keep_one(docs: DataFrame, threshold: float = 0.8, key: str = "doc_id") -> DataFrame:
    """docs without the near-duplicates: of each group the rows of its smallest doc_id stay, repeats of them too.

    Rows with a null doc_id stay, and so do null and blank texts, which are like no other. Columns may have any names."""
    groups = near_duplicates(docs, threshold, key=key)
    names, plain = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    own, text = plain[names.index(key)], plain[names.index("text")]
    gone = groups.where(F.col("component_id") < F.col(key)).select(F.col(key).alias(own)).distinct()
    rows = docs.toDF(*plain)
    kept = pack_text(rows, text).join(gone.hint("merge"), own, "left_anti")
    return unpack_text(kept, rows.schema, text).toDF(*names)
