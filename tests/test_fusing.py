"""Fused narrow blocks against a list walked with whole blocks."""

import random

import pytest
from pyspark.sql import functions as F

from genoweave.operators import fusing
from genoweave.sources.readers import ROW

rnd = random.Random(41)


def row(src, start, text, strand="+"):
    return dict(src=src, start=start, size=len(text.replace("-", "")), strand=strand, src_size=10**6, text=text)


def find(b, src):
    return next((r for r in b if r["src"] == src), None)


def end(r):
    return r["start"] + r["size"]


def glue(a, b):
    """b behind a, in place."""
    n, m = len(a[0]["text"]), len(b[0]["text"])
    for r in a:
        d = find(b, r["src"])
        r["text"] += d["text"] if d else "-" * m
        r["size"] += d["size"] if d else 0
    for d in b:
        if not find(a, d["src"]):
            a.append({**d, "text": "-" * n + d["text"]})
    # the dashes at the seam that every row can spare go
    runs = [(len(r["text"][:n].rstrip("-")), n + len(r["text"][n:]) - len(r["text"][n:].lstrip("-"))) for r in a]
    spare = min(q - p for p, q in runs)
    for r, (p, q) in zip(a, runs, strict=True):
        r["text"] = r["text"][:p] + "-" * (q - p - spare) + r["text"][q:]


def join(a, b, orphans, narrow):
    """a and b in place (the first grows), if the narrow one of them allows it."""
    rows, other = (b, a) if narrow == "b" else (a, b)
    gaps = []
    for r in rows:
        d = find(other, r["src"])
        if not d or d["strand"] != r["strand"]:
            return False
        gap = r["start"] - end(d) if narrow == "b" else d["start"] - end(r)
        if not 0 <= gap <= 20:
            return False
        gaps.append((gap, r, d))
    if any(g for g, _, _ in gaps):
        _, r, d = next(x for x in gaps if x[0])
        edge = d if narrow == "b" else r
        w = next((o for o in orphans if (x := find(o, edge["src"])) and x["strand"] == edge["strand"] and x["start"] == end(edge)), None)
        if w is None:
            return False
        for _, r, d in gaps:
            x = find(w, r["src"])
            if narrow == "b":
                at = r["start"]
                if x:
                    if x["strand"] != r["strand"] or end(x) != at:
                        return False
                    at = x["start"]
                if end(d) != at:
                    return False
            else:
                at = end(r)
                if x:
                    if x["strand"] != r["strand"] or x["start"] != at:
                        return False
                    at = end(x)
                if d["start"] != at:
                    return False
        if narrow == "b":
            glue(a, [dict(x) for r in a if (x := find(w, r["src"])) and x["strand"] == r["strand"] and x["start"] == end(r)])
            glue(a, b)
        else:
            mid = [dict(x) for d in b if (x := find(w, d["src"])) and x["strand"] == d["strand"] and end(x) == d["start"]]
            glue(mid, b)
            glue(a, mid)
    else:
        glue(a, b)
    return True


def toss(b, names):
    left = [r for i, r in enumerate(b) if i == 0 or r["src"] in names]
    cols = [c for c in range(len(left[0]["text"])) if any(r["text"][c] != "-" for r in left)]
    b[:] = [{**r, "text": "".join(r["text"][c] for c in cols)} for r in left]


def plain(blocks, orphans):
    """The list rule: blocks are lists of rows, changed in place."""
    todo = [[dict(r) for r in b] for b in blocks]
    out, stats = [], {"left": 0, "right": 0, "toss": 0}
    while todo:
        b = todo.pop(0)
        size = len(b[0]["text"])
        a, c = (out[-1] if out else None), (todo[0] if todo else None)
        if size > 30:
            out.append(b)
        elif a and join(a, b, orphans, "b"):
            stats["left"] += 1
        elif c and join(b, c, orphans, "a"):
            todo[0] = b
            stats["right"] += 1
        elif size <= 20 and a and c:
            back = {r["src"] for r in b if (d := find(a, r["src"])) and d["strand"] == r["strand"] and end(d) == r["start"]}
            on = {r["src"] for r in b if (d := find(c, r["src"])) and d["strand"] == r["strand"] and end(r) == d["start"]}
            i, j = len(b) - len(back), len(b) - len(on)
            if i <= j and (i <= 3 or size <= 10):
                toss(b, back)
                stats["toss"] += 1
                if not join(a, b, orphans, "b"):
                    out.append(b)
            elif j <= 3 or size <= 10:
                toss(b, on)
                stats["toss"] += 1
                if join(b, c, orphans, "a"):
                    todo[0] = b
                else:
                    out.append(b)
            else:
                out.append(b)
        else:
            out.append(b)
    return out, stats


def projection(n, contig):
    """Blocks along a contig: rows mostly go on from block to block, some are missing, some jump, some holes are filled by blocks without the reference."""
    at = {f"s{k}.{contig}": rnd.randrange(1000) for k in range(5)}
    ref, blocks, others = 100, [], []
    for _ in range(n):
        width = rnd.choice((4, 8, 8, 12, 18, 25, 40, 40))
        names = [s for s in at if rnd.random() < 0.75]
        hole = [s for s in names if rnd.random() < 0.08]
        if hole and rnd.random() < 0.8:
            size = rnd.randrange(1, 12)
            others.append([row(s, at[s], "".join(rnd.choice("ACGT") for _ in range(size)), "-" if s.startswith("s4") and rnd.random() < 0.8 else "+") for s in hole])
            for s in hole:
                at[s] += size
        for s in names:
            if rnd.random() < 0.03:
                at[s] += rnd.choice((5, 40))
        if rnd.random() < 0.05:
            ref += rnd.choice((3, 30))
        texts = {s: "".join(rnd.choice("ACGT-") for _ in range(width)) for s in names}
        texts = {s: t for s, t in texts.items() if t.strip("-")}
        top = "".join(rnd.choice("ACGTACGT-") for _ in range(width)) or "A"
        top = top if top.strip("-") else "A" * width
        cols = [c for c in range(width) if top[c] != "-" or any(t[c] != "-" for t in texts.values())]
        b = [row(f"r.{contig}", ref, "".join(top[c] for c in cols))] + [row(s, at[s], "".join(t[c] for c in cols), "-" if s.startswith("s4") else "+") for s, t in texts.items()]
        for r in b[1:]:
            at[r["src"]] = end(r)
        ref = end(b[0])
        blocks.append(b)
    return blocks, others


def key(rows):
    return tuple(sorted((r["src"], r["start"], r["size"], r["strand"], r["text"]) for r in rows))


@pytest.mark.parametrize("parts", [1, 7, 30])
def test_fused_blocks_are_those_of_the_list(spark, parts):
    rnd.seed(parts)
    every, others, want, stats = [], [], [], {}
    for contig in ("a", "b"):
        blocks, own = projection(160, contig)
        every += blocks
        others += own
        out, s = plain(blocks, own)
        want += [key(b) for b in out]
        for k, v in s.items():
            stats[k] = stats.get(k, 0) + v
    assert all(v > 5 for v in stats.values()) and others
    df = spark.createDataFrame([(b,) for b in every], f"rows array<{ROW}>")
    fill = spark.createDataFrame(list(enumerate(others)), f"no long, rows array<{ROW}>")
    got = fusing.fuse_short(df, fill, parts=parts).collect()
    assert sorted(key([r.asDict() for r in x["rows"]]) for x in got) == sorted(want)


def test_seams_and_empty_tables(spark):
    assert fusing.put_together([("a", "AC--"), ("b", "A-C-")], [("a", "-G"), ("b", "-T")]) == [("a", "AC-G"), ("b", "A-CT")]
    assert fusing.put_together([("a", "AC")], [("a", "GT"), ("b", "-A")]) == [("a", "ACGT"), ("b", "---A")]
    df = spark.createDataFrame([], f"rows array<{ROW}>")
    assert fusing.fuse_short(df, df.withColumn("no", F.lit(1).cast("long"))).count() == 0
