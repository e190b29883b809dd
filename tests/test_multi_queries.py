"""The queries over overlapping blocks of six samples, each held against a plain walk over the query's own rows."""

import json
import random
from pathlib import Path

import pytest

from genoweave.functions.seq import BASES, GAP_EXTEND, GAP_OPEN, OTHER, SUBSTITUTION
from genoweave.operators import aligners
from genoweave.plans import catalog
from genoweave.plans.views import register
from tests.test_aligners import full

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.is_dir(), reason="no tables here")


@pytest.fixture(scope="module")
def view(spark):
    return [r.asDict() for r in register(spark, str(SF), "v_multi")["v_multi"].collect()]


@pytest.fixture(scope="module")
def rows_of(spark):
    held = {}

    def get(name):
        if name not in held:
            held[name] = [r.asDict(True) for r in catalog.QUERIES[name](spark, str(SF)).collect()]
        return held[name]

    return get


def letters(t):
    return t.replace("-", "")


def range_score(x, y):
    total, gap = 0, 0
    for a, b in zip(x, y, strict=True):
        if a == b == "-":
            continue
        side = 1 if a == "-" else 2 if b == "-" else 0
        if side:
            total -= GAP_EXTEND + (0 if gap == side else GAP_OPEN)
        else:
            i, j = BASES.find(a), BASES.find(b)
            total += SUBSTITUTION[i][j] if i >= 0 and j >= 0 else OTHER
        gap = side
    return total


def col(text, k):
    """The column of the k-th letter (from 0)."""
    return [i for i, c in enumerate(text) if c != "-"][k]


def cut(b, lo, hi):
    """Columns lo .. hi - 1 of a two-row block."""
    return {**b, "t_start": b["t_start"] + len(letters(b["t_text"][:lo])), "q_start": b["q_start"] + len(letters(b["q_text"][:lo])), "t_text": b["t_text"][lo:hi], "q_text": b["q_text"][lo:hi]}


def cover_once(blocks, side, least=6):
    """The rule of single coverage, block by block; rows of the side in order of their place on the plus strand."""
    work = []
    for b in blocks:
        up, low = (b["t_text"], b["q_text"]) if side == "t" else (b["q_text"], b["t_text"])
        n, st = len(letters(up)), b[f"{side}_start"]
        back = side == "q" and b["q_strand"] == "-"
        if back:
            st, up, low = b["q_size"] - st - n, up[::-1], low[::-1]
        if n:
            work.append(dict(b=b, st=st, en=st + n, up=up, low=low, lo=0, hi=len(up), first=0, last=n, back=back, alive=True))
    work.sort(key=lambda w: (w["st"], -w["en"], w["b"]["block"]))
    for i, x in enumerate(work):
        for y in work[i + 1 :]:
            if not x["alive"] or not y["alive"]:
                continue
            end, beg = x["st"] + x["last"] - 1, y["st"] + y["first"]
            if beg > end or y["st"] + y["last"] - 1 < x["st"] + x["first"]:
                continue
            if end >= y["st"] + y["last"] - 1:
                y["alive"] = False
                continue
            left = max(beg, x["st"] + x["first"])
            at, to = col(x["up"], left - x["st"]), col(y["up"], end - y["st"])
            if range_score(x["up"][at : x["hi"]], x["low"][at : x["hi"]]) <= range_score(y["up"][y["lo"] : to + 1], y["low"][y["lo"] : to + 1]):
                x["hi"], x["last"] = at, left - x["st"]
            else:
                y["first"] = end + 1 - y["st"]
                y["lo"] = col(y["up"], y["first"])
            for w in (x, y):
                w["alive"] = w["alive"] and w["hi"] - w["lo"] >= least and w["last"] > w["first"]
    out = []
    for w in work:
        if w["alive"]:
            lo, hi = (len(w["up"]) - w["hi"], len(w["up"]) - w["lo"]) if w["back"] else (w["lo"], w["hi"])
            out.append(cut(w["b"], lo, hi))
    return out


def test_single_coverage_is_the_walk(view, rows_of):
    want, whole = {}, {b["block"]: b for b in view}
    for key in {(b["sample"], b["contig"]) for b in view}:
        once = cover_once([b for b in view if (b["sample"], b["contig"]) == key], "t")
        for b in cover_once(once, "q"):
            if letters(b["t_text"]) and letters(b["q_text"]):
                want[b["block"]] = (b["t_start"], b["t_text"], b["q_start"], b["q_text"], range_score(b["t_text"], b["q_text"]))
    got = {r["block"]: (r["t_start"], r["t_text"], r["q_start"], r["q_text"], r["score"]) for r in rows_of("single_coverage")}
    assert got == want
    assert len(got) < len(view) and sum(len(x[1]) < len(whole[k]["t_text"]) for k, x in got.items()) > len(got) / 4  # blocks go and are cut


def test_threading_finds_clashes(rows_of):
    assert sum(r["clashes"] for r in rows_of("threading")) > 100


def test_global_alignments_are_optimal(rows_of):
    for r in random.Random(2).sample(rows_of("global_align"), 200):
        assert (letters(r["a_row"]), letters(r["b_row"])) == (r["a"], r["b"])
        assert aligners.pair_cost(r["a_row"], r["b_row"]) == full(r["a"], r["b"])


def sliced(rows, p, q):
    """Positions p .. q - 1 of the top: rows with letters there, without columns of dashes."""
    lo, hi = col(rows[0]["text"], p - rows[0]["start"]), col(rows[0]["text"], q - 1 - rows[0]["start"]) + 1
    return columns(rows, lo, hi)


def columns(rows, lo, hi):
    out = [{**r, "start": r["start"] + len(letters(r["text"][:lo])), "text": r["text"][lo:hi], "size": len(letters(r["text"][lo:hi]))} for r in rows if letters(r["text"][lo:hi])]
    keep = [c for c in range(hi - lo) if any(r["text"][c] != "-" for r in out)]
    return [{**r, "text": "".join(r["text"][c] for c in keep)} for r in out]


def span(rows):
    return rows[0]["start"], rows[0]["start"] + rows[0]["size"]


def joined(a, b, p, q):
    one, two = sliced(a, p, q), sliced(b, p, q)
    if len(two) < 2:
        return None
    texts = aligners.align_blocks([r["text"] for r in one], [r["text"] for r in two])
    return [{**r, "text": t} for r, t in zip([*one, *two[1:]], texts, strict=True)]


def merged(a, b):
    """Two single-covered lists as one."""
    out, used = [], {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            p, q = max(span(x)[0], span(y)[0]), min(span(x)[1], span(y)[1])
            if p < q and x[0]["src"] == y[0]["src"] and (both := joined(x, y, p, q)):
                out.append(both)
                used.setdefault((0, i), set()).update(range(p, q))
                used.setdefault((1, j), set()).update(range(p, q))
    for k, side in enumerate((a, b)):
        for i, x in enumerate(side):
            free = [p for p in range(*span(x)) if p not in used.get((k, i), ())]
            for n, p in enumerate(free):
                if n == 0 or free[n - 1] != p - 1:
                    end = p
                    while end + 1 in free:
                        end += 1
                    part = sliced(x, p, end + 1)
                    if len(part) > 1:
                        out.append(part)
    return out


def as_rows(b, name="contig"):
    row = lambda src, start, strand, text: dict(src=src, start=start, size=len(letters(text)), strand=strand, src_size=100_000_000, text=text)
    return [row(f"ref.{b[name].split('.')[-1]}", b["t_start"], "+", b["t_text"]), row(f"{b['sample']}.{b['q_contig'].split('.')[-1]}", b["q_start"], b["q_strand"], b["q_text"])]


def key(rows):
    return tuple(tuple(sorted(r.items())) for r in rows)


def test_merged_blocks_are_the_walk(rows_of):
    """Contig by contig: three of them."""
    once = rows_of("single_coverage")
    got = rows_of("merged_blocks")
    assert {r["n"] for r in got} >= {3, 4, 5, 6, 7}
    for contig in ("c0", "c3", "c6"):
        s = [[as_rows({**r, "sample": f"S{k}"}) for r in once if r["contig"] == f"S{k}.{contig}"] for k in range(6)]
        want = merged(merged(merged(s[0], s[1]), s[2]), merged(merged(s[3], s[4]), s[5]))
        assert sorted(key(b) for b in want) == sorted(key(json.loads(r["rows"])) for r in got if r["contig"] == f"ref.{contig}")


def half(a, b, c, d):
    shared = min(b, d) - max(a, c)
    return shared > 0 and (2 * shared > b - a or 2 * shared > d - c or shared >= 300)


def test_evidence_is_the_count_over_pairs(view, rows_of):
    def plus(r):
        st = r["src_size"] - r["start"] - r["size"] if r["strand"] == "-" else r["start"]
        return st, st + r["size"]

    known = {}
    for b in view:
        t, q = as_rows(b)
        known.setdefault((t["src"], q["src"], t["strand"] == q["strand"]), []).append((*plus(t), *plus(q)))
    want = {}
    for m in rows_of("merged_blocks"):
        rows = json.loads(m["rows"])
        n = hits = 0
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                n += 1
                x, y = sorted((a, b), key=lambda r: not r["src"].startswith("ref."))
                places = known.get((x["src"], y["src"], x["strand"] == y["strand"]), ())
                hits += any(half(*plus(x), *p[:2]) and half(*plus(y), *p[2:]) for p in places)
        want.setdefault((len(rows), round(hits / n, 9)), 0)
        want[len(rows), round(hits / n, 9)] += 1
    got = {}
    for r in rows_of("evidence"):
        got[r["n"], round(r["share"], 9)] = got.get((r["n"], round(r["share"], 9)), 0) + 1
    assert got == want and any(0 < s < 1 for _, s in got)


def test_nested_blocks_are_the_walk(view, rows_of):
    lists = [[as_rows(b) for b in view if b["sample"] == s] for s in ("S1", "S2")]
    used, want = [{}, {}], []
    for i, a in enumerate(lists[0]):
        for j, b in enumerate(lists[1]):
            p, q = max(span(a)[0], span(b)[0]), min(span(a)[1], span(b)[1])
            if a[0]["src"] == b[0]["src"] and p < q and (both := joined(a, b, p, q)):
                want.append(("both", key(both)))
                for k, n, x in ((0, i, a), (1, j, b)):
                    used[k].setdefault(n, set()).update(range(col(x[0]["text"], p - x[0]["start"]), col(x[0]["text"], q - 1 - x[0]["start"]) + 1))
    for k, kind in ((0, "first"), (1, "second")):
        for n, x in enumerate(lists[k]):
            lo = None
            for c in range(len(x[0]["text"]) + 1):
                free = c < len(x[0]["text"]) and c not in used[k].get(n, ())
                if free and lo is None:
                    lo = c
                if not free and lo is not None:
                    if part := columns(x, lo, c):
                        want.append((kind, key(part)))
                    lo = None
    got = rows_of("nested_blocks")
    assert sorted((r["kind"], key(json.loads(r["rows"]))) for r in got) == sorted(want)
    assert {r["kind"] for r in got} == {"both", "first", "second"}
    # a position of a list's block can be in several joint blocks
    both = [json.loads(r["rows"]) for r in got if r["kind"] == "both"]
    assert len({(r["src"], p) for b in both for r in b[:1] for p in range(*span(b))}) < sum(b[0]["size"] for b in both)


def test_covered_parts_are_the_walk(view, rows_of):
    over = {}
    for r in rows_of("single_coverage"):
        if r["contig"].startswith("S2."):
            over.setdefault("ref." + r["contig"].split(".")[1], []).append((r["t_start"], r["t_start"] + len(letters(r["t_text"]))))
    want = []
    for b in view:
        if b["sample"] == "S1":
            rows = as_rows(b)
            want += [key(sliced(rows, max(p, span(rows)[0]), min(q, span(rows)[1]))) for p, q in over.get(rows[0]["src"], ()) if p < span(rows)[1] and span(rows)[0] < q]
    got = rows_of("covered_blocks")
    assert sorted(key(json.loads(r["rows"])) for r in got) == sorted(want) and len(want) > 100


def test_scores_are_those_of_all_pairs_of_rows(rows_of):
    opens = {(0, 0, 0, 1), (0, 0, 1, 0), (0, 1, 1, 0), (1, 0, 0, 1), (1, 1, 0, 1), (1, 1, 1, 0)}
    for r in random.Random(4).sample(rows_of("nested_blocks"), 100):
        rows, total = [x["text"] for x in json.loads(r["rows"])], 0
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                for c in range(len(a)):
                    x, y = a[c], b[c]
                    if "-" in (x, y):
                        total -= 0 if x == y else GAP_EXTEND
                    else:
                        total += SUBSTITUTION[BASES.index(x)][BASES.index(y)]
                    if c and (a[c - 1] == "-", b[c - 1] == "-", x == "-", y == "-") in {tuple(map(bool, o)) for o in opens}:
                        total -= GAP_OPEN
        assert total == r["score"]


def test_region_rows_follow_the_blocks(rows_of):
    """Stretches of the reference: what blocks hold there, taken by start, what one before covers left out; N between them."""
    blocks = {}
    for m in rows_of("merged_blocks"):
        blocks.setdefault(m["contig"], []).append(json.loads(m["rows"]))
    got = {}
    for r in rows_of("region_rows"):
        got.setdefault((r["contig"], r["beg"], r["fin"], r["len"], r["kind"]), {})[r["genome"]] = r["text"]
    for k in random.Random(6).sample(sorted(got), 150):
        lo, hi = k[1] // 10, k[1] // 10 + 60
        pieces, reach = [], lo
        for b in sorted(blocks[f"ref.{k[0]}"], key=span):
            p, q = max(reach, span(b)[0]), min(hi, span(b)[1])
            if p < q:
                text = b[0]["text"]
                c0 = col(text, p - span(b)[0]) if p > span(b)[0] else 0
                c1 = col(text, q - 1 - span(b)[0]) + 1 if q < span(b)[1] else len(text)
                if p > reach:
                    pieces.append((p - reach, {"ref": "N" * (p - reach)}))
                pieces.append((c1 - c0, {r["src"].split(".")[0]: r["text"][c0:c1] for r in reversed(b)}))
                reach = q
        if reach < hi:
            pieces.append((hi - reach, {"ref": None}))
        for g, text in got[k].items():
            at = 0
            for n, p in pieces:
                part = text[at : at + n]
                if g in p and p[g] is None:
                    assert set(text[at:]) <= {"N"}
                    break
                assert part == p.get(g, "-" * n), (k, g)
                at += n
        assert set(got[k]) == {g for _, p in pieces for g in p}


def test_fused_blocks_are_those_of_the_list(spark, rows_of):
    """Contig by contig, in order of the reference; the samples' rows can fill holes."""
    from tests.test_fusing import key as fused_key
    from tests.test_fusing import plain

    own = [r["rows"] for r in catalog._pairwise(register(spark, str(SF), "v_multi")["v_multi"]).selectExpr("slice(rows, 2, 1) AS rows").withColumn("no", catalog.F.xxhash64(catalog.F.to_json("rows"))).orderBy("no").collect()]
    orphans = [[r.asDict() for r in rows] for rows in own]
    got, fused = {}, rows_of("fused_blocks")
    for r in fused:
        rows = json.loads(r["rows"])
        got.setdefault(rows[0]["src"], []).append(fused_key(rows))
    by = {}
    for m in rows_of("merged_blocks"):
        by.setdefault(m["contig"], []).append(json.loads(m["rows"]))
    assert set(got) == set(by) and len(fused) < len(rows_of("merged_blocks")) / 2
    for contig in sorted(by)[:4]:
        want, _ = plain(sorted(by[contig], key=span), orphans)
        assert sorted(fused_key(b) for b in want) == sorted(got[contig])


def test_annotations_by_plain_rules(spark, rows_of):
    """Classes from k-mers of the neighbourhood, shares from alignments in order that overlap the last kept one by at most a tenth."""
    from genoweave.plans import annotate as annotation

    views = register(spark, str(SF), "v_indel", "v_seq", "v_iv")
    v, refs = catalog._marked(views["v_indel"], views["v_seq"])
    seqs = {r["contig"]: r["seq"] for r in refs.collect()}
    hits = {}
    for r in catalog._hits(v, views["v_iv"]).collect():
        hits.setdefault(r["qname"], []).append((r["qs"], r["qe"], r["tname"], r["qlen"]))
    comp = str.maketrans("ACGTN", "TGCAN")

    def share(a, b):
        n = len(a) - 9
        return sum(a[i : i + 10] in b for i in range(n)) / n if n > 0 else 0.0

    def copy(r):
        s, n, p = seqs[r["chrom"]], len(r["alt"]), r["pos"]
        if n == 9:
            return "NF"
        five, three = s[max(0, p - n) : p], s[p : p + n]
        for own, suffix in ((r["alt"], "DUP"), (r["alt"][::-1].translate(comp), "INVDUP")):
            a, b = share(own, five), share(own, three)
            if max(a, b) > 0.5:
                return ("5" if a > b else "3") + suffix
        return "NONDUP"

    def text(rows, kind):
        last, sums = None, {}
        for st, en, name, size in sorted(rows):
            if last and (min(en, last[1]) - max(st, last[0]) + 1) / (en - st + 1) > 0.1:
                continue
            last = (st, en)
            sums.setdefault(kind(name), [0, size])[0] += en - st
        return "(" + ";".join(f"{k}:{100 * n / size:.1f}%" for k, (n, size) in sorted(sums.items())) + ")" if sums else "NF"

    found = rows_of("annotate")
    for r in found:
        own = hits.get(f"{r['chrom']}_{r['pos']}_{r['id']}", [])
        genes = text([h for h in own if h[1] % 2 == 0], lambda n: n)
        te = text(own, lambda n: n.split("#")[1].split("/")[0])
        parts = r["info"].split(";", 1)[1]
        assert parts == ";".join((copy(r), genes, te)), r
    classes = {r["info"].split(";")[1] for r in found}
    assert classes == {"5DUP", "3DUP", "5INVDUP", "3INVDUP", "NONDUP", "NF"}


def test_inserted_sequences_decide_open_calls(spark, rows_of):
    """Where the span decides, the call is that of genotype_ins; carriers have it; the others are told by an optimal alignment of the same letters."""
    spans = {tuple(r[c] for c in ("contig", "beg", "fin", "len", "kind", "sample")): r["gt"] for r in rows_of("genotype_ins")}
    got = {tuple(r[c] for c in ("contig", "beg", "fin", "len", "kind", "sample")): r["gt"] for r in rows_of("genotype_insertions")}
    carried = {k for k in got if k[-1] == f"S{k[1] % 6}"}
    assert all(got[k] == "1|1" for k in carried) and set(got) == set(spans) | carried
    opened = 0
    for k, gt in spans.items():
        if gt != "window":
            assert got[k] == gt
        else:
            opened += 1
            assert got[k] in ("0|0", "1|1", ".|.")
    assert opened > 20
