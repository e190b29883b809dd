"""Operator 10: personal data by candidate gradient boosting, with DataFrame functions only.

Generators propose overlapping spans with high recall: the four base kinds without their tests, and looser forms of them. Every
candidate has format features (of its own characters) and context features (of the characters around it). Boosted
regression trees score the candidates and are applied as SQL expressions.

No table has labels, and the base rules cannot give them for what they do not match. The trees are therefore fitted to texts with
planted spans: `planted` writes them, by a hash of the row's number, from forms in which people write such data and from
forms that look alike but are none (times, versions, serial and article numbers, sums, ranges). A candidate is positive
if it covers the planted datum and not much more. The score from which a candidate is added is calibrated on planted
texts that the trees have not seen: scores are pooled until the share of positives falls with the score (isotonic
regression), and the least score whose pool has the wanted share is taken. Both need only the counts of the feature vectors,
of which there are at most as many as the product of the bins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm.common import cut, drop_cut

#: Fixed: the kinds in the order in which spans of equal start are listed.
KINDS = ("email", "ip", "card", "phone")

# The patterns match what the plain ones of the contract match, without backtracking into runs: a run of characters of
# the first class is entered only at its start or where the last match ended, and runs are possessive.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser forms, each of the kind it would be redacted as: addresses with spaces around or words for the signs,
#: numbers with other separators or mistyped, and telephone numbers without a plus.
LOOSE = {
    "email": r"(?i)(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?: ?@ ?|\[at\]| \[at\] |\(at\)| \(at\) )[A-Za-z0-9-]++(?:(?:\.|\[dot\]| \[dot\] |\(dot\)| \(dot\) )[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\]|,)[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[./_ -][0-9]{4,6}+){2,4}+(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00|\(|0|[1-9])[0-9][ ()./0-9-]{6,}[0-9]",
}


def spans_of(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<start, stop, kind, s>> of the matches: pieces between matches give the positions (code points)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.arrays_zip(hits.alias("s"), gaps.alias("g"))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,kind:int,s:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        stop = start + F.length(x["s"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"), x["s"].alias("s")))).alias("out"))

    found = F.filter(both, lambda x: x["s"].isNotNull())
    return F.when(F.size(hits) > 0, F.aggregate(found, first, add, lambda acc: acc["out"])).otherwise(first["out"])


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of 12 to 19 digits passes (false for others): from the right, every second digit counts double, less 9 if over 9."""

    def add(acc: Column, i: Column) -> Column:
        v = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        w = F.when(i % 2 == 1, F.when(v > 4, 2 * v - 9).otherwise(2 * v)).otherwise(v)
        return acc + w

    total = F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add)
    return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(False)


def small_parts(s: Column) -> Column:
    return F.forall(F.split(s, r"\."), lambda p: p.rlike("^0*[0-9]{1,3}$") & (F.coalesce(F.regexp_extract(p, "([0-9]{1,3})$", 1).try_cast("int"), F.lit(999)) <= 255))


def is_base(kind: str, s: Column) -> Column:
    d = digits(s)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return small_parts(s)
    if kind == "card":
        return F.length(d).between(14, 19) & luhn(d)
    return F.length(d).between(10, 15)


#: Words before a datum that announce it, by kind, and words that announce another number.
CUES = {
    "email": "e-?mail|mail|contact|write|reach",
    "ip": "ip|addr|address|host|server|login|from",
    "card": "card|visa|mastercard|amex|credit|debit|paid|charged|account",
    "phone": "phone|tel|telephone|fax|call|mobile|mobil|cell|ring|whatsapp|sms",
}
ADVERSE = "order|orders|invoice|isbn|ean|version|release|serial|item|page|pages|ticket|section|tracking|article|build|id|no|nr|row|total|sum|year|between|at|on|v"


def candidate(text: Column, kind: int, x: Column) -> Column:
    """A proposed span with its binned features."""
    s, d = x["s"], digits(x["s"])
    n = F.length(d)
    before = F.substring(text, F.greatest(F.lit(1), x["start"] - 15), F.least(F.lit(16), x["start"]))
    after = F.substring(text, x["stop"] + 1, F.lit(2))
    word = F.lower(F.regexp_extract(before, r"([A-Za-z-]+)[^A-Za-z0-9]*$", 1))
    cue = F.when(word.rlike(f"^({CUES[KINDS[kind]]})$"), 2).when(word.rlike(f"^({ADVERSE})$"), 3).when(before.rlike(r"[:=#]\s*$"), 1).otherwise(0)
    checks = {"email": s.rlike(r"(?i)(\.|dot[\])] ?)[a-z]{2,}$"), "ip": small_parts(F.regexp_replace(s, r"\[\.\]|,", ".")), "card": luhn(d), "phone": F.when(s.rlike(r"^(\+|00)"), 2).otherwise(s.rlike(r"^[(]?0").cast("int"))}
    shape = (
        F.when(s.rlike(r"^[0-9]+$"), 1).when(s.rlike(r"^[0-9]{4}(.[0-9]{4}){3}$") | s.rlike(r"^[0-9]{4}.[0-9]{6}.[0-9]{5}$"), 2)
        .when(s.rlike(r"^[(]?[0-9]{3}[)]?[ ./-]{0,2}[0-9]{3}[ ./-][0-9]{4}$"), 3)
        .when(s.rlike(r"^[0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{1,4}( |$)") | s.rlike(r"^97[89]"), 4).when(s.rlike("(?i)[a-z]"), 5).otherwise(0)
    )
    return F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), F.lit(kind).alias("kind"), s.alias("s"),
        F.when(n < 4, 0).when(n < 9, 1).when(n < 12, 2).when(n < 14, 3).when(n < 15, 4).when(n < 16, 5).when(n < 17, 6).when(n < 20, 7).otherwise(8).alias("f_digits"),
        F.least(F.lit(4), F.length(F.regexp_replace(s, "[A-Za-z0-9]", ""))).cast("int").alias("f_marks"),
        checks[KINDS[kind]].cast("int").alias("f_check"),
        s.rlike(r"(?i)\[at\]|\(at\)|\[dot\]|\(dot\)| @|@ |\[\.\]|[,/_]").cast("int").alias("f_loose"),
        shape.alias("f_shape"),
        cue.alias("f_cue"),
        F.when(x["start"] == 0, 0).when(before.rlike(r"\s$"), 0).when(before.rlike(r"[\p{L}0-9]$"), 2).otherwise(1).alias("f_left"),
        F.when(after == "", 0).when(after.rlike(r"^[\p{L}0-9]|^[.,:/-][0-9]"), 2).when(after.rlike(r"^[\s.,;:!?]"), 0).otherwise(1).alias("f_right"),
    )


FEATURES = ("kind", "f_digits", "f_marks", "f_check", "f_loose", "f_shape", "f_cue", "f_left", "f_right")
#: Bins of each feature: no more vectors than their product are ever brought to the driver.
BINS = (4, 9, 5, 3, 2, 6, 4, 3, 3)


def checked(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda x: is_base(kind, x["s"]))


def proposed(text: Column, base: Column, loose: Column, kind: int) -> Column:
    return F.transform(F.array_union(F.filter(base, lambda x: F.length(x["s"]) > 5), loose), lambda x: candidate(text, kind, x))


def found_spans(docs: DataFrame, kept: Column, text: str = "text") -> DataFrame:
    """(key, base, proposed): what is kept of each row, its checked base spans and its proposed spans with features."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    empty = F.array().cast("array<struct<start:int,stop:int,kind:int,s:string>>")
    # a cheap test first: most texts hold no sign that a kind needs
    may = {"email": t.contains("@"), "ip": t.rlike("[0-9]"), "card": t.rlike("[0-9]"), "phone": t.contains("+")}
    loose = {"email": t.contains("@") | t.rlike(r"(?i)\(at\)|\[at\]"), "ip": t.rlike("[0-9]"), "card": t.rlike("[0-9]"), "phone": t.rlike("[0-9]")}
    raw = docs.select(
        kept.alias("key"), t.alias("text"),
        *[F.when(may[k], spans_of(t, BASE[k], i)).otherwise(empty).alias(f"b_{k}") for i, k in enumerate(KINDS)],
        *[F.when(loose[k], spans_of(t, LOOSE[k], i)).otherwise(empty).alias(f"l_{k}") for i, k in enumerate(KINDS)],
    )
    base = F.concat(*[checked(F.col(f"b_{k}"), k) for k in KINDS])
    wide = F.concat(*[proposed(F.col("text"), F.col(f"b_{k}"), F.col(f"l_{k}"), i) for i, k in enumerate(KINDS)])
    return raw.select("key", base.alias("base"), wide.alias("proposed"))


# ---- boosting over counted feature vectors


@dataclass
class Tree:
    feature: int = -1
    least: int = 0  # rows with a feature value of at least this go right
    value: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def score(self, x: tuple[int, ...]) -> float:
        at = self
        while at.left:
            at = at.right if x[at.feature] >= at.least else at.left
        return at.value

    def column(self, features: list[Column]) -> Column:
        if not self.left:
            return F.lit(self.value)
        return F.when(features[self.feature] >= self.least, self.right.column(features)).otherwise(self.left.column(features))


@dataclass
class Boosted:
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    threshold: float = 2.0  # of the probability; over 1: nothing is added

    def raw(self, x: tuple[int, ...]) -> float:
        return self.base + sum(t.score(x) for t in self.trees)

    def probability(self, features: list[Column]) -> Column:
        total = F.lit(self.base)
        for t in self.trees:
            total = total + t.column(features)
        return 1 / (1 + F.exp(-total))


def _grow(rows: list[tuple[tuple[int, ...], float, float]], depth: int, rate: float) -> Tree:
    """rows: (features, sum of gradients, sum of Hessians)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    tree = Tree(value=rate * g / (h + 1.0))
    if not depth:
        return tree
    best = 1e-6
    for f, bins in enumerate(BINS):
        of = [[0.0, 0.0] for _ in range(bins)]
        for x, own_g, own_h in rows:
            of[x[f]][0] += own_g
            of[x[f]][1] += own_h
        lg = lh = 0.0
        for least in range(1, bins):
            lg, lh = lg + of[least - 1][0], lh + of[least - 1][1]
            gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
            if gain > best:
                best, tree.feature, tree.least = gain, f, least
    if tree.feature >= 0:
        tree.left = _grow([r for r in rows if r[0][tree.feature] < tree.least], depth - 1, rate)
        tree.right = _grow([r for r in rows if r[0][tree.feature] >= tree.least], depth - 1, rate)
    return tree


Counts = list[tuple[tuple[int, ...], int, int]]


def boost(counts: Counts, held: Counts | None = None, trees: int = 30, depth: int = 4, rate: float = 0.3, precision: float = 0.95) -> Boosted:
    """Logistic gradient boosting on (features, positives, all), and the threshold calibrated on held-out counts (the same, if there are none)."""
    n, pos = sum(c[2] for c in counts), sum(c[1] for c in counts)
    if not n or not pos:
        return Boosted()
    p = min(max(pos / n, 1e-4), 1 - 1e-4)
    model = Boosted(base=math.log(p / (1 - p)))
    raw = [model.base] * len(counts)
    for _ in range(trees):
        probs = [1 / (1 + math.exp(-min(max(r, -30), 30))) for r in raw]
        tree = _grow([(c[0], c[1] - c[2] * q, c[2] * q * (1 - q)) for c, q in zip(counts, probs, strict=True)], depth, rate)
        model.trees.append(tree)
        raw = [r + tree.score(c[0]) for r, c in zip(raw, counts, strict=True)]
    held = held or counts
    raw = [model.raw(c[0]) for c in held]
    pools: list[list[float]] = []  # isotonic calibration: positives, all and least score of runs whose share falls
    for i in sorted(range(len(held)), key=lambda i: -raw[i]):
        pools.append([held[i][1], held[i][2], raw[i]])
        while len(pools) > 1 and pools[-1][0] * pools[-2][1] >= pools[-2][0] * pools[-1][1]:
            pos, n, least = pools.pop()
            pools[-1] = [pools[-1][0] + pos, pools[-1][1] + n, least]
    for pos, n, least in pools:
        if pos >= precision * n:
            model.threshold = 1 / (1 + math.exp(-least)) - 1e-12
    return model


# ---- planted texts

#: Forms in which data are written (a kind), and forms that look alike and are none: letters stand for parts, see `planted`.
#: Every 9 is a random digit, # a digit from 1 to 9, B a number up to 255, N a name, D a domain, H a hexadecimal digit.
FORMS = (
    ("email", "N@D"), ("email", "N @ D"), ("email", "N[at]D"), ("email", "N (at) D"), ("email", "N [at] N [dot] com"), ("email", "N(at)N(dot)org"), ("email", "N.N@ D"),
    (None, "#9 @ 9.99"), (None, "9@#.9"), (None, "N(at)9.9"),
    ("ip", "B.B.B.B"), ("ip", "B[.]B[.]B[.]B"), (None, "#9,99,#9,#9"), (None, "B,B,B,B"), (None, "#.9.9.99.9"), (None, "#99.#99.#99.999"), (None, "9.9.#9.#99.#9.9"),
    ("card", "#999999999999999"), ("card", "9999999999999999"), ("card", "#999 9999 9999 9999"), ("card", "#999-9999-9999-9999"), ("card", "#999.9999.9999.9999"),
    ("card", "#999_9999_9999_9999"), ("card", "#999 999999 99999"), ("card", "#99999999999999"),
    (None, "2#99#99999"), (None, "2029111#999959"), (None, "97899999999#9"), (None, "978-#-99-999999-9"), (None, "#99999999999999999999"), (None, "HHHH9999HHHH9999HHHH9999"), (None, "H#999999999999999H"),
    (None, "#9999999"), (None, "#99999999"), (None, "#99999999999"), (None, "#999 9999 9999"),
    ("phone", "+# (#99) 999-9999"), ("phone", "(#99) 999-9999"), ("phone", "#99-999-9999"), ("phone", "#99.999.9999"), ("phone", "00#9 99 9999999"), ("phone", "+#9 99 9999 9999"),
    ("phone", "0#9/9999999"), ("phone", "0#9 9999 9999"), ("phone", "(0#9) 9999 9999"),
    (None, "20#9-0#-29"), (None, "20#9-0#-29 1#"), (None, "20#9-0#-29 0#-29"), (None, "0#.29.20#9 10-1#"), (None, "1#99-20#9"), (None, "#9 #9 #9 #9 #9"), (None, "#99 #99 #99"), (None, "#9999-#9999"), (None, "(#9) 99 (#9) 99"), (None, "#9/#9/#9/#9/#9"),
)
#: Which cue, if any, comes before a datum: own ones by kind, adverse ones, and none.
OWN = {"email": ("email:", "Mail", "contact"), "ip": ("from", "IP:", "host"), "card": ("card", "Visa:", "paid by card"), "phone": ("call", "Tel.", "phone:")}
OTHER = ("order", "invoice no.", "version", "ISBN", "serial", "page", "ticket #", "on", "between", "total:")


def planted(spark: SparkSession, rows: int, seed: int) -> DataFrame:
    """(id, text, start, stop, kind): texts, each with one form of FORMS in it; kind is -1 where the form is no datum.

    Row i has form i modulo their number; all other choices (words, cue, digits, what stands right and left) are hashes of i and the seed."""
    ids = spark.range(rows)
    draw = lambda salt, n: F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(n)).cast("int")
    pick = lambda xs, salt: F.element_at(F.array(*map(F.lit, xs)), draw(salt, len(xs)) + 1)
    kinds = F.array(*[F.lit(-1 if k is None else KINDS.index(k)) for k, _ in FORMS])
    form = (F.col("id") % len(FORMS)).cast("int") + 1

    def letters(salt: int) -> Column:
        """A word of 3 to 8 letters."""
        return F.translate(F.substring(F.md5(F.concat_ws(",", F.col("id").cast("string"), F.lit(f"{seed},{salt}"))), F.lit(1), draw(salt, 6) + 3), "0123456789", "ghijklmnop")

    def filled(x: Column, salt: Column) -> Column:
        """One sign of a form, written out."""
        h = F.xxhash64(F.col("id"), F.lit(seed), salt)
        return (
            F.when(x == "9", F.pmod(h, F.lit(10)).cast("string")).when(x == "#", (F.pmod(h, F.lit(9)) + 1).cast("string")).when(x == "B", F.pmod(h, F.lit(256)).cast("string"))
            .when(x == "H", F.substring(F.lit("abcdef0123456789"), (F.pmod(h, F.lit(16)) + 1).cast("int"), F.lit(1)))
            .when(x == "N", letters(1)).when(x == "D", F.concat(letters(2), F.lit("."), pick(("com", "org", "net", "example.com", "co.uk", "de"), 3))).otherwise(x)
        )

    signs = F.split(F.element_at(F.array(*[F.lit(f) for _, f in FORMS]), form), "")
    datum = F.array_join(F.transform(signs, lambda x, i: filled(x, i + 100)), "")
    kind = F.element_at(kinds, form)
    own = F.element_at(F.array(*[pick(OWN[k], 4) for k in KINDS]), kind + 1)
    # data: an own cue for four of ten, another's for one of twenty; look-alikes: another's for six of ten
    cue = F.when((kind >= 0) & (draw(5, 20) < 8), own).when((kind >= 0) & (draw(5, 20) < 9) | (kind < 0) & (draw(5, 20) < 12), pick(OTHER, 6)).otherwise("")
    lead = F.concat_ws(" ", letters(7), letters(8))
    head = F.concat(F.when(draw(9, 8) == 0, "").otherwise(F.concat(lead, F.lit(" "))), F.when(cue == "", "").otherwise(F.concat(cue, F.lit(" "))), F.when(draw(10, 20) == 0, pick(("(", "\"", "=", "|"), 11)).otherwise(""))
    tail = F.concat(F.when(draw(12, 5) == 0, pick((".", ",", "!!", ")", "###", "&&&"), 13)).otherwise(""), F.when(draw(14, 8) == 0, "").otherwise(F.concat(F.lit(" "), letters(15))))
    out = ids.select("id", kind.alias("kind"), head.alias("head"), datum.alias("datum"), tail.alias("tail"))
    start = F.length("head")
    return out.select("id", F.concat("head", "datum", "tail").alias("text"), start.alias("start"), (start + F.length("datum")).alias("stop"), "kind")


def examples(texts: DataFrame) -> DataFrame:
    """(id, x, y): the candidates of planted texts; y is 1 if a candidate has the datum's kind, covers it and is at most three characters longer."""
    found = found_spans(texts, F.struct("id", "start", "stop", "kind"))
    each, k = found.select("key", F.explode("proposed").alias("x")), F.col("key")
    x = F.col("x")
    hit = (x["kind"] == k["kind"]) & (x["start"] <= k["start"]) & (x["stop"] >= k["stop"]) & (x["stop"] - x["start"] <= k["stop"] - k["start"] + 3)
    return each.select(k["id"].alias("id"), "x", hit.cast("int").alias("y"))


def fit(spark: SparkSession, precision: float = 0.95, rows: int = 12_000, seed: int = 1) -> Boosted:
    """The model: a third of the planted texts calibrates it. `rows` bounds the texts, the bins what reaches the driver."""
    texts = cut(planted(spark, rows, seed), "planted")  # else the texts would be made again for each pattern
    each = examples(texts).select((F.floor(F.col("id") / len(FORMS)) % 3 == 0).alias("held"), *[F.col("x")[f].alias(f) for f in FEATURES], "y")
    counted = each.groupBy("held", *FEATURES).agg(F.sum("y").alias("pos"), F.count("*").alias("n")).collect()
    drop_cut(texts)
    assert len(counted) <= 2 * math.prod(BINS), "more feature vectors than bins allow"
    sides: list[Counts] = [sorted((tuple(int(r[f]) for f in FEATURES), int(r["pos"]), int(r["n"])) for r in counted if r["held"] == side) for side in (False, True)]
    return boost(*sides, precision=precision)


#: Models by (precision, rows, seed): planted texts depend on nothing else, so a new fit would give the same.
FITTED: dict[tuple, Boosted] = {}


def fitted(spark: SparkSession, precision: float = 0.95, rows: int = 12_000, seed: int = 1) -> Boosted:
    """The model of these parameters, fitted once."""
    which = (precision, rows, seed)
    if which not in FITTED:
        FITTED[which] = fit(spark, precision, rows, seed)
    return FITTED[which]


def personal_data(docs: DataFrame, model: Boosted | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (start, stop, kind) in code points, sorted by start, then kind, then stop; spans are
    the base spans and those that the model (fitted here, if none is given) adds. One pass over the rows, no exchange.

    Null and empty texts have no spans; very long ones are searched whole. Repeated rows are searched each; equal spans of a
    text count once. Null keys stay. An empty table gives no rows. Other columns, of any names, take no part.
    """
    found = found_spans(docs, F.col(key), text)
    return _selected(found, model or fitted(docs.sparkSession)).withColumnRenamed("key", key)


def _selected(found: DataFrame, model: Boosted) -> DataFrame:
    """(key, base, spans) of found spans: base spans, and with them the proposed ones that the model accepts."""
    plain = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop"))
    base = F.array_sort(F.transform("base", plain))
    if model.threshold > 1:
        added = F.filter(F.transform("proposed", plain), lambda x: F.lit(False))
    else:
        added = F.transform(F.filter("proposed", lambda x: model.probability([x[f] for f in FEATURES]) >= model.threshold), plain)
    return found.select("key", base.alias("base"), F.array_sort(F.array_distinct(F.concat(base, added))).alias("spans"))


def redacted(docs: DataFrame, model: Boosted | None = None, text: str = "text") -> DataFrame:
    """docs with all their columns, of any names, and each personal datum of the text replaced by its kind in brackets;
    n_chars, where there is one, is the new length of changed texts. Null and empty texts stay; very long ones are searched whole; repeated rows change alike;
    an empty table gives none; overlapping spans are replaced as one. One pass over the rows, no exchange."""
    rows = _selected(found_spans(docs, F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]), text), model or fitted(docs.sparkSession))
    new = redact(F.col(f"key.`{text}`"), F.col("spans"))
    out = {c: F.col("key")[c] for c in docs.columns} | {text: new}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.size("spans") > 0, F.length(new).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("key.n_chars"))
    return rows.select(*[c.alias(n) for n, c in out.items()])


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def merged(spans: Column) -> Column:
    """Spans sorted by start, overlapping ones joined under the kind of the first."""

    empty = F.array().cast("array<struct<start:int,kind:int,stop:int>>")

    def join(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        return F.when(last["stop"] > x["start"], F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(spans, empty, join)


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        piece = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(x["stop"].alias("at"), F.concat(acc["out"], piece, F.element_at(names, x["kind"] + 1)).alias("out"))

    return F.when(F.size(spans) > 0, F.aggregate(merged(spans), start, add, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))).otherwise(text)
