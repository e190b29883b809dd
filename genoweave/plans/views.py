"""Views that turn the driver's tables into intervals, alignments, nets and variants, in SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

#: {div}, {epoch} and {hash} differ between the engines.
SPARK = {"div": "div", "epoch": "unix_timestamp(ts)"}
DUCK = {"div": "//", "epoch": "CAST(floor(epoch(ts)) AS BIGINT)"}

VIEWS = {
    # intervals: a row hash is the id, so that no global order is needed to number them
    "v_iv": """
        SELECT md5(concat_ws('|', CAST(l_orderkey AS string), CAST(l_linenumber AS string), CAST(l_partkey AS string), CAST(l_suppkey AS string),
                   CAST(CAST(l_quantity AS bigint) AS string), CAST(CAST(round(l_extendedprice * 100) AS bigint) AS string), CAST(CAST(l_shipdate AS date) AS string))) AS id,
            concat('c', CAST(l_suppkey % 8 AS string)) AS contig,
            l_partkey * 50 + l_linenumber * 7 + l_orderkey % 97 AS st,
            l_partkey * 50 + l_linenumber * 7 + l_orderkey % 97 + CAST(l_quantity AS bigint) * 4 AS en,
            CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END AS strand,
            concat('S', CAST(l_orderkey % 6 AS string)) AS sample,
            l_orderkey AS okey, l_partkey AS pkey, l_linenumber AS line, CAST(l_quantity AS bigint) AS qty
        FROM lineitem""",
    # the same rows far apart, so that islands and gaps are many
    "v_sp": """
        SELECT md5(concat_ws('|', CAST(l_orderkey AS string), CAST(l_linenumber AS string), CAST(l_partkey AS string), CAST(l_suppkey AS string),
                   CAST(CAST(l_quantity AS bigint) AS string), CAST(CAST(round(l_extendedprice * 100) AS bigint) AS string), CAST(CAST(l_shipdate AS date) AS string))) AS id,
            concat('c', CAST(l_suppkey % 8 AS string)) AS contig, l_partkey * 500 + l_linenumber * 70 + l_orderkey % 97 AS st,
            l_partkey * 500 + l_linenumber * 70 + l_orderkey % 97 + CAST(l_quantity AS bigint) AS en, CAST(l_quantity AS bigint) AS qty
        FROM lineitem""",
    "v_feat": """
        SELECT o_orderkey AS id, concat('c', CAST(o_custkey % 8 AS string)) AS contig, (o_orderkey * 37) % (SELECT 50 * count(*) FROM part) AS st,
            (o_orderkey * 37) % (SELECT 50 * count(*) FROM part) + 200 AS en
        FROM orders""",
    "v_seq": """
        SELECT p_partkey AS contig, translate(md5(CAST(p_partkey AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM part""",
    # blocks of two rows: the second has gaps and mismatches where the digest's letters map to different ones
    "v_blk": """
        SELECT p_partkey AS block, concat('c', CAST(p_partkey % 8 AS string)) AS contig, p_partkey * 40 AS t_start, concat('S', CAST(p_size % 6 AS string)) AS sample,
            concat('q', CAST(p_partkey % 3 AS string)) AS q_contig, p_partkey * 41 AS q_start, CASE WHEN p_size % 4 = 0 THEN '-' ELSE '+' END AS q_strand, CAST(100000000 AS bigint) AS q_size,
            translate(md5(CAST(p_partkey AS string)), '0123456789abcdef', 'ACGTACGTACGTACG-') AS t_text,
            translate(md5(CAST(p_partkey AS string)), '0123456789abcdef', 'ACGTACGTACGTAT-G') AS q_text
        FROM part""",
    # alignments of six samples with one reference, each over every tile of 32 letters: blocks of a sample overlap its next ones (the texts
    # of the reference agree there), some lie inside others, and those of different samples begin and end at different places
    "v_multi": """
        SELECT block, contig, sample, q_contig, q_strand, q_size, t_start, q_start, concat(substring(r, 1, a), repeat('-', ins), substring(r, a + 1, n - a)) AS t_text,
            concat(replace(substring(r, 1, a), 'GA', 'GC'), substring('TGCA', 1, ins), replace(substring(r, a + 1, b - a), 'CT', 'AT'), repeat('-', gone), substring(r, b + gone + 1, n - b - gone)) AS q_text
        FROM (SELECT k * 6 + j AS block, concat('c', CAST(k % 8 AS string)) AS contig, concat('S', CAST(j AS string)) AS sample, concat('q', CAST(k % 8 AS string)) AS q_contig,
            CASE WHEN (t + j) % 7 = 0 THEN '-' ELSE '+' END AS q_strand, CAST(100000000 AS bigint) AS q_size, t * 32 + ofs AS t_start, t * 33 + ofs + j AS q_start, n, a, ins, gone, b,
            substring(concat(translate(md5(concat('r', CAST(k % 8 AS string), ':', CAST(t AS string))), '0123456789abcdef', 'ACGTACGTACGTACGT'), translate(md5(concat('r', CAST(k % 8 AS string), ':', CAST(t + 1 AS string))), '0123456789abcdef', 'ACGTACGTACGTACGT'),
                translate(md5(concat('r', CAST(k % 8 AS string), ':', CAST(t + 2 AS string))), '0123456789abcdef', 'ACGTACGTACGTACGT')), CAST(ofs + 1 AS int), n) AS r
            FROM (SELECT k, t, j, (t * 5 + j * 11) % 24 AS ofs, CAST(CASE WHEN (t + j) % 5 = 0 THEN 14 ELSE 30 + (t * 3 + j) % 18 END AS int) AS n, CAST(4 + (t + j * 2) % 5 AS int) AS a, CAST((t + j) % 4 AS int) AS ins,
                CAST((t + j * 3) % 3 AS int) AS gone, CAST(10 + (t + j) % 2 AS int) AS b
                FROM (SELECT p_partkey AS k, p_partkey {div} 8 AS t, j FROM part CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) AS six(j)) x) y) z""",
    "v_top": """
        SELECT CAST(n_nationkey AS bigint) AS fill, CAST(n_regionkey AS bigint) AS net, CAST(n_nationkey * 100000 AS bigint) AS t_start,
            CAST(((n_nationkey * 37 + 13) * 30000) % 1500000 AS bigint) AS t_size,
            CAST(((n_nationkey * 37 + 13) * 30000) % 1500000 * (n_nationkey % 10 + 1) AS bigint) {div} 20 AS ali
        FROM nation""",
    "v_gap": """
        SELECT c_custkey AS gap, CAST(c_nationkey AS bigint) AS fill, c_custkey * 50000 AS t_start, 1 + (c_custkey * 7919) % 40000 AS t_len,
            CASE WHEN c_custkey % 3 = 0 THEN (c_custkey * 104729) % 20000 ELSE c_custkey % 50 END AS q_len
        FROM customer""",
    "v_child": """
        SELECT o_orderkey AS child, (o_custkey {div} 2) * 2 AS gap, o_orderkey * 1000 AS t_start, 1 + (o_orderkey * 31) % 30000 AS t_len, (o_orderkey * 17) % 20000 AS ali,
            (o_orderkey * 13) % 100000 AS q_far, (o_orderkey * 11) % 20000 AS q_over, (o_orderkey * 29) % 1000000 AS q_start, (o_orderkey * 23) % 30000 AS q_len,
            concat('q', CAST(o_orderkey % 7 AS string)) AS q_name,
            CASE WHEN o_orderkey % 5 = 0 THEN 'syn' WHEN o_orderkey % 5 = 1 THEN 'inv' ELSE 'nonSyn' END AS kind
        FROM orders""",
    "v_pt": "SELECT event_id AS id, event_type AS contig, {epoch} AS pos, user_id FROM events",
    # small indels inside the blocks
    "v_indel": """
        SELECT DISTINCT concat('c', CAST(l_partkey % 8 AS string)) AS contig, l_partkey * 40 + l_linenumber * 3 + 2 AS beg,
            l_partkey * 40 + l_linenumber * 3 + 2 + (CASE WHEN l_orderkey % 2 = 0 THEN 1 + l_orderkey % 3 ELSE 0 END) AS fin, 1 + l_orderkey % 3 AS len,
            CASE WHEN l_orderkey % 2 = 0 THEN 'DEL' ELSE 'INS' END AS kind
        FROM lineitem""",
}


def register(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The views named, over the tables of a folder; tables are registered under their own names while they are built."""
    for t in TABLES:
        if any(t in VIEWS[n] for n in names):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    out = {}
    for n in names:
        out[n] = spark.sql(VIEWS[n].format(**SPARK))
        out[n].createOrReplaceTempView(n)
    return out


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL that defines the views before a statement, which may begin with more common tables."""
    head = ", ".join(f"{n} AS ({VIEWS[n].format(**DUCK)})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {body[15:]}"
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"
