"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm import ann, centroids, decontamination, licences, mixing, packing, pii, quality, sharding, simhash, substrings, toxicity, whitening
from genoweave.llm.common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_size_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arrive in 20 runs of three sizes (a half, a quarter, and 16 + 2 small ones by a hash of doc_id); one
    compaction merges the full tiers. A row of the last manifest's files for each document, with its text's digest."""
    docs = table(spark, sf_dir, "documents")
    store = sharding.Store(spark, new_path(spark, "store"), target=64 << 20, fanout=4)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    bucket = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(64))
    store.append(docs, F.when(bucket < 32, 0).when(bucket < 48, 1).otherwise(bucket - 46), size)
    store.compact(size)
    return store.read().select("doc_id", "lang", "source", "n_chars", size.alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))


def op2_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10, relax=1.0)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), size=3, radius=2, parts=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), window=13, seed=7).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), where=rest != 2)
    return toxicity.score(docs, model).select("doc_id", (rest == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "worst_start", "worst_stop")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), capacity=4096, end=1)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.matches(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    count = {k: F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)}
    return found.select("doc_id", *count.values(), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op11_systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.sampled(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0, seed=11, carry=["doc_id"])
    return drawn.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op12_kd_filtering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(*centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256.0, seed=2))


def op13_range_finder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=8, scale=1024.0, shift=100_000)


def _of_kind(i: int):
    return lambda x: x["kind"] == i


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_size_tiered": op1_size_tiered,
    "op2_vantage_point": op2_vantage_point,
    "op3_simhash": op3_simhash,
    "op4_debruijn": op4_debruijn,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_decontamination": op8_decontamination,
    "op9_licences": op9_licences,
    "op10_personal_data": op10_personal_data,
    "op11_systematic": op11_systematic,
    "op12_kd_filtering": op12_kd_filtering,
    "op13_range_finder": op13_range_finder,
}


def _rounds(n: int) -> str:
    """Rounds of assignment and update: m<i> has each vector's nearest centroid, c<i + 1> the centroids after it."""
    assign = """m{0} AS MATERIALIZED (SELECT id, xs, x.c AS cluster, x.d AS distance FROM (
        SELECT v.id, v.no, any_value(v.xs) AS xs, min(struct_pack(d := list_sum(list_transform(range(1, 65), lambda i: (v.xs[i] - c.xs[i]) * (v.xs[i] - c.xs[i])))::BIGINT, c := c.c)) AS x FROM vecs v CROSS JOIN c{0} c GROUP BY v.id, v.no))"""
    update = """c{1} AS MATERIALIZED (SELECT c.c, coalesce(u.xs, c.xs) AS xs FROM c{0} c LEFT JOIN (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS xs FROM (
        SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(xs) AS x, unnest(range(64)) AS i FROM m{0}) GROUP BY cluster, i) GROUP BY cluster) u ON u.cluster = c.c)"""
    return ", ".join(f"{assign.format(i)}, {update.format(i, i + 1)}" for i in range(n)) + f", {assign.format(n)}"

ORACLE: dict[str, str] = {
    "op1_size_tiered": """
        SELECT doc_id, lang, source, n_chars, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes, sha256(text) AS text_sha256
        FROM documents""",
    "op2_vantage_point": """
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM (
                SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                    sqrt(list_reduce(list_transform(range(1, len(q.embedding) + 1), lambda i: (CAST(q.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE)) * (CAST(q.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE))), lambda a, b: a + b)) AS score
                FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id
                WHERE q.vec_id % 100 = 0))
        WHERE rank <= 10""",
    "op4_debruijn": """
        WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        win AS (SELECT doc_id, p, array_to_string(ws[p : p + 12], ' ') AS t FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS p FROM w)),
        flag AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY t) AS lo FROM win) WHERE doc_id > lo),
        gone AS (SELECT DISTINCT doc_id, p + i AS p FROM flag, range(0, 13) r(i)),
        words AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
        kept AS (SELECT k.doc_id, string_agg(x, ' ' ORDER BY k.p) AS s, count(*) AS n FROM words k ANTI JOIN gone g ON k.doc_id = g.doc_id AND k.p = g.p GROUP BY k.doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op11_systematic": """
        WITH d AS (SELECT doc_id, source, source IS NULL AS gone, coalesce(source, '') AS src, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
        t AS (SELECT gone, src, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY gone, encode(src)) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM d GROUP BY gone, src),
        o AS (SELECT *, coalesce(sum(2.0::DOUBLE * source_size) OVER p, 0) AS held, sum(w) OVER (ORDER BY source_size / w DESC, gone DESC, src DESC) AS w_open, 1.5::DOUBLE * sum(source_size) OVER () AS wanted
            FROM t WINDOW p AS (ORDER BY source_size / w, gone, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT max((wanted - held) / w_open) AS level FROM o WHERE (wanted - held) / w_open < 2.0::DOUBLE * source_size / w),
        g AS (SELECT gone, src, source_size, CASE WHEN level IS NULL OR 2.0::DOUBLE * source_size <= level * w THEN 2.0::DOUBLE * source_size ELSE level * w END AS target, CAST('0x' || substring(sha256('11:' || CAST(gone AS VARCHAR) || ':' || src), 1, 6) AS BIGINT) AS off FROM t, l),
        r AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.off, CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size * 16777216 + 0.5) AS BIGINT) ELSE 0 END AS each,
            row_number() OVER (PARTITION BY d.gone, d.src ORDER BY d.size, substring(sha256('11:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16), doc_id NULLS FIRST) - 1 AS k FROM d JOIN g ON g.gone = d.gone AND g.src = d.src)
        SELECT doc_id, size, source_size, target, CAST(size * (((k + 1) * each + off) // 16777216 - (k * each + off) // 16777216) AS BIGINT) AS taken FROM r""",
    "op12_kd_filtering": f"""
        WITH vecs AS MATERIALIZED (SELECT vec_id AS id, row_number() OVER () AS no, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS xs FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, xs) - 1 AS INTEGER) AS c, xs FROM (SELECT sha256('2:' || CAST(id AS VARCHAR)) AS h, xs FROM vecs WHERE id IS NOT NULL ORDER BY h, xs LIMIT 40)),
        {_rounds(5)}, s AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM m5 GROUP BY cluster)
        SELECT m.id AS vec_id, m.cluster, m.distance, s.cluster_inertia, (SELECT sum(cluster_inertia)::BIGINT FROM s) AS inertia, sha256(array_to_string(c.xs, ',')) AS centroid_sha256 FROM m5 m JOIN s ON s.cluster = m.cluster JOIN c5 c ON c.c = m.cluster""",
}
