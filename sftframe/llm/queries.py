"""One registered query per operator: production parameters over the whole tables, and SQL where it can say the same."""

from __future__ import annotations

from sftframe.llm import align, decontam, dedup, jaccard, langid, lmscore, pieces, pii, quality, sketch, trie, vptree, warc
from sftframe.llm.textcore import table

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def op1_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.digest(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(spark, table(spark, sf_dir, "pages"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op4_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.digest(table(spark, sf_dir, "documents"))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digest(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10, factor=1.0)


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.digest(table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.digest(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_dedup": op1_dedup,
    "op2_warc": op2_warc,
    "op3_pieces": op3_pieces,
    "op4_lmscore": op4_lmscore,
    "op5_decontam": op5_decontam,
    "op6_pii": op6_pii,
    "op7_jaccard": op7_jaccard,
    "op8_quality": op8_quality,
    "op9_language": op9_language,
    "op10_nearest": op10_nearest,
    "op11_trie": op11_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_alignment": op13_alignment,
}

ORACLE = {
    "op2_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), responses AS (
            SELECT payload_digest, max(page_id) AS response FROM payloads WHERE payload_bytes >= 1000
            GROUP BY payload_digest HAVING count(*) > 1
        ), named AS (
            SELECT p.*, CASE WHEN p.page_id IS DISTINCT FROM r.response THEN r.response END AS refers_to
            FROM payloads p LEFT JOIN responses r ON p.payload_digest = r.payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
        FROM named
    """,
    "op10_nearest": """
        WITH vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
                list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 10
    """,
    # The CRC-32 of an id is worked out bit by bit; a prefix is named by the hashes of all its turns; sums over
    # subtrees run along each node's smallest member, from its end.
    "op11_trie": """
        WITH turns AS (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p,
                   coalesce(role, '') AS r, coalesce(text, '') AS t
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT c, count(*) AS n, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda crc, b: list_reduce(
                    list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda v, zero: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::BIGINT) % 6 AS h
            FROM turns GROUP BY c
        ), convs AS (
            SELECT o.c, o.c - o.c % 100 AS base, o.h, least(o.h, coalesce(b.n, 0)) AS taken,
                   least(o.h, coalesce(b.n, 0)) + greatest(o.n - o.h, 0) AS total
            FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 100
        ), rebuilt AS (
            SELECT v.c, t.p AS q, t.r, t.t FROM convs v JOIN turns t ON t.c = v.base AND t.p < v.taken
            UNION ALL SELECT v.c, v.taken + t.p - v.h, t.r, t.t FROM convs v JOIN turns t ON t.c = v.c AND t.p >= v.h
        ), prefixes AS (
            SELECT c, 0 AS d, 'root' AS k, 0 AS size FROM convs
            UNION ALL SELECT c, q + 1, md5(string_agg(md5(r || chr(1) || t), '') OVER (PARTITION BY c ORDER BY q)), length(t) FROM rebuilt
        ), nodes AS (
            SELECT k, d, min(c) AS conv, count(*) AS n, max(size) AS size FROM prefixes GROUP BY k, d
        ), parents AS (
            SELECT n.*, p.k AS up FROM nodes n LEFT JOIN prefixes p ON p.c = n.conv AND p.d = n.d - 1
        ), kids AS (
            SELECT up, count(*) AS kids FROM parents WHERE up IS NOT NULL GROUP BY up
        ), counted AS (
            SELECT n.*, coalesce(kids, 0) AS kids FROM parents n LEFT JOIN kids ON kids.up = n.k
        ), along AS (
            SELECT p.c, p.k, sum(CASE WHEN n.k IS NOT NULL AND n.kids = 0 THEN 1 ELSE 0 END) OVER w AS leaves,
                   sum(CASE WHEN n.k IS NOT NULL THEN (n.n - 1) * n.size ELSE 0 END) OVER w AS saved
            FROM prefixes p LEFT JOIN counted n ON n.k = p.k AND n.conv = p.c WINDOW w AS (PARTITION BY p.c ORDER BY p.d DESC)
        ), sums AS (
            SELECT k, sum(leaves) AS leaves, sum(saved) AS saved FROM along GROUP BY k
        ), ended AS (
            SELECT p.k, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) AS ids FROM prefixes p JOIN convs v ON v.c = p.c AND v.total = p.d GROUP BY p.k
        )
        SELECT n.conv AS conv_id, n.d::BIGINT AS depth, up.conv AS parent_conv_id, n.n AS n_convs, n.kids AS n_children,
               s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM counted n JOIN sums s ON s.k = n.k LEFT JOIN nodes up ON up.k = n.up LEFT JOIN ended e ON e.k = n.k
    """,
}
