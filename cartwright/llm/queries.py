"""The registered queries of the operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    fingerprint,
    htmltext,
    jaccard,
    langid,
    merkle,
    mixing,
    packing,
    repair,
    repeats,
    simhash,
    topk,
    urlrules,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("id") % 20 == 0, k=20)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs, keep="none").select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.col("_kept_sha256").alias("kept_sha256"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(spark, folder, payloads=False)
    return warc.resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.joined(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.learned_from(docs))
    return found.select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "_lang.lang_pred", "_lang.score"
    )


#: Fixed by the query's contract.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages"), rules)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.mix(docs)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"), merkle.tampered_text())


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_top_k": op1_top_k,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_warc": op3_warc,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_language_id": op5_language_id,
    "op6_url_filters": op6_url_filters,
    "op7_html_text": op7_html_text,
    "op8_mixing": op8_mixing,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash": op13_simhash,
}

ORACLE: dict[str, str] = {
    "op1_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20
    """,
    "op3_warc": """
        WITH sized AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), last AS (
            SELECT payload_digest, max(page_id) AS original FROM sized
            WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original <> page_id THEN original END AS refers_to
        FROM sized LEFT JOIN last USING (payload_digest)
    """,
    "op6_url_filters": r"""
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://')
                        THEN regexp_extract(substr(url, strpos(url, '://') + 3), '(?s)^[^/?#]*') ELSE '' END AS raw_host,
                   CASE WHEN contains(url, '://')
                        THEN regexp_extract(substr(url, strpos(url, '://') + 3), '(?s)^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM pages
        ), hosts AS (
            SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
            FROM parts
        ), rules(h, p, v) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        )
        SELECT page_id, host, path,
               (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
                ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1) AS rule,
               coalesce((SELECT v FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
                ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1), 'allow') AS verdict
        FROM hosts
    """,
    "op8_mixing": """
        WITH RECURSIVE counted AS (
            SELECT source, count(*) AS n FROM documents GROUP BY source
        ), rates AS (
            SELECT source, round(pow(n, 0.5) / (SELECT sum(pow(n, 0.5)) FROM counted)
                                 * (SELECT sum(n) FROM counted) * 1.0 / n, 9)::DOUBLE AS rate
            FROM counted
        ), cdf AS (
            SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS total FROM rates
            UNION ALL
            SELECT source, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1)
            FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate)) + 20
        ), drawn AS (
            SELECT d.*, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '~')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
            FROM documents d
        ), times AS (
            SELECT drawn.doc_id, drawn.text, drawn.lang, drawn.source, drawn.n_chars, count(*) AS n
            FROM drawn JOIN cdf ON cdf.source IS NOT DISTINCT FROM drawn.source AND cdf.total <= drawn.u
            GROUP BY ALL
        )
        SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INTEGER AS copy FROM times
    """,
    "op12_merkle_manifest": r"""
        WITH RECURSIVE hashed AS (
            SELECT doc_id, source,
                   concat(coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'),
                          coalesce(octet_length(encode(source)) || ':' || source, '-'),
                          coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                          coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-')) AS head,
                   text, replace(text, chr(10), '') AS bare
            FROM documents
        ), doubled AS (
            SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(octet_length(encode(bare)) || ':' || bare, '-')) AS cut
            FROM hashed
        ), bits AS (  -- crc32 of the decimal id, bit by bit
            SELECT doc_id AS id, doc_id::VARCHAR AS t, 1 AS spot, 8 AS left_bits,
                   xor(4294967295, ascii(substr(doc_id::VARCHAR, 1, 1)))::BIGINT AS crc
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
            UNION ALL
            SELECT id, t, CASE WHEN left_bits = 0 THEN spot + 1 ELSE spot END, CASE WHEN left_bits = 0 THEN 8 ELSE left_bits - 1 END,
                   CASE WHEN left_bits = 0 THEN xor(crc, ascii(substr(t, spot + 1, 1))::BIGINT)
                        WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END
            FROM bits WHERE left_bits > 0 OR spot < length(t)
        ), crcs AS (
            SELECT id, xor(crc, 4294967295) AS crc FROM bits WHERE left_bits = 0 AND spot = length(t)
        ), leaves AS (
            SELECT doc_id, leaf, CASE WHEN crc % 2 = 0 THEN cut ELSE leaf END AS met,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS owner,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                   count(*) OVER (PARTITION BY source) AS n
            FROM doubled LEFT JOIN crcs ON doc_id = id
        ), nodes AS (
            SELECT owner, 0 AS level, rank, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT owner, level + 1, rank // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY rank))
            FROM nodes WHERE n > 1 GROUP BY owner, level, rank // 3
        ), upper AS (
            SELECT 0 AS level, owner AS rank, (SELECT count(DISTINCT owner) FROM leaves) AS n, digest FROM nodes WHERE n = 1
            UNION ALL
            SELECT level + 1, rank // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY rank))
            FROM upper WHERE n > 1 GROUP BY level, rank // 3
        ), every AS (
            SELECT * FROM nodes UNION ALL SELECT -1, * FROM upper
        ), steps AS (
            SELECT a.owner, a.level, a.rank,
                   coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS l,
                   coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS r
            FROM every a JOIN every b ON a.owner = b.owner AND a.level = b.level AND a.rank // 3 = b.rank // 3
            WHERE a.n > 1 GROUP BY a.owner, a.level, a.rank
        ), walk AS (
            SELECT owner AS o, rank AS r0, owner, 0 AS level, rank, n, '' AS proof, met AS spot FROM leaves
            UNION ALL
            SELECT o, r0, CASE WHEN w.n = 1 THEN -1 ELSE w.owner END, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
                   CASE WHEN w.n = 1 THEN w.owner ELSE w.rank // 3 END,
                   CASE WHEN w.n = 1 THEN (SELECT max(n) FROM upper) ELSE (w.n + 2) // 3 END,
                   CASE WHEN w.n = 1 THEN w.proof ELSE w.proof || s.l || s.r END,
                   CASE WHEN w.n = 1 THEN w.spot ELSE sha256(s.l || w.spot || s.r) END
            FROM walk w LEFT JOIN steps s ON w.n > 1 AND w.owner = s.owner AND w.level = s.level AND w.rank = s.rank
            WHERE w.n > 1 OR w.owner >= 0
        ), root AS (SELECT digest AS root FROM upper WHERE n = 1)
        SELECT doc_id, leaf, t.digest AS subroot, root, sha256(proof) AS proof_sha256, w.spot AS folded_root, w.spot = root AS verified
        FROM leaves JOIN walk w ON leaves.owner = w.o AND leaves.rank = w.r0 AND w.owner = -1 AND w.n = 1
        JOIN (SELECT owner, digest FROM nodes WHERE n = 1) t ON leaves.owner = t.owner
        CROSS JOIN root
    """,
}
