"""Queries over whole tables, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embeddings, language, line_runs, mixing, partenum, quality, tokens, url_rules, warc
from .store import Workspace

#: The vocabulary's file; a parameter of the operator, never copied here.
VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(spark, table(spark, sf_dir, "documents"), vocabulary())


#: Fixed values of the query: verdict and rule.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_rules.rule(*r) for r in URL_RULES]
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents")).drop("copies")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("binary").alias("payload"))
    path = Workspace(spark, "warc").folder("archives")
    warc.write_warc(spark, pages, path)
    return warc.read_warc(spark, path, payloads=False).drop("url", "payload")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_classes(spark, table(spark, sf_dir, "documents"), k=4, percent=85, links=False).select("doc_id", "n_shingles", "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(spark, table(spark, sf_dir, "documents"), texts=False)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(spark, docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(spark, docs).select("doc_id", "held_out", "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_binary": op1_token_binary,
    "op2_url_filter": op2_url_filter,
    "op3_source_mix": op3_source_mix,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_warc": op5_warc,
    "op6_jaccard": op6_jaccard,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality": op9_quality,
    "op10_language": op10_language,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": """
        WITH parts AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), cut AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
        ), rules(verdict, rhost, rpath) AS (
            VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ), fits AS (
            SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
            FROM cut JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath) GROUP BY page_id
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM cut LEFT JOIN fits USING (page_id)
    """,
    "op3_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
            FROM documents
        ), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
        o AS (
            SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - 2::DOUBLE * coalesce(sum(source_size) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
                sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS of_
            FROM w WINDOW r AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)
        ), c AS (SELECT *, weight * left_ >= 2::DOUBLE * source_size * of_ AS capped FROM o),
        l AS (SELECT left_ AS l, of_ AS o FROM c WHERE NOT capped ORDER BY source_size::DOUBLE / weight, source NULLS LAST LIMIT 1),
        t AS (SELECT source, source_size, CASE WHEN capped THEN 2::DOUBLE * source_size ELSE weight * l / o END AS target FROM c LEFT JOIN l ON true),
        f AS (
            SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size), 2) END::BIGINT AS whole,
                CASE WHEN source_size = 0 OR floor(target / source_size) >= 2 THEN 0 ELSE target - floor(target / source_size) * source_size END AS rest FROM t
        ), q AS (
            SELECT doc_id, size, d.source, source_size, target, whole, rest, u, CASE WHEN rest > 0 THEN rest / source_size ELSE 0 END AS f FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
        ), g AS (
            SELECT *, f > 0 AND 2 * coalesce(sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / (CASE WHEN f > 0 THEN f END / (1 - f)), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size <= 2 * rest AS hit FROM q
        ), p AS (SELECT *, rest - sum(CASE WHEN hit THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM g),
        k AS (
            SELECT *, CASE WHEN f > 0 AND abs(gap) > abs(abs(gap) - size) AND hit = (gap < 0) THEN abs(abs(gap) - size) END AS off FROM p
        ), n AS (SELECT *, off IS NOT NULL AND row_number() OVER (PARTITION BY source ORDER BY off NULLS LAST, u, doc_id, size) = 1 AS swap FROM k)
        SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN size * (whole + (hit <> swap)::BIGINT) ELSE 0 END AS taken FROM n
    """,
    "op4_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
        ), link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM comp
    """,
    "op5_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        h AS (SELECT page_id, octet_length(payload) AS n, unhex(sha1(payload)) AS d FROM p),
        m AS (SELECT page_id, n, d, min(page_id) OVER (PARTITION BY d, n) AS f FROM h)
        SELECT page_id, n::BIGINT AS payload_bytes, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(b, 5 * i + 1, 5))::INT, 1), '' ORDER BY i) FROM (SELECT d::BIT::VARCHAR AS b), range(32) t(i)) AS payload_digest,
            CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
        FROM m
    """,
    "op7_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, p, line, lower_az AS key, length(lower_az) >= 20 AS counted
            FROM (SELECT doc_id, p, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
                FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents))
        ), c AS (SELECT key, max(doc_id) AS last FROM l WHERE counted GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT l.*, counted AND c.key IS NOT NULL AND doc_id <> last AS gone FROM l LEFT JOIN c USING (key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op8_decontaminate": r"""
        WITH w AS (
            SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
            UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark
        ), s AS (SELECT DISTINCT side, id, array_to_string(w[p:p+4], ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS p) WHERE len(w) >= 5),
        n AS (SELECT id, count(*) AS n FROM s WHERE side = 'b' GROUP BY id)
        SELECT d.id AS doc_id, b.id AS item_id, any_value(n)::BIGINT AS n_shingles, count(*)::DOUBLE / any_value(n) AS containment
        FROM s d JOIN s b ON d.g = b.g AND d.side = 'd' AND b.side = 'b' JOIN n ON n.id = b.id
        GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(n)
    """,
}
