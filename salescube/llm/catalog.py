"""Registered queries of the training-data operators, and their DuckDB SQL.

Operators without SQL here can't be said in it (trained models, calibrated
searches, token vocabularies, formatted windows); their tests compare them with
brute force, exact round trips or held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.llm import (ann, bpe, chat_format, embedding_dedup, filter_audit, hard_negatives, language_id,
                           line_dedup, minhash_dedup, mixing, substring_dedup, url_filter, warc)
from salescube.llm.common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup_embeddings(table(spark, sf_dir, "embeddings"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.production_rules(spark))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.conversation_digest(chat_format.with_forged(table(spark, sf_dir, "conversations")))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digest(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_predictions(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", shifted))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_embedding_near_dedup, op2_minhash_near_dedup, op3_url_filter, op4_chat_format, op5_mix_sources,
        op6_nearest_neighbours, op7_bpe, op8_warc, op9_line_dedup, op10_language_id, op11_hard_negatives,
        op12_filter_audit, op13_substring_dedup)
}

# Components of a few links: every node's least reachable node.
_COMPONENTS = """
, reach(node, low) AS (
    SELECT node, node FROM nodes
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.low
), component AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
"""

_OP1 = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), links AS MATERIALIZED (
    SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
    WHERE list_cosine_similarity(p.x, q.x) >= 0.95
), nodes AS (SELECT DISTINCT a AS node FROM links)
""" + _COMPONENTS + """
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN component c ON c.node = e.vec_id
"""

_OP2 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) END) AS g FROM w
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT c.a, c.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS both FROM s p JOIN s q USING (g)
                          WHERE p.doc_id <> q.doc_id GROUP BY 1, 2) c
    JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
    WHERE 100 * c.both >= 85 * (x.n + y.n - c.both)
), nodes AS (SELECT DISTINCT a AS node FROM links)
""" + _COMPONENTS + """
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN component c ON c.node = d.doc_id
"""

_OP3 = r"""
WITH r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), u AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), p AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), m AS (
    SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
           arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (page_id)
"""

_OP5 = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           md5('7-' || CAST(doc_id AS VARCHAR)) AS key FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
           CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
    FROM d GROUP BY source
), l AS (
    SELECT *, ((SELECT 1.5 * sum(source_size) FROM s)
               - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)
), f AS (SELECT arg_min(level, source_size / weight) AS level FROM l WHERE level * weight <= 2 * source_size
), t AS (SELECT source, source_size, least(2 * source_size, coalesce(f.level * weight, 2 * source_size)) AS target
         FROM s, f
), p AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d
)
SELECT p.doc_id, CAST(p.size AS BIGINT) AS size, CAST(t.source_size AS BIGINT) AS source_size, t.target, p.source,
       CAST(CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) * p.size
            + greatest(0, least(p.size, floor(t.target) - floor(floor(t.target) / t.source_size) * t.source_size
                                        - p.before)) ELSE 0 END AS BIGINT) AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""

_OP8 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS h FROM pages
), q AS (SELECT page_id, octet_length(h) AS payload_bytes, sha256(h) AS payload_digest FROM p
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM f
"""

_OP9 = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr FROM documents
), k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), heavy AS (
    SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (SELECT k.*, heavy.last IS NOT NULL AND heavy.last <> k.doc_id AS gone FROM k LEFT JOIN heavy USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_OP11 = """
WITH r AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), p AS (
    SELECT * FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
       n.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 3
"""

_OP12 = r"""
WITH w AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
    SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
                          100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
                          regexp_matches(t, '[#$%&*|]'),
                          coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
    FROM w
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), c AS (
    SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
    SELECT filter_order, CAST(i AS INT) AS step, filter_order[i] AS own,
           list_transform(range(1, i), lambda k: ascii(filter_order[k]) - 64) AS before
    FROM o, range(1, 6) t(i)
), m AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails[ascii(own) - 64] AS fail,
           len(list_filter(before, lambda b: fails[b])) > 0 AS gone, len(list_filter(fails, lambda b: b)) = 1 AS alone
    FROM c, s
), g AS (
    SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0) AS kept,
           coalesce(sum(n) FILTER (fail AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fail AND gone), 0) AS redundant,
           coalesce(sum(n) FILTER (fail AND alone), 0) AS unique_fails,
           coalesce(sum(good) FILTER (fail AND NOT gone), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (fail AND NOT gone), 0) AS toxic_lost
    FROM m GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""

_OP13 = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS MATERIALIZED (
    SELECT doc_id, unnest(range(1, len(w) - 48)) AS p,
           unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS k
    FROM w WHERE len(w) >= 50
), low AS (SELECT k, min(doc_id) AS low FROM g GROUP BY k HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM g JOIN low USING (k) WHERE low < doc_id
), t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w
), k AS (
    SELECT t.doc_id, count(*) FILTER (gone.p IS NOT NULL) AS n,
           string_agg(t.word, ' ' ORDER BY t.p) FILTER (gone.p IS NULL) AS kept
    FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.p = t.p GROUP BY t.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": _OP1,
    "op2_minhash_near_dedup": _OP2,
    "op3_url_filter": _OP3,
    "op5_mix_sources": _OP5,
    "op8_warc": _OP8,
    "op9_line_dedup": _OP9,
    "op11_hard_negatives": _OP11,
    "op12_filter_audit": _OP12,
    "op13_substring_dedup": _OP13,
}
