"""The operators as registered queries, with SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, jaccard, language, passages, secret_scan, simhash, survival, token_count, toxicity, turns, voronoi, warc
from .common import new_dir, table

WORD_BPE = "word_bpe_49k.json"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.parse_records(warc.read_archive(spark, path))


SQL1 = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes, digest AS payload_digest,
       CASE WHEN octet_length(payload) >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(payload) >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
       url AS target_uri
FROM f
"""


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), new_dir(spark, "ledger"), "doc_id", "text")
    n = lambda rule: F.size(F.filter("spans", lambda s: s["rule"] == rule)).cast("bigint")
    text = secret_scan.span_text("spans")
    return found.select(F.col("path").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                        F.sha2(text, 256).alias("base_sha256"), text.alias("spans"), F.col("digest").alias("blob_sha256"))


def _sql_kind(name: str, number: int, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT doc_id, {number} AS kind_no, '{name}' AS kind, start, start + len AS stop FROM (
    SELECT doc_id, gap_sum + coalesce(sum(len) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, len, checked
    FROM (
      SELECT doc_id, i, length(matches[i]) AS len, length(checks[i]) AS checked,
             sum(length(gaps[i])) OVER (PARTITION BY doc_id ORDER BY i) AS gap_sum
      FROM (
        SELECT doc_id, unnest(range(1, len(matches) + 1)) AS i, matches, checks, gaps FROM (
          SELECT doc_id, regexp_extract_all(x, '{pattern}') AS matches, regexp_extract_all(x, '{pattern}', {group}) AS checks,
                 string_split_regex(x, '{pattern}') AS gaps FROM t))))
  WHERE checked >= {least}"""


_KEYS = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
SQL2 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
s AS ({_sql_kind("assign", 0, _KEYS + "[\"'']?[ ]*[:=][ ]*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 12)}
  UNION ALL {_sql_kind("access", 1, "AKIA[A-Z0-9]+", 0, 18)}
  UNION ALL {_sql_kind("hex", 2, "[0-9a-f]+", 0, 16)}),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE kind_no = 0) AS n_assign, count(*) FILTER (WHERE kind_no = 1) AS n_access,
         count(*) FILTER (WHERE kind_no = 2) AS n_hex,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind_no) AS spans
  FROM s GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t.x) AS blob_sha256
FROM t LEFT JOIN g ON t.doc_id = g.doc_id
"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, WORD_BPE).select(
        "doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.n_hit()
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, WORD_BPE).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def language_fold():
    """crc32 of the id as text, modulo 4; 2 is held out."""
    return F.crc32(F.col("doc_id").cast("string")) % 4


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.filter(F.coalesce(language_fold(), F.lit(0)) != 2))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(language_fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_edits(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents")).withColumnsRenamed({"id": "doc_id", "match_id": "match_doc_id"})


def toxicity_fold():
    """crc32 of the id as text, modulo 3; 1 is held out."""
    return F.crc32(F.col("doc_id").cast("string")) % 3


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(toxicity_fold() != 1))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(toxicity_fold() == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL11 = """
WITH v AS (
  SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.no, q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.x, d.x) AS BIGINT) AS score
  FROM v AS q JOIN v AS d ON q.vec_id % 20 = 0 AND d.no <> q.no),
r AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


SQL12 = """
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substring(k, i, 1)) AS BIGINT)),
       lambda crc, b: list_reduce(range(8), lambda x, j: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, b)),
       4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind FROM c),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
       CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
       unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
f AS (SELECT conv_id, turn, role, text, i, role[1] AS initial,
       CASE WHEN regexp_full_match(text, '[\\x20\\x09-\\x0D]*') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN '' ELSE 'truncated' END AS fault FROM o),
moves(state, initial, after) AS (VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
made(state, lines, letters, cost, after) AS (
  SELECT state, CAST([] AS VARCHAR[]), '', 0, state FROM (SELECT DISTINCT state FROM moves)
  UNION ALL SELECT m.state, list_append(lines, CASE n.after WHEN 'u' THEN 'user:' ELSE 'assistant:' END), letters || 'I', cost + 3, n.after
  FROM made AS m JOIN moves AS n ON n.state = m.after AND n.initial <> 's' AND cost < 6),
dp(conv_id, i, state, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '-', 0, '', CAST([] AS VARCHAR[]) FROM conversations
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) AS best FROM (
      SELECT f.conv_id, f.i, e.after AS state, dp.cost + m.cost + e.cost AS cost, dp.audit || m.letters || e.letter AS audit,
             list_concat(dp.lines, m.lines, e.lines) AS lines
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1 JOIN made AS m ON m.state = dp.state,
      LATERAL (
        SELECT 'D' AS letter, 4 AS cost, m.after AS after, CAST([] AS VARCHAR[]) AS lines
        UNION ALL SELECT 'K', CASE f.fault WHEN 'truncated' THEN 3 ELSE 0 END, k.after, [f.role || ':' || f.text]
        FROM moves AS k WHERE k.state = m.after AND k.initial = f.initial AND f.fault NOT IN ('blank', 'duplicate')
        UNION ALL SELECT 'R', CASE f.fault WHEN 'truncated' THEN 6 ELSE 3 END, k.after, [CASE k.after WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text]
        FROM moves AS k WHERE k.state = m.after AND k.initial <> 's' AND f.fault NOT IN ('blank', 'duplicate')) AS e))
  WHERE best = 1),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
       count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM f GROUP BY conv_id),
g AS (SELECT conv_id, count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM (SELECT conv_id, i, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM f) GROUP BY conv_id),
ends AS (SELECT dp.conv_id, dp.cost + m.cost AS cost, dp.audit || m.letters AS audit, list_concat(dp.lines, m.lines) AS lines,
       row_number() OVER (PARTITION BY dp.conv_id ORDER BY dp.cost + m.cost, dp.audit || m.letters) AS best
  FROM dp LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id JOIN made AS m ON m.state = dp.state AND m.after IN ('-', 'a')
  WHERE dp.i = coalesce(n.n, 0))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ends AS e LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM e.conv_id
WHERE best = 1
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survival.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_STEPS = " UNION ALL ".join(
    f"SELECT *, {k} AS step, a{k} AS f, " + ("false" if k == 1 else " OR ".join(f"list_contains(failed, a{i})" for i in range(1, k))) + " AS gone FROM marked, orders"
    for k in range(1, 6))
SQL13 = f"""
WITH t AS (SELECT row_number() OVER () AS no, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(string_split_regex(x, '[\\x20\\x09-\\x0D]+'), lambda s: s <> '') AS words, min(doc_id) OVER (PARTITION BY x) AS first_id FROM t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
marked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter([
    CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x) THEN 'C' END,
    CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' END, CASE WHEN first_id < w.doc_id THEN 'E' END], lambda s: s IS NOT NULL) AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, a.c AS a1, b.c AS a2, c.c AS a3, d.c AS a4, e.c AS a5
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS ({_STEPS}),
g AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f, count(*) FILTER (NOT gone AND NOT list_contains(failed, f)) AS kept,
         count(*) FILTER (NOT gone AND list_contains(failed, f)) AS removed, count(*) FILTER (gone AND list_contains(failed, f)) AS redundant,
         count(*) FILTER (failed = [f]) AS unique_fails,
         count(*) FILTER (good = 1 AND NOT gone AND list_contains(failed, f)) AS good_lost,
         count(*) FILTER (toxic = 1 AND NOT gone AND list_contains(failed, f)) AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM g
"""


QUERIES = {f.__name__: f for f in (op1_warc, op2_secrets, op3_bpe, op4_decontamination, op5_passages, op6_token_counts, op7_language,
                                   op8_simhash, op9_jaccard, op10_toxicity, op11_topk, op12_turn_repair, op13_filter_audit)}
ORACLE_SQL = {"op1_warc": SQL1, "op2_secrets": SQL2, "op11_topk": SQL11, "op12_turn_repair": SQL12, "op13_filter_audit": SQL13}
