"""Registered queries of the training-data operators and, where SQL can express them, their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import alignment, bpe, ctw, filter_audit, fingerprints, jaccard, knn, mixing, pii, secret_scan, suffixes, toxicity, warc
from shelfwise.llm.common import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_knn(spark: SparkSession, folder: str) -> DataFrame:
    return knn.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text with its personal data replaced."""
    return pii.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(table(spark, folder, "documents"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.report(table(spark, folder, "documents"))


def op7_context_trees(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.report(table(spark, folder, "documents"))


def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"))


def op10_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.report(table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.report(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.report(table(spark, folder, "pages"))


QUERIES: dict[str, Query] = {
    "op1_knn": op1_knn,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_secrets": op3_secrets,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_fingerprints": op6_fingerprints,
    "op7_context_trees": op7_context_trees,
    "op8_jaccard": op8_jaccard,
    "op9_mixing": op9_mixing,
    "op10_suffixes": op10_suffixes,
    "op11_filter_audit": op11_filter_audit,
    "op12_alignment": op12_alignment,
    "op13_warc": op13_warc,
}

OP1_SQL = """
WITH scaled AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM scaled q JOIN scaled d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

OP9_SQL = r"""
WITH measured AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(coalesce(text, '')) AS chars,
         (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix-1'), 1, 13) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
drawn AS (
  SELECT *, -ln(u) / greatest(0.05::DOUBLE, 1 - abs(chars::DOUBLE / greatest(size, 1) - 6) / 12) AS key
  FROM measured),
sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, CAST(SUM(size) * 3 AS BIGINT) AS cap,
         [5, 2, 1][((ROW_NUMBER() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight
  FROM drawn GROUP BY source),
steps AS (
  SELECT *, (SUM(source_size) OVER () - coalesce(SUM(cap) OVER before, 0))::DOUBLE
            / (SUM(weight) OVER () - coalesce(SUM(weight) OVER before, 0)) AS step
  FROM sources
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * MAX(step) OVER ()) AS target FROM steps),
budgets AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         CAST(floor(target + 0.5) AS BIGINT) // greatest(source_size, 1) AS epochs FROM targets)
SELECT doc_id, size, b.source_size, b.target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * b.source_size - coalesce(SUM(size) OVER (
         PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM drawn d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
"""

OP11_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
flags AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         len(words) < 100 AS a,
         100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(d.doc_id > MIN(d.doc_id) OVER (PARTITION BY text), false) AS e
  FROM docs d LEFT JOIN marks m ON d.doc_id = m.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT v.x || w.x || x.x || y.x || z.x AS filter_order FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.x, w.x, x.x, y.x, z.x])) = 5),
failing AS (
  SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
         || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         COUNT(*) AS n
  FROM flags GROUP BY ALL),
gone AS (
  SELECT f.*, filter_order, CASE WHEN fails = '' THEN 6 ELSE list_min(list_transform(string_split(fails, ''),
         lambda x: instr(filter_order, x))) END AS gone_at
  FROM failing f, orders),
steps AS (
  SELECT part, filter_order, CAST(s.step AS INT) AS step, substr(filter_order, s.step, 1) AS x,
         SUM(CASE WHEN gone_at > s.step THEN n ELSE 0 END) AS kept, SUM(CASE WHEN gone_at = s.step THEN n ELSE 0 END) AS removed,
         SUM(CASE WHEN gone_at < s.step AND contains(fails, substr(filter_order, s.step, 1)) THEN n ELSE 0 END) AS redundant,
         SUM(CASE WHEN fails = substr(filter_order, s.step, 1) THEN n ELSE 0 END) AS unique_fails,
         SUM(CASE WHEN gone_at = s.step AND good THEN n ELSE 0 END) AS good_lost,
         SUM(CASE WHEN gone_at = s.step AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM gone, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM steps
"""

OP13_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
ranked AS (
  SELECT *, sha256(html) AS payload_digest, FIRST_VALUE(page_id) OVER same AS first_id, ROW_NUMBER() OVER same AS n
  FROM payloads WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND n > 1 THEN first_id END AS refers_to
FROM ranked
"""

ORACLE_SQL: dict[str, str] = {
    "op1_knn": OP1_SQL,
    "op9_mixing": OP9_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_warc": OP13_SQL,
}
