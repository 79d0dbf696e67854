"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import (binary_records, divergence, line_dedup, lm_scoring, mixing, near_dedup, outliers, packing,
                           personal, quality, warc, weighted_sampling, whitening)
from lodgeflow.llm.common import scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_json() -> str:
    """The public 49k word vocabulary; read on the driver, sent to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op1_warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_weighted_sampling(spark: SparkSession, sf: str) -> DataFrame:
    return weighted_sampling.fingerprint_documents(table(spark, sf, "documents"))


def op3_pack_sequences(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf, "documents"), tokenizer_json())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_quality_trees(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal.find_personal(table(spark, sf, "documents"))


def op6_robust_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.judge(table(spark, sf, "documents"))


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf, "documents"))


def op8_recurrent_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf, "documents"))


def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


def op10_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf, "documents"))


def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


def op12_binary_records(spark: SparkSession, sf: str) -> DataFrame:
    index = binary_records.encode_documents(table(spark, sf, "documents"), scratch_path(spark, "records"), tokenizer_json())
    return index.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op13_whitened_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_warc_revisits": op1_warc_revisits,
        "op2_weighted_sampling": op2_weighted_sampling,
        "op3_pack_sequences": op3_pack_sequences,
        "op4_quality_trees": op4_quality_trees,
        "op5_personal_data": op5_personal_data,
        "op6_robust_outliers": op6_robust_outliers,
        "op7_line_dedup": op7_line_dedup,
        "op8_recurrent_scores": op8_recurrent_scores,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_mix_sources": op10_mix_sources,
        "op11_source_divergence": op11_source_divergence,
        "op12_binary_records": op12_binary_records,
        "op13_whitened_embeddings": op13_whitened_embeddings,
    }


OP1_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
o AS (
  SELECT payload_digest, min(page_id) AS original FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN o.original <> coalesce(p.page_id, -1) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN o.original <> coalesce(p.page_id, -1) THEN o.original END AS refers_to
FROM p LEFT JOIN o ON p.payload_digest = o.payload_digest AND p.payload_bytes >= 100
"""

# The same targets and nearest-boundary rule by plain windows over all rows.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, '~') AS k, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT k, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY k) - 1 AS r
  FROM d GROUP BY k),
w AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS cap,
         CASE r % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, k
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, k
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (
  SELECT k, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
b AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN least(CAST(floor(target / source_size) AS BIGINT), 2) ELSE 0 END AS copies FROM t),
g AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.copies, b.target - b.copies * b.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.k ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(d.size) OVER (PARTITION BY d.k, d.h) AS own
  FROM d JOIN b ON d.k = b.k)
SELECT doc_id, size, source_size, target,
       CAST(size * least(copies + CASE WHEN copies < 2 AND (upto <= budget
            OR (upto - own <= budget AND upto - budget < budget - (upto - own))) THEN 1 ELSE 0 END, 2) AS BIGINT)
       AS taken
FROM g
"""


# Shares of every kept term by every group, densely.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents),
t AS (
  SELECT k, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT t.lang, t.source, t.term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
s AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (kept.total + 5)) // (l.n + 5 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN kept USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM s WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_revisits": OP1_SQL, "op10_mix_sources": OP10_SQL, "op11_source_divergence": OP11_SQL}
