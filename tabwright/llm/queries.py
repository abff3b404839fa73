"""One query per operator over its whole table with production parameters, and SQL twins where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import (
    decontaminate, divergence, fingerprint, maxent, merkle, merkle_sql, neardup, packing, pieces, pii, quality, token_counts,
    toxicity, warc,
)
from tabwright.llm.common import fold, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = warc.indexed(spark, warc.archived(table(spark, sf_dir, "pages")))

    def page(name: str):
        return F.regexp_extract(name, r"^<urn:page:(-?\d+):", 1).try_cast("long")

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.MinHashOptions(shingle=2))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def _judged(scored: DataFrame, score: str, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.col(score).alias("score"),
        (F.col(score) >= threshold).cast("int").alias("predicted"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, table(spark, sf_dir, "labels"))
    return _judged(scored, "toxic_score", toxicity.KernelOptions().threshold)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.scored(docs, table(spark, sf_dir, "labels"))
    return _judged(scored, "quality_score", quality.KnnOptions().threshold)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(table(spark, sf_dir, "documents"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, token_counts.VOCABULARY).drop("text"), token_counts.VOCABULARY)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_minhash, op3_token_counts, op4_toxicity, op5_pii, op6_fingerprints, op7_decontaminate,
        op8_quality, op9_packing, op10_maxent, op11_pieces, op12_divergence, op13_merkle,
    )
}

SQL = {
    "op1_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
held AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
  CASE WHEN top IS NULL OR top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN held ON held.payload_digest = p.payload_digest AND payload_bytes >= 1000""",
    "op2_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) < 2 THEN words
    ELSE [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] END) AS items FROM w),
e AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s),
linked AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.item = y.item AND x.doc_id > y.doc_id
    AND 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
walk AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT walk.a, both_ways.b FROM walk JOIN both_ways ON walk.b = both_ways.a)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles, min(walk.b) AS component_id, min(walk.b) = s.doc_id AS kept
FROM s JOIN walk ON walk.a = s.doc_id GROUP BY s.doc_id, s.items""",
    "op12_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT t.lang, source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
  CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (coalesce(s.total, 0) + 2 * v) AS BIGINT) AS p,
  CAST(1 + CAST(1000000000 AS HUGEINT) * (kept.n + 2) // (l.total + 2 * v) AS BIGINT) AS q
  FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM items)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op13_merkle": merkle_sql.SQL,
}
