"""Frames and SQL preambles that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S

METRICS = list(S.WEIGHTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source and the seven metrics of every document; its source is its host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return S.with_metrics(docs, host=F.col("source")).drop("text")


def status(docs: DataFrame) -> DataFrame:
    """doc_id of the documents whose text an earlier one has. The hashes with more
    than one row are joined back; adaptive execution splits a hot one."""
    hashed = docs.select("doc_id", F.md5("text").alias("h"))
    first = hashed.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return hashed.join(first, "h").where("doc_id > first").select("doc_id")


def docs_view(spark: SparkSession, sf_dir: str, scored: bool = True) -> DataFrame:
    """The catalog's documents: text table, embedding label as cluster, score, status."""
    raw = table(spark, sf_dir, "documents")
    base = raw.select("doc_id", "text", "source", "lang", "n_chars")
    if scored:
        base = S.with_metrics(base, host=F.col("source")).withColumn("quality_score", F.round(S.linear_score(), 9)).drop(*METRICS)
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster_id"), F.lit(True).alias("has_vector"))
    gone = status(raw).withColumn("_dup", F.lit(True))
    out = base.join(vectors, "doc_id", "left").join(gone, "doc_id", "left")
    names = [F.col("doc_id").alias("id"), F.substring("text", 1, 60).alias("title"), "text", F.col("source").alias("domain"), F.col("lang").alias("content_type"), F.col("n_chars").alias("content_length"), "cluster_id", F.coalesce("has_vector", F.lit(False)).alias("has_vector"), F.when(F.col("_dup"), "duplicate").otherwise("active").alias("status")]
    return out.select(*names, *(["quality_score"] if scored else []))


def _words(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _any(column: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


METRICS_SQL = rf"""
WITH t AS (
  SELECT doc_id, source, lang, n_chars, coalesce(text, '') AS text,
         regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}_]+') AS w,
         len(list_filter(string_split_regex(coalesce(text, ''), '[.!?]+'), lambda x: length(trim(x, ' ')) > 0)) AS sents,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(trim(x, ' ')) > 50) AS lines
  FROM documents
), c AS (
  SELECT *, len(w) AS n, greatest(len(w), 1)::DOUBLE AS n1, len(list_distinct(w)) AS u,
         len(list_filter(w, lambda x: x IN ({_words(S.STOP_WORDS)}))) AS stops,
         len(list_filter(w, lambda x: x IN ({_words(S.METHODS)}))) AS meths,
         len(list_filter(w, lambda x: length(x) > 6)) AS longs,
         list_sum(list_transform(lines, lambda x: length(x)))::DOUBLE / greatest(len(lines), 1) AS mean_line
  FROM t
), m AS (
  SELECT doc_id, source, lang, n_chars, text,
    CASE WHEN n = 0 THEN 0e0 ELSE least(len(regexp_extract_all(text, '\[\d+\]')) * 2e-1 + len(regexp_extract_all(text, '\([A-Z][a-z]+, \d{{4}}\)')) * 3e-1
      + len(regexp_extract_all(text, 'https?://')) * 1e-1
      + ({" + ".join(f"contains(right(lower(text), 1000), '{k}')::INT" for k in S.CITATION_WORDS)}) * 4e-1, 1e0) END AS citation_quality,
    CASE WHEN n = 0 THEN 0e0 ELSE greatest(0e0, (1e0 - least(abs(n1 / greatest(sents, 1) - 20) / 20, 1e0)) * 6e-1 + (1e0 - abs(stops / n1 - 4e-1) * 2) * 4e-1) END AS writing_quality,
    CASE WHEN n = 0 THEN 0e0 ELSE least(ln(n + 1) / ln(4e3), 1e0) * 7e-1 + u / n1 * 3e-1 END AS content_depth,
    CASE WHEN n = 0 THEN 0e0 ELSE least(meths / (n * 1e-2 + 1), 1e0) END AS methodology_transparency,
    CASE WHEN n = 0 THEN 0e0 ELSE least(longs / n1 * 3, 1e0) END AS specificity,
    CASE WHEN n = 0 THEN 0e0 WHEN {_any("source", (".edu", ".gov", ".mil"))} THEN 9e-1 WHEN {_any("source", (".org", ".ac.", ".sci"))} THEN 8e-1
      WHEN {_any("source", ("wordpress", "blogspot"))} THEN 4e-1 ELSE 5e-1 END AS source_reputation,
    CASE WHEN n = 0 THEN 0e0 WHEN len(lines) = 0 THEN 2e-1 WHEN mean_line < 100 THEN mean_line / 100 WHEN mean_line > 1000 THEN greatest(0e0, 1 - (mean_line - 1000) / 1000) ELSE 1e0 END AS structural_integrity
  FROM c
)
"""

LINEAR_SQL = "least(greatest(" + " + ".join(f"{k} * {w}e0" for k, w in S.WEIGHTS.items()) + ", 0e0), 1e0)"

DOCS_SQL = (
    METRICS_SQL
    + f""", d AS (
  SELECT m.doc_id AS id, substring(o.text, 1, 60) AS title, o.text, m.source AS domain, m.lang AS content_type, m.n_chars AS content_length,
         e.label AS cluster_id, e.vec_id IS NOT NULL AS has_vector, round({LINEAR_SQL}, 9) AS quality_score,
         CASE WHEN m.doc_id > min(m.doc_id) OVER (PARTITION BY md5(o.text)) THEN 'duplicate' ELSE 'active' END AS status
  FROM m JOIN documents o ON o.doc_id = m.doc_id LEFT JOIN embeddings e ON e.vec_id = m.doc_id
)
"""
)

#: The same without scores.
PLAIN_SQL = """
WITH d AS (
  SELECT o.doc_id AS id, substring(o.text, 1, 60) AS title, o.text, o.source AS domain, o.lang AS content_type, o.n_chars AS content_length,
         e.label AS cluster_id, e.vec_id IS NOT NULL AS has_vector,
         CASE WHEN o.doc_id > min(o.doc_id) OVER (PARTITION BY md5(o.text)) THEN 'duplicate' ELSE 'active' END AS status
  FROM documents o LEFT JOIN embeddings e ON e.vec_id = o.doc_id
)
"""
