"""The registered query of each operator: its production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, html, media, packing, pii, quality, simhash, tokens, toxicity, warc
from sparkloom.llm.common import held_out, table


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sized = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return media.digests(media.wrapped(sized))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.toxicity_score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality.quality_score(model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(table(spark, sf_dir, "pages"))
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.pseudonymised(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "text", F.size("spans").alias("n_found"), F.array_join(F.array_sort(F.array_distinct("spans.kind")), ",").alias("kinds"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_media, op2_toxicity, op3_packing, op4_html, op5_quality, op6_warc, op7_decontamination, op8_pii, op9_token_counts, op10_simhash, pipeline)
    return {f.__name__: f for f in own}


WARC_SQL = """WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n) END AS best FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN best <> page_id THEN best END AS refers_to FROM m"""


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": WARC_SQL}
