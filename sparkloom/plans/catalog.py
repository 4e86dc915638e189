"""Queries of the catalog and the monitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S
from sparkloom.operators import catalog as C
from sparkloom.operators import monitor as M
from sparkloom.plans.frames import DOCS_SQL, LINEAR_SQL, METRICS, METRICS_SQL, PLAIN_SQL, docs_view, metrics, table
from sparkloom.plans.registry import query


@query("SELECT doc_id, source, n_chars FROM documents WHERE doc_id = 7")
def doc_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("doc_id = 7").select("doc_id", "source", "n_chars")


@query("SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def docs_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(wanted, "doc_id", "left_semi")


_VIEW_SQL = (
    METRICS_SQL
    + f""", z AS (SELECT m.doc_id AS id, p.url, substring(o.text, 1, 60) AS title, m.source AS domain, m.lang AS content_type, round({LINEAR_SQL}, 9) AS quality_score, e.label AS cluster_id
  FROM m JOIN documents o ON o.doc_id = m.doc_id LEFT JOIN pages p ON p.page_id = m.doc_id LEFT JOIN embeddings e ON e.vec_id = m.doc_id) """
)


def _viewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's documents with the pages' URLs."""
    urls = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    return docs_view(spark, sf_dir).join(urls, "id", "left")


@query(_VIEW_SQL + "SELECT id, url, title, NULL::VARCHAR AS summary, domain, content_type, quality_score, NULL::VARCHAR AS wilson_score, NULL::VARCHAR AS importance_score, cluster_id, NULL::VARCHAR AS created_at FROM z")
def doc_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.view(_viewed(spark, sf_dir))


@query(_VIEW_SQL + "SELECT url, title, NULL::VARCHAR AS summary, domain, content_type FROM z")
def doc_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.view(_viewed(spark, sf_dir), "export")


@query(DOCS_SQL + "SELECT id, domain, quality_score FROM d WHERE status = 'active' AND content_type = 'en' AND quality_score >= 3e-1 ORDER BY quality_score DESC NULLS LAST, id LIMIT 50")
def doc_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.page(docs_view(spark, sf_dir), 50, content_type="en", min_quality=0.3).select("id", "domain", "quality_score")


@query(DOCS_SQL + "SELECT id, quality_score FROM d WHERE status = 'active' ORDER BY quality_score DESC NULLS LAST, id LIMIT 25 OFFSET 75")
def doc_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.page(docs_view(spark, sf_dir), 25, 75).select("id", "quality_score")


@query(DOCS_SQL + "SELECT count(*) AS total FROM d WHERE status = 'active' AND quality_score >= 3e-1 AND cluster_id = 3")
def doc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.total(docs_view(spark, sf_dir), min_quality=0.3, cluster_id=3)


@query(DOCS_SQL + "SELECT id, title, quality_score FROM d WHERE status = 'active' AND (title ILIKE '%then%' OR domain ILIKE '%then%') ORDER BY quality_score DESC NULLS LAST, id LIMIT 20")
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.search_text(docs_view(spark, sf_dir), "then").select("id", "title", "quality_score")


@query(r"""WITH w AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(lower(concat_ws(' ', substring(text, 1, 60), text)), '[\p{L}\p{N}_]+')) AS word FROM documents),
h AS (SELECT * FROM w WHERE word IN ('worthless', 'idiot', 'clown')), r AS (SELECT word, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)::DOUBLE) AS idf FROM h GROUP BY word),
k AS (SELECT id, count(*) AS matched, sum(idf) AS rank FROM h JOIN r USING (word) GROUP BY id)
SELECT id, matched, round(rank, 6) AS rank, (SELECT count(*) FROM k) AS total_hits FROM k ORDER BY matched DESC, round(rank, 9) DESC, id LIMIT 20""")
def search_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.search_fulltext(docs_view(spark, sf_dir, scored=False), "idiot clown worthless").withColumn("rank", F.round("rank", 6))


@query(PLAIN_SQL + "SELECT id, coalesce(title, '') AS title, coalesce(domain, '') AS domain, coalesce(content_type, 'unscored') AS content_type, coalesce(cluster_id, -1) AS cluster_id FROM d WHERE status = 'active'")
def search_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.search_view(docs_view(spark, sf_dir, scored=False).withColumn("quality_score", F.lit(0.0))).drop("quality_score")


@query("SELECT vec_id, label, len(embedding) AS size FROM embeddings")
def scan_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.size("embedding").cast("long").alias("size"))


@query(DOCS_SQL + "SELECT cluster_id, count(*) AS n_docs, round(avg(quality_score), 6) AS avg_quality, min(quality_score) AS min_quality, max(quality_score) AS max_quality, coalesce(cluster_id = -1, false) AS is_orphaned FROM d WHERE status = 'active' GROUP BY cluster_id")
def cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.cluster_stats(docs_view(spark, sf_dir)).withColumn("avg_quality", F.round("avg_quality", 6))


@query(PLAIN_SQL + "SELECT content_type, count(*) AS n_docs FROM d WHERE status = 'active' GROUP BY 1")
def content_type_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.distribution(docs_view(spark, sf_dir, scored=False).where("status = 'active'"), "content_type")


@query("SELECT source AS domain, count(*) AS n_docs FROM documents GROUP BY 1")
def domain_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.distribution(table(spark, sf_dir, "documents").select(F.col("source").alias("domain")), "domain")


@query(DOCS_SQL + "SELECT count(*) FILTER (quality_score >= 7e-1) AS high, count(*) FILTER (quality_score >= 4e-1 AND quality_score < 7e-1) AS medium, count(*) FILTER (quality_score < 4e-1) AS low FROM d WHERE status = 'active'")
def quality_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.quality_buckets(docs_view(spark, sf_dir))


@query(PLAIN_SQL + "SELECT count(DISTINCT cluster_id) AS n_clusters FROM d WHERE status = 'active' AND cluster_id <> -1")
def cluster_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.cluster_count(docs_view(spark, sf_dir, scored=False))


@query(DOCS_SQL + "SELECT count(*) AS n_docs, count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS n_clusters, round(avg(quality_score), 6) AS avg_quality, count(*) FILTER (has_vector) AS n_vectors FROM d WHERE status = 'active'")
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.corpus_stats(docs_view(spark, sf_dir)).withColumn("avg_quality", F.round("avg_quality", 6))


def _gini_sql(column: str, out: str) -> str:
    return f"""(WITH c AS (SELECT count(*) AS c FROM d GROUP BY {column}), r AS (SELECT c, row_number() OVER (ORDER BY c) AS i, count(*) OVER () AS n, sum(c) OVER () AS s FROM c)
    SELECT coalesce(round(sum((2 * i - n - 1) * c)::DOUBLE / max(n * s), 9), 0e0) FROM r) AS {out}"""


@query(PLAIN_SQL + "SELECT " + _gini_sql("content_type", "gini"))
def gini_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.gini(M.distribution(table(spark, sf_dir, "documents"), "lang")).select(F.round("gini", 9).alias("gini"))


@query(PLAIN_SQL + "SELECT " + _gini_sql("domain", "gini"))
def gini_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.gini(M.distribution(table(spark, sf_dir, "documents"), "source")).select(F.round("gini", 9).alias("gini"))


def _orphaned(docs: DataFrame) -> DataFrame:
    """The view with cluster 0 as the noise cluster, as the given labels have none."""
    return docs.withColumn("cluster_id", F.when(F.col("cluster_id") == 0, -1).otherwise(F.col("cluster_id")))


_COVERAGE_SQL = (
    DOCS_SQL
    + ", e AS (SELECT * REPLACE (CASE WHEN cluster_id = 0 THEN -1 ELSE cluster_id END AS cluster_id) FROM d), k AS (SELECT cluster_id, count(*) AS n FROM e GROUP BY 1), v AS (SELECT "
    + _gini_sql("content_type", "topic_gini")
    + ", "
    + _gini_sql("domain", "domain_gini")
    + """, round((SELECT coalesce(sum(n) FILTER (cluster_id = -1), 0) / greatest(sum(n), 1)::DOUBLE FROM k), 9) AS orphan_rate,
  (SELECT count(*) FROM e WHERE cluster_id = -1 AND quality_score > 7e-1) AS high_quality_orphans,
  (SELECT count(*) FROM k WHERE cluster_id IS DISTINCT FROM -1) AS cluster_count,
  round((SELECT coalesce(max(n) FILTER (cluster_id IS DISTINCT FROM -1), 0) / greatest(sum(n), 1)::DOUBLE FROM k), 9) AS largest_cluster_pct)
"""
)


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of all documents; only the texts of the noise cluster are read and scored."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster_id"))
    rows = docs.select("doc_id", F.col("source").alias("domain"), F.col("lang").alias("content_type")).join(labels, "doc_id", "left")
    noise = docs.join(labels.where("cluster_id = 0"), "doc_id").select("doc_id", "text", "source", "cluster_id")
    scored = S.with_metrics(noise, host=F.col("source")).select("cluster_id", F.round(S.linear_score(), 9).alias("quality_score"))
    return M.coverage(_orphaned(rows), scored=_orphaned(scored))


@query(_COVERAGE_SQL + "SELECT * FROM v")
def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _coverage(spark, sf_dir)
    return c.withColumns({k: F.round(k, 9) for k in ("topic_gini", "domain_gini", "orphan_rate", "largest_cluster_pct")})


@query(_COVERAGE_SQL + ", x AS (SELECT unnest([CASE WHEN topic_gini > 3e-1 THEN 'topic_gini' END, CASE WHEN domain_gini > 3e-1 THEN 'domain_gini' END, CASE WHEN high_quality_orphans > 100 THEN 'high_quality_orphans' END, CASE WHEN orphan_rate > 1e-2 THEN 'orphan_rate' END]) AS alert FROM v) SELECT alert FROM x WHERE alert IS NOT NULL")
def health_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.config import DEFAULTS

    low = DEFAULTS.with_(gini_threshold=0.3, orphan_rate_threshold=0.01)
    return M.alerts(_coverage(spark, sf_dir), low)


@query(DOCS_SQL + """, g AS (SELECT cluster_id, domain, count(*) AS n, sum(quality_score) AS s, sum(quality_score * quality_score) AS s2 FROM d WHERE cluster_id IS NOT NULL GROUP BY 1, 2),
h AS (SELECT cluster_id, sum(n)::BIGINT AS n_docs, sum(s) / sum(n) AS q, sqrt(greatest(sum(s2) / sum(n) - (sum(s) / sum(n)) * (sum(s) / sum(n)), 0)) AS sd, max(n) / sum(n)::DOUBLE AS top FROM g GROUP BY 1)
SELECT cluster_id, n_docs, round(q, 6) AS avg_quality, round(sd, 6) AS quality_std, round(top, 6) AS domain_concentration, top >= 8e-1 AND q < 4e-1 AS is_content_farm, q >= 7e-1 AS is_authority FROM h""")
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.cluster_profile(docs_view(spark, sf_dir)).withColumns({k: F.round(k, 6) for k in ("avg_quality", "quality_std", "domain_concentration")})


@query("""SELECT d.doc_id AS id, md5(d.text) AS text_md5 FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL""")
def unscored_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose document is pending: those without a label."""
    docs = table(spark, sf_dir, "documents")
    scored = table(spark, sf_dir, "labels").select("doc_id").withColumn("scored", F.lit(True))
    rows = docs.select("doc_id").join(scored, "doc_id", "left").select(F.col("doc_id").alias("id"), F.when(F.col("scored"), "default").otherwise("pending").alias("quality_profile_used"))
    texts = docs.select(F.col("doc_id").alias("id"), F.md5("text").alias("text_md5"))
    return C.unscored(rows, texts)


@query("SELECT d.doc_id, coalesce(p.url, '') AS url FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id")
def score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of each text; missing becomes empty."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return table(spark, sf_dir, "documents").select("doc_id").join(pages, "doc_id", "left").select("doc_id", F.coalesce("url", F.lit("")).alias("url"))


@query("SELECT vec_id, label, source FROM embeddings JOIN documents ON vec_id = doc_id")
def vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source")
    return table(spark, sf_dir, "embeddings").select("vec_id", "label").join(docs, "vec_id")


@query(PLAIN_SQL + """, p AS (SELECT page_id AS id, CASE WHEN page_id % 2 = 0 THEN '' ELSE 'kept' END AS title, NULL::VARCHAR AS domain, ' ' AS content_type FROM pages)
SELECT p.id, CASE WHEN p.title = '' THEN d.title ELSE p.title END AS title, d.domain, d.content_type FROM p LEFT JOIN d USING (id)""")
def mapping_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping with blank titles, null domains and blank types, filled from the documents."""
    m = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.when(F.col("page_id") % 2 == 0, "").otherwise("kept").alias("title"), F.lit(None).cast("string").alias("domain"), F.lit(" ").alias("content_type"))
    return C.enriched(m, docs_view(spark, sf_dir, scored=False))


@query("SELECT DISTINCT p.url FROM pages p WHERE p.page_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of pages that are not stored yet."""
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"))
    return C.missing(table(spark, sf_dir, "pages").select("page_id", "url"), known, "page_id").select("url").distinct()


@query("""WITH a AS (SELECT conv_id AS id, turn AS position, text FROM conversations), w AS (SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT id, md5(arg_min(text, position)) AS text_md5 FROM a JOIN w USING (id) WHERE text IS NOT NULL GROUP BY id""")
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first archived text of each document without one; conversations stand for the archive."""
    archive = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("position"), "text")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    texts = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return C.backfill(archive, docs, texts).select("id", F.md5("text").alias("text_md5"))


_GOLDEN_SQL = METRICS_SQL + f", g AS (SELECT m.*, CASE WHEN quality = 1 THEN 5 ELSE 1 END AS label, 1 / (1 + exp(-1e1 * (({' + '.join(f'{k} * {w}e0' for k, w in S.WEIGHTS.items())}) / {sum(S.WEIGHTS.values())!r}::DOUBLE - 5e-1))) AS score FROM m JOIN labels USING (doc_id))"


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with metrics: label 5 for quality 1, else 1."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, 5).otherwise(1).alias("label"))
    return metrics(spark, sf_dir).join(labels, "doc_id").withColumn("score", S.sigmoid_score())


@query(_GOLDEN_SQL + ", x AS (SELECT label >= 4 AS y, score > 5e-1 AS p FROM g), z AS (SELECT count(*) AS n, abs(sum(y::INT) - sum(p::INT))::DOUBLE / count(*) AS q, sum((y <> p)::INT)::DOUBLE / count(*) AS e FROM x) SELECT round(q, 9) AS quantity, round(e - q, 9) AS allocation, round(sqrt(q * q + (e - q) * (e - q)), 9) AS qadi FROM z")
def qadi(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = golden(spark, sf_dir).agg(*M.qadi(F.col("label") >= 4, F.col("score") > 0.5))
    return found.select(*(F.round(c, 9).alias(c) for c in found.columns))


@query(_GOLDEN_SQL + ", x AS (SELECT avg(score) FILTER (label >= 4) AS e, avg(score) FILTER (label <= 2) AS g FROM g) SELECT round(e, 6) AS exemplary, round(g, 6) AS garbage, e > g AS separated FROM x")
def golden_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.separation(golden(spark, sf_dir)).withColumns({k: F.round(k, 6) for k in ("exemplary", "garbage")})


@query(_GOLDEN_SQL + "SELECT doc_id, label, source FROM g WHERE label IS NOT NULL")
def golden_train_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden(spark, sf_dir).select("doc_id", "label", "source")


@query(_GOLDEN_SQL + ", x AS (SELECT avg(score) FILTER (label >= 4) AS e, avg(score) FILTER (label <= 2) AS g, count(*) AS n, abs(sum((label >= 4)::INT) - sum((score > 5e-1)::INT))::DOUBLE / count(*) AS q, sum(((label >= 4) <> (score > 5e-1))::INT)::DOUBLE / count(*) AS er FROM g) SELECT round(e, 6) AS exemplary, round(g, 6) AS garbage, e > g AS separated, round(sqrt(q * q + (er - q) * (er - q)), 6) AS qadi, e > g AND sqrt(q * q + (er - q) * (er - q)) < 3e-1 AS passed FROM x")
def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.operators import calibrate

    found = calibrate.validate(golden(spark, sf_dir).drop("score"), S.WEIGHTS)
    return found.select(F.round("exemplary", 6).alias("exemplary"), F.round("garbage", 6).alias("garbage"), "separated", F.round("qadi", 6).alias("qadi"), "passed")


_PAIRS = [(a, b) for i, a in enumerate(METRICS) for b in (*METRICS[i:], "y")]


@query(_GOLDEN_SQL + ", x AS (SELECT *, (label = 5)::INT AS y FROM g) SELECT count(*) AS n, " + ", ".join(f"round(sum({a} * {b}), 6) AS {a}__{b}" for a, b in _PAIRS) + " FROM x")
def gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normal equations of all seven metrics."""
    from sparkloom.operators import calibrate

    rows = golden(spark, sf_dir).withColumn("y", (F.col("label") == 5).cast("double"))
    g = calibrate.gram(rows, METRICS)
    return g.select("n", *(F.round(f"{a}__{b}", 6).alias(f"{a}__{b}") for a, b in _PAIRS))


@query()
def train_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-negative lasso weights of the metrics."""
    from sparkloom.operators import calibrate

    weights = calibrate.train(golden(spark, sf_dir))
    return spark.createDataFrame([(k, round(v, 9)) for k, v in sorted(weights.items())], "metric string, weight double")
