"""Queries on document texts: tokens, metrics, scores, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S
from sparkloom.functions import text as T
from sparkloom.plans import dialect
from sparkloom.plans.frames import LINEAR_SQL, METRICS, METRICS_SQL, metrics, table
from sparkloom.plans.registry import query


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics, linear score, Wilson bound and bucket of every document, best first."""
    m = metrics(spark, sf_dir).withColumn("score", S.linear_score()).withColumn("wilson", S.wilson_uniform())
    bucket = F.when(F.col("score") >= 0.7, "high").when(F.col("score") >= 0.4, "medium").otherwise("low")
    return m.withColumn("bucket", bucket).orderBy(F.desc("score"), "doc_id")


def _metric(name: str):
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        return metrics(spark, sf_dir).select("doc_id", F.round(name, 9).alias(name))

    f.__name__ = {"citation_quality": "metric_citation", "writing_quality": "metric_writing", "content_depth": "metric_depth", "methodology_transparency": "metric_methodology", "specificity": "metric_specificity", "source_reputation": "metric_reputation", "structural_integrity": "metric_structure"}[name]
    query(METRICS_SQL + f"SELECT doc_id, round({name}, 9) AS {name} FROM m")(f)


for _name in METRICS:
    _metric(_name)

_ROUNDED = ", ".join(f"round({k}, 9) AS {k}" for k in METRICS)


@query(METRICS_SQL + f"SELECT doc_id, {_ROUNDED} FROM m")
def raw_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("doc_id", *(F.round(k, 9).alias(k) for k in METRICS))


@query(METRICS_SQL + f"SELECT doc_id, round({LINEAR_SQL}, 9) AS score FROM m")
def score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("doc_id", F.round(S.linear_score(), 9).alias("score"))


_MEAN = "(" + " + ".join(f"{k} * {w}e0" for k, w in S.WEIGHTS.items()) + f") / {sum(S.WEIGHTS.values())!r}::DOUBLE"


@query(METRICS_SQL + f"SELECT doc_id, round(1 / (1 + exp(-1e1 * ({_MEAN} - 5e-1))), 9) AS score FROM m")
def score_sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("doc_id", F.round(S.sigmoid_score(), 9).alias("score"))


def _wilson_sql(positive: str, clamp: bool) -> str:
    bound = "(p + 3.8416e0 / 14 - 1.96e0 * sqrt((p * (1 - p) + 3.8416e0 / 28) / 7)) / (1 + 3.8416e0 / 7)"
    bound = f"least(greatest({bound}, 0e0), 1e0)" if clamp else bound
    return METRICS_SQL + f", q AS (SELECT doc_id, ({positive}) / 7e0 AS p FROM m) SELECT doc_id, round({bound}, 9) AS wilson FROM q"


@query(_wilson_sql(" + ".join(f"({k} > 5e-1)::INT" for k in METRICS), True))
def wilson_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("doc_id", F.round(S.wilson_uniform(), 9).alias("wilson"))


@query(_wilson_sql(" + ".join(f"({k} > {t}e0)::INT" for k, t in S.THRESHOLDS.items()), False))
def wilson_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("doc_id", F.round(S.wilson_thresholds(), 9).alias("wilson"))


@query(METRICS_SQL + f""", h AS (SELECT doc_id, doc_id > min(doc_id) OVER (PARTITION BY md5(text)) AS dup FROM documents)
SELECT decision, count(*) AS n_docs FROM (SELECT CASE WHEN dup THEN 'duplicate' WHEN round({LINEAR_SQL}, 9) < 4.5e-1 THEN 'quality_rejected' ELSE 'accepted' END AS decision FROM m JOIN h USING (doc_id)) GROUP BY 1""")
def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.plans.frames import status

    m = metrics(spark, sf_dir).select("doc_id", F.round(S.linear_score(), 9).alias("score"))
    gone = status(table(spark, sf_dir, "documents")).withColumn("dup", F.lit(True))
    decided = m.join(gone, "doc_id", "left").select(S.acceptance(F.coalesce("dup", F.lit(False)), F.col("score"), 0.45).alias("decision"))
    return decided.groupBy("decision").agg(F.count("*").alias("n_docs"))


_THOUSANDTHS = " || ',' || ".join(f"""'"{k}":' || floor((round({k}, 9) + 1e-7) * 1e3)::BIGINT::VARCHAR""" for k in METRICS)


@query(METRICS_SQL + f", j AS (SELECT doc_id, '{{' || {_THOUSANDTHS} || '}}' AS metrics_json FROM m) SELECT doc_id, metrics_json, (metrics_json::JSON->>'writing_quality')::BIGINT AS writing, len(json_keys(metrics_json::JSON)) AS n_metrics FROM j")
def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics in thousandths as JSON text, and read back."""
    pairs = [x for k in METRICS for x in (F.lit(k), F.floor((F.round(k, 9) + 1e-7) * 1000).cast("long"))]
    rows = metrics(spark, sf_dir).withColumn("metrics_json", F.to_json(F.create_map(*pairs)))
    back = rows.withColumn("m", F.from_json("metrics_json", "map<string,bigint>"))
    return back.select("doc_id", "metrics_json", F.col("m")["writing_quality"].alias("writing"), F.size("m").cast("long").alias("n_metrics"))


@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS t, len(list_filter(string_split_regex(text, '[.!?]+'), lambda x: length(trim(x, ' ')) > 0)) AS s FROM documents)
SELECT doc_id, len(t) AS n_words, len(list_distinct(t)) AS n_distinct, s AS n_sentences, md5(array_to_string(t, ' ')) AS words_md5 FROM w""")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("t", T.tokens(F.col("text")))
    return docs.select("doc_id", F.size("t").cast("long").alias("n_words"), F.size(F.array_distinct("t")).cast("long").alias("n_distinct"), F.size(T.sentences(F.col("text"))).cast("long").alias("n_sentences"), F.md5(F.array_join("t", " ")).alias("words_md5"))


@query(r"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g') AS t, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS n FROM documents),
b AS (SELECT *, string_split(t, ' ') AS w FROM a), c AS (SELECT *, CASE WHEN len(w) > 20 THEN array_to_string(w[1:20], ' ') ELSE t END AS cut FROM b)
SELECT doc_id, CASE WHEN n < 50 THEN NULL WHEN length(cut) < length(t) AND cut NOT LIKE '%...' THEN regexp_replace(cut, '[.,;:!?]+$', '') || '...' ELSE cut END AS excerpt FROM c""")
def excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.excerpt(F.col("text"), 20).alias("excerpt"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), t AS (SELECT doc_id, regexp_replace(line, '^\s+|\s+$', '', 'g') AS x FROM l)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (length(x) < 30 OR (upper(x) = x AND lower(x) <> x) OR x LIKE '%:' OR regexp_matches(x, '^[\d•\-*#.)]+\s')) AS n_headers FROM t GROUP BY doc_id""")
def header_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("x"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(T.header_like(F.col("x"))).alias("n_headers"))


@query(r"""SELECT doc_id, md5(coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g'), '')) AS shown_md5 FROM documents""")
def display_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.display_text(F.col("text"))).alias("shown_md5"))


@query(dialect.clean_sql())
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine cleaning steps."""
    docs = table(spark, sf_dir, "documents").withColumn("clean", T.clean_text(T.content_text(F.col("text"))))
    return docs.select("doc_id", F.length("clean").cast("long").alias("n_chars_clean"), F.md5("clean").alias("clean_md5"))


@query(dialect.summary_sql())
def summary_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_summary(F.substring("text", 1, 2000)).alias("summary"))


@query(rf"""SELECT coalesce(CASE WHEN length(text) < 100 THEN 'too_short' WHEN regexp_matches(substring(text, 1, 1000), '(?i)(?:{T.SPAM})') THEN 'spam_detected' END, 'passed') AS reason, count(*) AS n_docs FROM documents GROUP BY 1""")
def content_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.coalesce(T.content_reason(F.col("text")), F.lit("passed")).alias("reason")).agg(F.count("*").alias("n_docs"))


@query(r"""WITH a AS (SELECT doc_id, text, list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')[1:100]) AS w FROM documents)
SELECT doc_id, length(text) < 50 OR len(list_filter(w, lambda x: x IN ('the', 'and', 'is', 'it', 'to', 'of', 'a', 'in', 'that'))) / greatest(len(w), 1)::DOUBLE > 1e-1 AS english FROM a""")
def lang_heuristic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.english_like(F.col("text")).alias("english"))


@query("SELECT doc_id, md5(text) AS content_hash, sha256(text) AS text_sha256 FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("content_hash"), F.sha2("text", 256).alias("text_sha256"))


@query("SELECT doc_id, CASE WHEN quality = 1 THEN 5 ELSE 1 END AS label FROM labels")
def label_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("quality") == 1, F.lit(" Exemplary ")).otherwise(F.lit("1"))
    return table(spark, sf_dir, "labels").select("doc_id", S.golden_label(raw).alias("label"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows over events, as the streaming query has them."""
    from sparkloom.streaming.ingest import windowed_events

    return windowed_events(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query("""WITH a AS (SELECT event_id, ts, greatest(floor(value * 100), 0)::BIGINT AS s FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y/%m/%d') AS folder,
  CASE WHEN s // 3600 < 10 THEN '0' ELSE '' END || (s // 3600) || ':' || lpad((s // 60 % 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS duration FROM a""")
def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text, day folder and a duration of each event; its value stands for hundredths of seconds."""
    from sparkloom.functions import dates as W

    return table(spark, sf_dir, "events").select("event_id", W.iso(F.col("ts")).alias("iso"), W.day_folder(F.col("ts")).alias("folder"), W.duration(F.floor(F.col("value") * 100)).alias("duration"))
