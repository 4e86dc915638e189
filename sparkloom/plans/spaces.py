"""Queries on vectors, the hypergraph and the map. Searches take the rows whose id
is divisible by 100 as queries, against all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import catalog as C
from sparkloom.operators import graph as G
from sparkloom.operators import mapping as P
from sparkloom.operators import vectors as V
from sparkloom.plans.frames import docs_view, table
from sparkloom.plans.registry import query

_V = "WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), q AS (SELECT * FROM v WHERE vec_id % 100 = 0)"


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


@query(_V + " SELECT v.vec_id, round(list_cosine_similarity(v.v, q.v), 6) AS score FROM v, q WHERE q.vec_id = 0 ORDER BY list_cosine_similarity(v.v, q.v) DESC, v.vec_id LIMIT 10")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _embeddings(spark, sf_dir)
    one = vectors.where("vec_id = 0").select("embedding").first()[0]
    return C.top_k(vectors, one, 10).withColumn("score", F.round("score", 6))


@query(_V + ", r AS (SELECT q.vec_id AS query, v.vec_id AS neighbour, list_cosine_similarity(v.v, q.v) AS s, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(v.v, q.v) DESC, v.vec_id) AS rn FROM q JOIN v ON q.vec_id <> v.vec_id) SELECT query, neighbour, round(s, 6) AS similarity FROM r WHERE rn <= 5")
def cosine_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _embeddings(spark, sf_dir)
    near = V.knn(vectors.where("vec_id % 100 = 0"), vectors, 5, euclidean=False)
    return near.select("query", "neighbour", F.round(1 - F.col("distance"), 6).alias("similarity"))


@query(_V + ", h AS (SELECT v.vec_id, list_cosine_similarity(v.v, q.v) AS s FROM v, q WHERE q.vec_id = 0), t AS (SELECT * FROM h ORDER BY s DESC, vec_id LIMIT 20) SELECT t.vec_id, round(t.s, 6) AS score, d.source FROM t JOIN documents d ON d.doc_id = t.vec_id")
def similar_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _embeddings(spark, sf_dir)
    one = vectors.where("vec_id = 0").select("embedding").first()[0]
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source")
    return C.top_k(vectors, one, 20).join(docs, "vec_id").select("vec_id", F.round("score", 6).alias("score"), "source")


_NEAR = _V + ", r AS (SELECT q.vec_id, list_distance(v.v, q.v) AS d, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(v.v, q.v), v.vec_id) AS rn FROM q JOIN v ON q.vec_id <> v.vec_id)"


@query(_NEAR + " SELECT vec_id, round(avg(d), 6) AS gap FROM r WHERE rn <= 5 GROUP BY 1")
def gap_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _embeddings(spark, sf_dir)
    return V.gap_scores(vectors.where("vec_id % 100 = 0"), vectors).withColumn("gap", F.round("gap", 6))


@query(_NEAR + " SELECT vec_id AS query, round(d, 6) AS distance FROM r WHERE rn = 1 AND d > 2e-1 ORDER BY round(d, 9) DESC, vec_id LIMIT 10")
def lonely_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _embeddings(spark, sf_dir)
    return V.lonely(vectors.where("vec_id % 100 = 0"), vectors).select("query", F.round("distance", 6).alias("distance"))


_EDGES = "WITH e AS (SELECT doc_id, 'domain' AS kind, source AS label, 1e0 AS weight FROM documents UNION ALL SELECT doc_id, 'topic', lang, 1e0 FROM documents UNION ALL SELECT doc_id, 'size', (n_chars // 1000)::VARCHAR, 1e0 FROM documents WHERE n_chars < 20000)"


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("n_chars") < 20_000, F.floor(F.col("n_chars") / 1000))
    return G.edges(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars"), {"domain": F.col("source"), "topic": F.col("lang"), "size": size})


@query(_EDGES + " SELECT doc_id, kind, label, weight FROM e")
def hypergraph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


@query(_EDGES + " SELECT doc_id, sum(CASE WHEN kind = 'topic' AND label = 'de' THEN 2e0 WHEN kind = 'domain' AND label = 'src3' THEN 1.5e0 END) AS score FROM e WHERE (kind = 'topic' AND label = 'de') OR (kind = 'domain' AND label = 'src3') GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 10")
def hypergraph_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.query(_edges(spark, sf_dir), {("topic", "de"): 2.0, ("domain", "src3"): 1.5})


@query(_EDGES + ", s AS (SELECT a.doc_id, b.doc_id AS other, sum(a.weight * b.weight) AS score FROM e a JOIN e b USING (kind, label) WHERE a.doc_id % 100 = 0 AND a.doc_id <> b.doc_id GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, other) AS rn FROM s) SELECT doc_id, other, score FROM r WHERE rn <= 5")
def related_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    return G.related(e, e.where("doc_id % 100 = 0").select("doc_id").distinct())


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embeddings(spark, sf_dir).select("vec_id", "embedding", ((F.col("vec_id") * 37 % 101) / 101).alias("quality"))


def _greedy_sql(k: int) -> str:
    """The sample of fps_batch, a step of the greedy choice at a time."""
    steps = [
        _V + ", s0 AS MATERIALIZED (SELECT vec_id, v, (vec_id * 37 % 101) / 101e0 AS q, NULL::DOUBLE AS d FROM v)",
        "p0 AS MATERIALIZED (SELECT vec_id, v, 0 AS rank, 1e0 AS novelty FROM s0 ORDER BY q DESC, vec_id LIMIT 1)",
    ]
    for i in range(1, k):
        steps.append(f"s{i} AS MATERIALIZED (SELECT s.vec_id, s.v, s.q, least(coalesce(s.d, 9e0), 1 - list_cosine_similarity(s.v, p.v)) AS d FROM s{i - 1} s, p{i - 1} p WHERE s.vec_id <> p.vec_id)")
        steps.append(f"p{i} AS MATERIALIZED (SELECT vec_id, v, {i} AS rank, d AS novelty FROM s{i} ORDER BY round(d * greatest(q, 1e-2), 12) DESC, vec_id LIMIT 1)")
    return ", ".join(steps) + " ".join(f"{' UNION ALL' if i else ''} SELECT vec_id, rank::BIGINT AS rank, round(novelty, 6) AS novelty FROM p{i}" for i in range(k))


@query(_greedy_sql(25))
def fps_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.fps_sample(_quality(spark, sf_dir), 25).withColumn("novelty", F.round("novelty", 6))


def _farthest_sql(k: int) -> str:
    """The sample of fps_tensor, a step at a time."""
    steps = [
        _V + ", s0 AS MATERIALIZED (SELECT vec_id, v, (vec_id * 37 % 101) / 101e0 AS q, NULL::DOUBLE AS d FROM v)",
        "p0 AS MATERIALIZED (SELECT vec_id, v, 0 AS rank FROM s0 ORDER BY q DESC, vec_id LIMIT 1)",
    ]
    for i in range(1, k):
        steps.append(f"s{i} AS MATERIALIZED (SELECT s.vec_id, s.v, s.q, least(coalesce(s.d, 1e9), list_distance(s.v, p.v)) AS d FROM s{i - 1} s, p{i - 1} p WHERE s.vec_id <> p.vec_id)")
        steps.append(f"p{i} AS MATERIALIZED (SELECT vec_id, v, {i} AS rank FROM s{i} ORDER BY round(d * q, 12) DESC, vec_id LIMIT 1)")
    return ", ".join(steps) + " ".join(f"{' UNION ALL' if i else ''} SELECT rank::BIGINT AS rank, vec_id FROM p{i}" for i in range(k))


@query(_farthest_sql(25))
def fps_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 points by Euclidean distance times quality."""
    return V.fps_sample(_quality(spark, sf_dir), 25, euclidean=True).select("rank", "vec_id")


@query()
def project_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.PcaProjector().project(_embeddings(spark, sf_dir)).select("vec_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query()
def cluster_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.DensityClusterer().cluster(P.PcaProjector().project(_embeddings(spark, sf_dir))).select("vec_id", "cluster_id")


@query()
def mapping_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = docs_view(spark, sf_dir)
    known = _embeddings(spark, sf_dir).join(docs.select(F.col("id").alias("vec_id")), "vec_id", "left_semi")
    return P.mapped(known, docs.select("id", "domain", "quality_score", "content_type"))


@query("SELECT count(*) AS n_docs, count(DISTINCT label) FILTER (label <> 0) AS n_clusters, count(*) FILTER (label = 0) AS n_orphans FROM embeddings")
def mapping_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = _embeddings(spark, sf_dir).withColumn("cluster_id", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    return P.mapping_stats(noisy)
