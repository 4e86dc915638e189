"""Corpus statistics: distributions, Gini, coverage, alerts, agreement measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.config import DEFAULTS, Config


def distribution(df: DataFrame, column: str, out: str = "n_docs") -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(column).agg(F.count("*").alias(out))


def gini(counts: DataFrame, column: str = "n_docs", out: str = "gini") -> DataFrame:
    """One row: the Gini coefficient of the counts, 0 for none or only zeros.

    Equal counts are one row with a multiplicity, so the ranking handles as many
    rows as there are different counts, not groups.
    """
    by = counts.groupBy(F.col(column).alias("c")).agg(F.count("*").alias("m"))
    w = Window.orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    ranked = by.withColumn("before", F.coalesce(F.sum("m").over(w), F.lit(0)))
    # Ranks before+1 .. before+m: the sum of 2i - n - 1 over them is m(2 before + m - n).
    n = F.sum("m").over(Window.partitionBy())
    parts = ranked.withColumn("part", F.col("m") * (2 * F.col("before") + F.col("m") - n) * F.col("c")).withColumn("n", n)
    one = parts.agg(F.sum("part").alias("s"), F.max("n").alias("n"), F.sum(F.col("c") * F.col("m")).alias("total"))
    return one.select(F.when(F.col("total") > 0, F.col("s") / (F.col("n") * F.col("total"))).otherwise(0.0).alias(out))


def cluster_stats(docs: DataFrame) -> DataFrame:
    """Size and quality of each cluster of active documents; cluster -1 is orphaned."""
    g = docs.where("status = 'active'").groupBy("cluster_id").agg(F.count("*").alias("n_docs"), F.avg("quality_score").alias("avg_quality"), F.min("quality_score").alias("min_quality"), F.max("quality_score").alias("max_quality"))
    return g.withColumn("is_orphaned", F.coalesce(F.col("cluster_id") == -1, F.lit(False)))


def quality_buckets(docs: DataFrame) -> DataFrame:
    q = F.col("quality_score")
    return docs.where("status = 'active'").agg(F.count_if(q >= 0.7).alias("high"), F.count_if((q >= 0.4) & (q < 0.7)).alias("medium"), F.count_if(q < 0.4).alias("low"))


def cluster_count(docs: DataFrame) -> DataFrame:
    return docs.where("status = 'active' and cluster_id <> -1").agg(F.count_distinct("cluster_id").alias("n_clusters"))


def corpus_stats(docs: DataFrame) -> DataFrame:
    active = docs.where("status = 'active'")
    return active.agg(F.count("*").alias("n_docs"), F.count_distinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))).alias("n_clusters"), F.avg("quality_score").alias("avg_quality"), F.count_if(F.col("has_vector")).alias("n_vectors"))


def coverage(docs: DataFrame, topic: str = "content_type", domain: str = "domain", scored: DataFrame | None = None) -> DataFrame:
    """One row of coverage metrics over all documents, whatever their status; the
    null cluster counts as a cluster.

    ``scored`` has cluster_id and quality_score where scores cost work; ``docs``
    then needs none. Documents are counted once, by topic, domain and cluster.
    """
    scored = docs if scored is None else scored
    cells = docs.groupBy(topic, domain, "cluster_id").agg(F.count("*").alias("n"))
    clusters = cells.groupBy("cluster_id").agg(F.sum("n").alias("n"))
    whole = clusters.agg(F.sum("n").alias("total"), F.count_if(~F.col("cluster_id").eqNullSafe(-1)).alias("cluster_count"), F.max(F.when(~F.col("cluster_id").eqNullSafe(-1), F.col("n"))).alias("largest"), F.sum(F.when(F.col("cluster_id") == -1, F.col("n")).otherwise(0)).alias("orphans"))
    high = scored.where("cluster_id = -1").agg(F.count_if(F.col("quality_score") > 0.7).alias("high_quality_orphans"))
    total = F.greatest(F.coalesce("total", F.lit(0)), F.lit(1))
    by = lambda column: cells.groupBy(column).agg(F.sum("n").alias("n_docs"))
    # Four tables of one row each.
    one = gini(by(topic), out="topic_gini").crossJoin(gini(by(domain), out="domain_gini")).crossJoin(whole).crossJoin(high)
    return one.select("topic_gini", "domain_gini", (F.coalesce("orphans", F.lit(0)) / total).alias("orphan_rate"), "high_quality_orphans", "cluster_count", (F.coalesce("largest", F.lit(0)) / total).alias("largest_cluster_pct"))


def alerts(metrics: DataFrame, config: Config = DEFAULTS) -> DataFrame:
    """A row per alert of a coverage row."""
    found = F.array(
        F.when(F.col("topic_gini") > config.gini_threshold, "topic_gini"),
        F.when(F.col("domain_gini") > config.gini_threshold, "domain_gini"),
        F.when(F.col("high_quality_orphans") > config.orphan_threshold, "high_quality_orphans"),
        F.when(F.col("orphan_rate") > config.orphan_rate_threshold, "orphan_rate"),
    )
    return metrics.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("alert"))


def qadi(truth: Column, predicted: Column) -> list[Column]:
    """Aggregates of the 2x2 agreement measure: quantity, allocation and qadi; 0 for no rows."""
    n = F.count("*")
    rows1, cols1, diag = F.sum(truth.cast("int")), F.sum(predicted.cast("int")), F.sum((truth == predicted).cast("int"))
    size = F.greatest(n, F.lit(1))
    q = F.coalesce(F.abs(rows1 - cols1) * 2 / (2 * size), F.lit(0.0))
    a = F.coalesce((n - diag) / size, F.lit(0.0)) - q
    return [q.alias("quantity"), a.alias("allocation"), F.sqrt(q * q + a * a).alias("qadi")]


def separation(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Mean score of exemplary (4 and over) and garbage (2 and under) rows, and whether they are apart."""
    x = scored.agg(F.avg(F.when(F.col(label) >= 4, F.col(score))).alias("exemplary"), F.avg(F.when(F.col(label) <= 2, F.col(score))).alias("garbage"))
    return x.withColumn("separated", F.col("exemplary") > F.col("garbage"))


def cluster_profile(docs: DataFrame, domain: str = "domain", farm_share: float = 0.8, farm_quality: float = 0.4, authority_quality: float = 0.7) -> DataFrame:
    """Quality and domain concentration of each cluster; content farms are of one
    domain and low quality, authorities of high and even quality."""
    by = docs.where("cluster_id is not null").groupBy("cluster_id", domain).agg(F.count("*").alias("n"), F.sum("quality_score").alias("s"), F.sum(F.col("quality_score") * F.col("quality_score")).alias("s2"))
    g = by.groupBy("cluster_id").agg(F.sum("n").alias("n_docs"), F.sum("s").alias("s"), F.sum("s2").alias("s2"), F.max("n").alias("top"))
    g = g.withColumn("avg_quality", F.col("s") / F.col("n_docs"))
    var = F.greatest(F.col("s2") / F.col("n_docs") - F.col("avg_quality") * F.col("avg_quality"), F.lit(0.0))
    g = g.withColumn("quality_std", F.sqrt(var)).withColumn("domain_concentration", F.col("top") / F.col("n_docs"))
    farm = (F.col("domain_concentration") >= farm_share) & (F.col("avg_quality") < farm_quality)
    return g.select("cluster_id", "n_docs", "avg_quality", "quality_std", "domain_concentration", farm.alias("is_content_farm"), (F.col("avg_quality") >= authority_quality).alias("is_authority"))
