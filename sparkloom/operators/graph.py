"""The document hypergraph as an edge table (doc_id, kind, label, weight)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def edges(df: DataFrame, labels: dict[str, Column], key: str = "doc_id", weight: Column | None = None) -> DataFrame:
    """An edge per row and kind of label; repeated edges add up, null labels give none."""
    weight = F.lit(1.0) if weight is None else weight
    pairs = F.array(*(F.struct(F.lit(kind).alias("kind"), column.cast("string").alias("label")) for kind, column in labels.items()))
    rows = df.select(F.col(key).alias("doc_id"), F.explode(pairs).alias("e"), weight.alias("weight"))
    return rows.where("e.label is not null").groupBy("doc_id", "e.kind", "e.label").agg(F.sum("weight").alias("weight"))


def date_edges(df: DataFrame, when: Column, key: str = "doc_id", unit: str = "month") -> DataFrame:
    """An edge of kind "date" per row with a date: its bin of ``unit``, as ISO text.
    The one-hot matrix of binned dates, without its zeros."""
    return edges(df, {"date": F.date_format(F.date_trunc(unit, when), "yyyy-MM-dd'T'HH:mm:ss")}, key)


def dense_edges(df: DataFrame, vector: str = "embedding", key: str = "doc_id", kind: str = "embedding") -> DataFrame:
    """An edge per entry of a vector that is not zero: its place is the label, its value the weight."""
    rows = df.select(F.col(key).alias("doc_id"), F.posexplode(vector).alias("at", "weight")).where("weight <> 0")
    return rows.select("doc_id", F.lit(kind).alias("kind"), F.col("at").cast("string").alias("label"), F.col("weight").cast("double").alias("weight"))


def hypergraph(docs: DataFrame, *parts: DataFrame, key: str = "doc_id") -> DataFrame:
    """The edges of all parts together. An edge of a document that is not in ``docs``
    raises when it is read."""
    known = docs.select(F.col(key).alias("doc_id"), F.lit(True).alias("_known")).distinct()
    every = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "kind", "label").agg(F.sum("weight").alias("weight"))
    held = every.join(known, "doc_id", "left")
    stop = F.raise_error(F.concat(F.lit("no document "), F.col("doc_id").cast("string"))).cast("bigint")
    return held.withColumn("doc_id", F.when(F.col("_known"), F.col("doc_id")).otherwise(stop)).drop("_known")


def query(edges: DataFrame, wanted: dict[tuple[str, str], float], k: int = 10) -> DataFrame:
    """The ``k`` documents of largest summed weight over the wanted (kind, label) pairs."""
    if not wanted:
        raise ValueError("the query has no labels")
    hits = reduce(lambda w, x: w.when((F.col("kind") == x[0][0]) & (F.col("label") == x[0][1]), x[1]), wanted.items(), F.when(F.lit(False), 0.0))
    return edges.withColumn("_w", hits).where("_w is not null").groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("_w")).alias("score")).orderBy(F.desc("score"), "doc_id").limit(k)


def related(edges: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, other, score: the ``k`` documents that share most with each query document.

    A document's row of the incidence matrix times its transpose, for the query
    set only. Documents with the same labels and weights are one profile, so
    profiles meet in the join, not documents; of each profile only the k + 1
    smallest ids can be among the best of anyone. Ties go to the smaller id.
    """
    rows = edges.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("kind", "label", "weight"))).alias("own"))  # the labels of one document
    rows = rows.withColumns({"a": F.xxhash64("own"), "b": F.xxhash64(F.lit(1), "own")})
    profiles = rows.groupBy("a", "b").agg(F.first("own").alias("own"))
    first = rows.select("a", "b", "doc_id").withColumn("rn", F.row_number().over(Window.partitionBy("a", "b").orderBy("doc_id"))).where(F.col("rn") <= k + 1)
    asked = rows.join(queries.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "a", "b")
    wanted = profiles.join(asked.select("a", "b").distinct(), ["a", "b"], "left_semi").select(F.col("a").alias("qa"), F.col("b").alias("qb"), F.explode("own").alias("q"))
    others = profiles.select("a", "b", F.explode("own").alias("o"))
    met = wanted.join(others, (F.col("q.kind") == F.col("o.kind")) & (F.col("q.label") == F.col("o.label")))
    scores = met.groupBy("qa", "qb", "a", "b").agg(F.sum(F.col("q.weight") * F.col("o.weight")).alias("score"))
    order = Window.partitionBy("qa", "qb").orderBy(F.desc("score"), "other")
    best = scores.join(first.select("a", "b", F.col("doc_id").alias("other")), ["a", "b"]).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k + 1)
    best = best.select(F.col("qa").alias("a"), F.col("qb").alias("b"), "other", "score")
    found = asked.join(best, ["a", "b"]).where("doc_id <> other")
    last = Window.partitionBy("doc_id").orderBy(F.desc("score"), "other")
    return found.withColumn("rn", F.row_number().over(last)).where(F.col("rn") <= k).select("doc_id", "other", "score")
