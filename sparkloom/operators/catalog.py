"""The catalog: filtered lists, counts, lookups, search, joins and the facade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import dedup, monitor
from sparkloom.store import reused

SORTABLE = ("quality_score", "wilson_score", "importance_score", "content_length", "cluster_id", "id", "title", "domain", "created_at")
#: Columns of each fixed view of a document: its page, a row of a list, an export, what the map needs, its score.
VIEWS = {
    "detail": ("id", "url", "title", "summary", "domain", "content_type", "quality_score", "wilson_score", "importance_score", "cluster_id", "created_at"),
    "list": ("id", "url", "title", "domain", "content_type", "quality_score", "wilson_score", "importance_score", "cluster_id", "created_at"),
    "export": ("url", "title", "summary", "domain", "content_type"),
    "map": ("domain", "quality_score", "content_type"),
    "score": ("quality_score",),
}


def view(docs: DataFrame, kind: str = "detail") -> DataFrame:
    """A fixed view of documents; columns that ``docs`` lacks are null. The list
    holds active documents only."""
    rows = docs.where("status = 'active'") if kind == "list" else docs
    return rows.select(*(F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in VIEWS[kind]))


def filtered(docs: DataFrame, content_type: str | None = None, min_quality: float | None = None, cluster_id: int | None = None) -> DataFrame:
    """Active documents that meet every given condition."""
    docs = docs.where("status = 'active'")
    if content_type is not None:
        docs = docs.where(F.col("content_type") == content_type)
    if min_quality is not None:
        docs = docs.where(F.col("quality_score") >= min_quality)
    if cluster_id is not None:
        docs = docs.where(F.col("cluster_id") == cluster_id)
    return docs


def ordered(docs: DataFrame, by: str = "quality_score", descending: bool = True) -> DataFrame:
    """In the order of a whitelisted column, nulls lowest, ids for ties."""
    if by not in SORTABLE:
        raise ValueError(f"cannot order by {by}")
    return docs.orderBy(F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first(), "id")


def page(docs: DataFrame, limit: int = 50, offset: int = 0, by: str = "quality_score", descending: bool = True, **conditions) -> DataFrame:
    return ordered(filtered(docs, **conditions), by, descending).offset(offset).limit(limit)


def total(docs: DataFrame, **conditions) -> DataFrame:
    return filtered(docs, **conditions).agg(F.count("*").alias("total"))


def by_id(docs: DataFrame, key) -> DataFrame:
    return docs.where(F.col("id") == key)


def by_ids(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(keys, "id", "left_semi")


def search_text(docs: DataFrame, q: str, limit: int = 20) -> DataFrame:
    """Active documents with ``q`` in title or domain, whatever its case; % and _ match as in LIKE."""
    if not q:
        raise ValueError("q is required")
    pattern = f"%{q}%"
    return ordered(docs.where("status = 'active'").where(F.col("title").ilike(pattern) | F.col("domain").ilike(pattern))).limit(limit)


def search_fulltext(docs: DataFrame, q: str, limit: int = 20, offset: int = 0, where: Column | None = None) -> DataFrame:
    """Documents by the number of query words they hold, then by the summed rarity
    of these words, with the total of hits on each row."""
    words = sorted(set(q.lower().split()))
    if not words:
        raise ValueError("q is required")
    base = docs if where is None else docs.where(where)
    found = F.array_intersect(F.array_distinct(T.tokens(F.concat_ws(" ", "title", "text"))), F.array(*map(F.lit, words)))
    # Texts are read once; what follows depends on each document's set of words only.
    hits = reused(base.select("id", F.array_sort(found).alias("words")).where(F.size("words") > 0))
    sets = hits.groupBy("words").agg(F.count("*").alias("n"))
    each = sets.select("words", "n", F.explode("words").alias("word"))
    rarity = each.groupBy("word").agg(F.sum("n").alias("df")).crossJoin(base.agg(F.count("*").alias("n_all")))  # one row per query word
    rarity = rarity.select("word", F.ln((F.col("n_all") + 1) / (F.col("df") + 1)).alias("idf"))
    ranks = each.join(F.broadcast(rarity), "word").groupBy("words").agg(F.count("*").alias("matched"), F.sum("idf").alias("rank"))
    ranked = hits.join(ranks, "words").select("id", "matched", "rank")
    total = sets.agg(F.sum("n").alias("total_hits"))
    return ranked.orderBy(F.desc("matched"), F.desc(F.round("rank", 9)), "id").offset(offset).limit(limit).crossJoin(total)


def unscored(docs: DataFrame, texts: DataFrame, limit: int | None = None) -> DataFrame:
    """Texts of the documents whose scoring is pending, in the order of ids."""
    out = texts.join(docs.where("quality_profile_used = 'pending'").select("id"), "id")
    return out if limit is None else out.orderBy("id").limit(limit)


def enriched(mapping: DataFrame, docs: DataFrame, columns: tuple[str, ...] = ("title", "domain", "content_type"), key: str = "id") -> DataFrame:
    """``mapping`` with blank fields filled from the documents."""
    other = docs.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = mapping.join(other, key, "left")
    return joined.withColumns({c: F.coalesce(F.when(F.trim(F.col(c)) != "", F.col(c)), F.col(f"_{c}")) for c in columns}).drop(*(f"_{c}" for c in columns))


def missing(new: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Rows of ``new`` whose key is not known yet."""
    return new.join(known.select(on), on, "left_anti")


def backfill(archive: DataFrame, docs: DataFrame, texts: DataFrame, key: str = "id", order: str = "position") -> DataFrame:
    """The first archived text of each document that exists and has no text yet."""
    wanted = docs.select(key).join(texts.select(key), key, "left_anti")
    rows = archive.where(F.col(key).isNotNull() & F.col("text").isNotNull()).join(wanted, key, "left_semi")
    return rows.groupBy(key).agg(F.min_by("text", order).alias("text"))


def search_view(docs: DataFrame) -> DataFrame:
    """What the search index holds of active documents, without nulls."""
    return docs.where("status = 'active'").select("id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("content_type", F.lit("unscored")).alias("content_type"), F.coalesce("quality_score", F.lit(0.0)).alias("quality_score"), F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))


class Store:
    """The query surface over a documents frame and a vectors frame (vec_id, embedding)."""

    def __init__(self, docs: DataFrame, vectors: DataFrame | None = None):
        self.docs, self.vectors = docs, vectors

    def stats(self) -> DataFrame:
        return monitor.corpus_stats(self.docs)

    def documents(self, limit: int = 50, offset: int = 0, **conditions) -> tuple[DataFrame, DataFrame]:
        return page(self.docs, limit, offset, **conditions), total(self.docs, **conditions)

    def document(self, key) -> dict:
        row = by_id(self.docs, key).first()
        if row is None:
            raise KeyError(key)
        return row.asDict()

    def clusters(self) -> DataFrame:
        return monitor.cluster_stats(self.docs).orderBy(F.desc("n_docs"), "cluster_id")

    def cluster(self, cluster_id: int) -> DataFrame:
        return page(self.docs, cluster_id=cluster_id)

    def search(self, q: str, limit: int = 20) -> DataFrame:
        return search_text(self.docs, q, limit)

    def search_fulltext(self, q: str, limit: int = 20, offset: int = 0) -> DataFrame:
        return search_fulltext(self.docs, q, limit, offset)

    def similar(self, vector: list[float], limit: int = 10, min_score: float = 0.0) -> DataFrame:
        """The documents of the ``limit`` closest vectors; hits without a document drop out."""
        hits = top_k(self.vectors, vector, limit, min_score)
        return hits.join(self.docs, hits["vec_id"] == self.docs["id"]).drop("vec_id")

    def mappings(self, mapping: DataFrame, min_quality: float | None = None) -> DataFrame:
        out = enriched(mapping, self.docs)
        return out.where(F.col("quality_score") >= min_quality) if min_quality else out


def top_k(vectors: DataFrame, query: list[float], k: int = 10, min_score: float | None = None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and cosine score of the ``k`` closest vectors, then those over ``min_score``."""
    q = dedup.unit(F.array(*(F.lit(float(x)) for x in query)))
    best = vectors.select(key, dedup.dot(dedup.unit(F.col(vector)), q).alias("score")).orderBy(F.desc("score"), key).limit(k)
    return best if min_score is None else best.where(F.col("score") >= min_score)
