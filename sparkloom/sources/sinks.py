"""Writers: first-wins inserts, upserts, updates, archives, exports with a manifest.

A table is a frame before and a frame after; the caller writes the new snapshot.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators.dedup import first_per_key


def insert_ignore(existing: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("id", "url"), order: str | None = None) -> DataFrame:
    """The rows of ``new`` to append: of each key the first to arrive, none of whose
    keys exist. ``order`` is the arrival; without it the rows' order in ``new``, which
    holds for files that are read in their order. Rows are taken by the first key,
    then by the next, as each row is offered whole."""
    names = new.columns
    rows = new.withColumn("_at", F.monotonically_increasing_id() if order is None else F.col(order))
    for key in keys:
        rows = first_per_key(rows, F.col(key), F.struct("_at", *(F.col(k) for k in keys))).join(existing.select(key), key, "left_anti").select(*names, "_at")
    return rows.select(*names)


def upsert(existing: DataFrame, new: DataFrame, key: str, updated: tuple[str, ...]) -> DataFrame:
    """All rows after an upsert: ``updated`` columns from new rows, the others as they were."""
    other = new.select(*(F.col(c).alias(f"_{c}") for c in new.columns))
    joined = existing.join(other, existing[key] == other[f"_{key}"], "full_outer")
    hit = F.col(f"_{key}").isNotNull()
    return joined.select(*(F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in updated or c == key else F.coalesce(F.col(c), F.col(f"_{c}") if c in new.columns else F.lit(None)).alias(c) for c in existing.columns))


def replace(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows after whole rows were replaced by key."""
    return existing.join(new.select(key), key, "left_anti").select(*existing.columns).unionByName(new.select(*existing.columns))


def update(existing: DataFrame, changes: DataFrame, key: str, with_nulls: bool = False) -> DataFrame:
    """All rows with the changes' values, where they are not null; with ``with_nulls``
    a null is a value too."""
    columns = [c for c in changes.columns if c != key]
    other = changes.select(key, F.lit(True).alias("_hit"), *(F.col(c).alias(f"_{c}") for c in columns))
    value = lambda c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) if with_nulls else F.coalesce(f"_{c}", c)
    return existing.join(other, key, "left").select(*(value(c).alias(c) if c in columns else F.col(c) for c in existing.columns))


class SearchIndex:
    """The search index as a table below a folder: a snapshot for each change, the
    last of which holds. Documents are told apart by id."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _snapshots(self) -> list[str]:
        return sorted(e["name"] for e in exports(self.spark, self.folder) if e["name"].startswith("v") and exists(self.spark, f"{self.folder}/{e['name']}/_SUCCESS"))

    def read(self) -> DataFrame | None:
        """The documents, or None where there is no index yet."""
        known = self._snapshots()
        return self.spark.read.parquet(f"{self.folder}/{known[-1]}") if known else None

    def _write(self, rows: DataFrame) -> None:
        known = self._snapshots()
        rows.write.parquet(f"{self.folder}/v{int(known[-1][1:]) + 1 if known else 0:09d}")
        for old in known[:-1]:  # the one before may still be read
            fs, p = _fs(self.spark, f"{self.folder}/{old}")
            fs.delete(p, True)

    def add(self, docs: DataFrame) -> None:
        """Add documents, or replace those of their ids; of one id the largest row."""
        docs = docs.groupBy("id").agg(F.max(F.struct(*docs.columns)).alias("r")).select("r.*")
        old = self.read()
        self._write(docs if old is None else replace(old, docs, "id"))

    def delete(self, ids: DataFrame) -> None:
        if (old := self.read()) is not None:
            self._write(old.join(ids.select("id"), "id", "left_anti").select(*old.columns))

    def clear(self) -> None:
        if (old := self.read()) is not None:
            self._write(old.limit(0))

    def sync(self, docs: DataFrame) -> None:
        """All anew from the active documents."""
        from sparkloom.operators.catalog import search_view

        self._write(search_view(docs))


def golden_import(existing: DataFrame, path: str, pages: DataFrame | None = None, fetch: Callable[[str], str | None] | None = None) -> DataFrame:
    """The golden set after importing a CSV: valid rows get the metrics of their
    page's text and host, and replace the rows of their URL.

    Pages come from ``pages`` (url, html), the others from ``fetch``; a row without
    a page is scored on empty text.
    """
    from sparkloom.functions import html as H
    from sparkloom.functions import scoring as S
    from sparkloom.functions import url as U
    from sparkloom.sources import readers

    spark = existing.sparkSession
    rows = readers.golden_csv(spark, path).groupBy("url").agg(F.max(F.struct("label", "content_type", "notes")).alias("r")).select("url", "r.*")
    known = spark.createDataFrame([], "url string, html string") if pages is None else pages.select("url", "html")
    found = rows.join(known.groupBy("url").agg(F.max("html").alias("html")), "url", "left")
    found = readers.fetched(found.withColumn("text", F.lit(None).cast("string")), fetch)
    found = found.withColumn("text", F.coalesce(H.main_text(F.col("html")), F.lit(""))).withColumn("domain", U.domain(F.col("url")))
    made = S.with_metrics(found, host=F.col("domain"))
    metrics = F.create_map(*(x for name in S.WEIGHTS for x in (F.lit(name), F.col(name))))
    new = made.select("url", F.col("label").cast("string").alias("label"), "content_type", "notes", metrics.alias("raw_metrics"), F.lit(1).alias("version"), "domain")
    return upsert(existing, new, "url", tuple(c for c in new.columns if c != "url"))


def write_archive(texts: DataFrame, path: str, when: str = "created_at", compression: str = "gzip") -> None:
    """JSON lines by year, month and day."""
    t = F.col(when)
    parts = texts.withColumns({"y": F.date_format(t, "yyyy"), "m": F.date_format(t, "MM"), "d": F.date_format(t, "dd")})
    parts.write.mode("append").partitionBy("y", "m", "d").option("compression", compression).json(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def manifest(spark: SparkSession, folder: str) -> list[dict]:
    """The exports of a folder in the order they were made."""
    fs, p = _fs(spark, f"{folder}/manifest.json")
    return json.loads("".join(r[0] for r in spark.read.text(f"{folder}/manifest.json").collect())) if fs.exists(p) else []


def write_mapping(rows: DataFrame, folder: str, name: str, as_json: bool = False) -> dict:
    """Write a mapping, add it to the manifest, which names the latest last, and return its entry."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    stored = spark.read.parquet(f"{folder}/{name}")
    if as_json:
        stored.write.mode("overwrite").json(f"{folder}/{name}-json")
    c = F.col("cluster_id")
    stats = stored.agg(F.count("*").alias("n_docs"), F.count_distinct(F.when(c != -1, c)).alias("n_clusters"), F.count_if(c == -1).alias("n_orphans")).first().asDict()
    entry = {"id": name, **stats, "created_at": datetime.now(UTC).isoformat(timespec="seconds")}
    known = [m for m in manifest(spark, folder) if m["id"] != name] + [entry]
    fs, p = _fs(spark, f"{folder}/manifest.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(known).encode()))
    out.close()
    return entry


def write_documents(docs: DataFrame, path: str, with_embeddings: bool = False) -> None:
    """Export documents, without vectors unless they are asked for."""
    (docs if with_embeddings else docs.drop("embedding")).write.mode("overwrite").parquet(path)


def write_bundle(docs: DataFrame, mapping: DataFrame, clusters: DataFrame, folder: str, most: int = 100_000) -> None:
    """What a viewer needs: the mapping, at most ``most`` documents (a feature of the view) and the clusters."""
    mapping.write.mode("overwrite").parquet(f"{folder}/mappings")
    docs.orderBy("id").limit(most).write.mode("overwrite").parquet(f"{folder}/documents")
    clusters.write.mode("overwrite").parquet(f"{folder}/clusters")


def exports(spark: SparkSession, folder: str) -> list[dict]:
    """name, bytes and modified (ISO) of each entry of a folder."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(({"name": s.getPath().getName(), "bytes": fs.getContentSummary(s.getPath()).getLength(), "modified": datetime.fromtimestamp(s.getModificationTime() / 1000, UTC).isoformat(timespec="milliseconds")} for s in fs.listStatus(p)), key=lambda x: x["name"])


def storage(spark: SparkSession, *folders: str) -> dict:
    """Files and bytes below folders, and their entries by name; missing ones count as empty."""
    by = {f: exports(spark, f) for f in folders}
    files = sum(_fs(spark, f)[0].getContentSummary(_fs(spark, f)[1]).getFileCount() for f in folders if exists(spark, f))
    return {"files": files, "bytes": sum(e["bytes"] for es in by.values() for e in es), "entries": by}
