"""Incremental ingestion with Structured Streaming.

A file source with a bounded number of files a trigger replaces bounded queues;
state for seen URLs is Spark's; draining is a trigger over what is available.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sparkloom.functions import text as T
from sparkloom.functions import url as U
from sparkloom.operators.vectors import OnlineSampler, fps_cosine


def files(spark: SparkSession, path: str, schema, format: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    """A stream of new files below a folder."""
    return spark.readStream.schema(schema).format(format).option("maxFilesPerTrigger", files_per_trigger).load(path)


def documents(pages: DataFrame, url: str = "url", text: str = "text") -> DataFrame:
    """New documents of a batch or stream: canonical URL seen first, URL and content filters passed.

    On a stream the URLs seen are state in the checkpoint folder, a row for each
    URL ever accepted; RocksDB state (see session.SETTINGS) keeps it on disk, so
    executors' memory does not grow with it.
    """
    rows = pages.withColumn("canonical_url", U.canonical(F.col(url))).where(U.filter_reason(F.col("canonical_url")).isNull())
    rows = rows.where(T.content_reason(F.col(text)).isNull()).dropDuplicates(["canonical_url"])
    return rows.withColumns({"id": U.doc_id(F.col("canonical_url")), "domain": U.domain(F.col("canonical_url")), "content_hash": F.md5(text)})


class Progress(StreamingQueryListener):
    """Adds up the batches and rows of one query as they end, and reports them at
    most every ``interval`` seconds."""

    def __init__(self, interval: float = 30.0, report: Callable[[dict], None] | None = None):
        self.interval, self.report, self.wanted = interval, report, None
        self.by_run: dict[str, dict] = {}
        self.ended: set[str] = set()
        self.began = self.told = time.monotonic()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        own = self.by_run.setdefault(str(p.runId), {"batches": 0, "rows": 0})
        own["batches"] += 1
        own["rows"] += p.numInputRows
        now = time.monotonic()
        if self.report and now - self.told >= self.interval:
            self.told = now
            self.report(own | {"seconds": now - self.began, "rows_per_second": own["rows"] / max(now - self.began, 1)})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.add(str(event.runId))


def run(stream: DataFrame, sink: str, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, interval: float = 30.0, report: Callable[[dict], None] | None = None) -> dict:
    """Process all that is available and stop; the batches and rows of this run.
    Without ``each`` the rows are appended to a Parquet folder exactly once.
    ``report`` gets the counts so far, at most every ``interval`` seconds."""
    spark, seen = stream.sparkSession, Progress(interval, report)
    spark.streams.addListener(seen)
    try:
        writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = (writer.foreachBatch(each) if each else writer.format("parquet").option("path", sink).outputMode("append")).start()
        query.awaitTermination()
        # Events follow the query's end.
        waited = time.monotonic() + 20
        while str(query.runId) not in seen.ended and time.monotonic() < waited:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(seen)
    return seen.by_run.get(str(query.runId), {"batches": 0, "rows": 0})


def online_sample(stream: DataFrame, threshold: float = 0.1, alpha: float = 1.0, shards: int = 8) -> DataFrame:
    """Accepted rows of (vec_id, embedding, quality): in each shard of ids a row is
    accepted if it is far enough from those accepted before it."""

    def offer(key: tuple, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        sampler = OnlineSampler(threshold, alpha)
        if state.exists:
            flat, size = state.get
            sampler.kept = [pd.Series(flat[i : i + size]).to_numpy() for i in range(0, len(flat), size)] if size else []
        out = []
        for pdf in pdfs:
            for r in pdf.sort_values("vec_id").itertuples():
                ok, distance = sampler.offer(r.embedding, r.quality)
                if ok:
                    out.append((r.vec_id, distance))
        size = len(sampler.kept[0]) if sampler.kept else 0
        state.update(([float(x) for v in sampler.kept for x in v], size))
        yield pd.DataFrame(out, columns=["vec_id", "novelty"])

    keyed = stream.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    return keyed.groupBy("shard").applyInPandasWithState(offer, "vec_id bigint, novelty double", "kept array<double>, size int", "append", "NoTimeout")


def reservoir_each(out: list, k_ratio: float = 0.2, alpha: float = 1.0, size: int = 10_000) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that samples reservoirs of ``size`` rows by farthest
    points, as many of each as ``k_ratio`` says. A micro-batch is cut into
    reservoirs by position, each in a task; only what is kept reaches ``out``."""

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.select("vec_id", "embedding", "quality")
        if (n := rows.count()) == 0:
            return
        groups = -(-n // size)

        def sampled(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("vec_id")
            got = fps_cosine(pdf["vec_id"].tolist(), np.array(pdf["embedding"].tolist()), pdf["quality"].to_numpy(), max(int(len(pdf) * k_ratio), 1), alpha)
            return pd.DataFrame([(i, r, float(d)) for i, r, d in got], columns=["vec_id", "rank", "novelty"])

        dealt = rows.withColumn("_group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
        kind = rows.schema["vec_id"].dataType.simpleString()
        kept = dealt.groupBy("_group").applyInPandas(lambda pdf: sampled(pdf.drop(columns="_group")), f"vec_id {kind}, rank bigint, novelty double")
        out.extend((number, *r) for r in kept.collect())

    return each


def windowed_events(events: DataFrame, late: str = "10 minutes", length: str = "1 hour") -> DataFrame:
    """Counts and sums by event type and window, late rows dropped by a watermark.
    Beyond what was asked to match; shows event time."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type")
    return w.agg(F.count("*").alias("n_events"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n_events", "total")
