"""What plug-ins of the engine give and get. All work on frames and columns, so a
plug-in says what to compute and Spark decides where."""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S
from sparkloom.operators import dedup
from sparkloom.operators.vectors import hashed_embedding


@runtime_checkable
class Embedder(Protocol):
    def encode(self, text: Column) -> Column:
        """The vector column of a text column."""


@runtime_checkable
class Scorer(Protocol):
    def score(self, weights: dict[str, float]) -> Column:
        """The score column of metric columns."""


@runtime_checkable
class ScoreAggregator(Protocol):
    def aggregate(self, metrics: dict[str, Column], weights: dict[str, float]) -> Column:
        """One score in 0 .. 1 from metrics."""


@runtime_checkable
class ContentTypeDetector(Protocol):
    def detect(self, url: Column, title: Column) -> Column:
        """The content type of a page."""


@runtime_checkable
class Deduplicator(Protocol):
    def find_duplicates(self, vectors: DataFrame) -> DataFrame:
        """The keys of the rows to remove."""


@runtime_checkable
class SourceFunctor(Protocol):
    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """A dump in the columns of schemas.DUMP."""


class HashingEmbedder:
    """Word counts by hash; stands for a model where there is none."""

    def __init__(self, size: int = 64):
        self.size = size

    def encode(self, text: Column) -> Column:
        return hashed_embedding(text, self.size)


class LinearScorer:
    def score(self, weights: dict[str, float] = S.WEIGHTS) -> Column:
        return S.linear_score(weights)


class WeightedMean:
    """The weighted mean of the metrics that have a weight, clamped; 0 without weights."""

    def aggregate(self, metrics: dict[str, Column], weights: dict[str, float]) -> Column:
        used = {k: w for k, w in weights.items() if k in metrics}
        total = sum(used.values())
        if not total:
            return F.lit(0.0)
        value = sum((metrics[k] * F.lit(w) for k, w in used.items()), F.lit(0.0)) / F.lit(total)
        return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


class SignDetector:
    """Content types by signs in URL and title."""

    def detect(self, url: Column, title: Column) -> Column:
        return S.content_type(url, title)


class CosineDeduplicator:
    def __init__(self, threshold: float = 0.95, keep: str = "first"):
        self.threshold, self.keep = threshold, keep

    def find_duplicates(self, vectors: DataFrame) -> DataFrame:
        return dedup.cosine_duplicates(vectors, self.threshold, keep=self.keep)


class ReaderSource:
    """The first reader that takes the path."""

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        from sparkloom.sources import readers, sinks

        fs, p = sinks._fs(spark, path)
        return readers.adapter(path, fs.exists(p) and fs.getFileStatus(p).isDirectory())(spark, path)
