"""Quality by logistic regression on hashed word n-grams, trained online with
follow-the-regularised-leader (proximal) updates.

Tokens are runs of word characters and runs of other signs, case kept; a token
that follows itself is one sign, whatever it is. Unigrams and bigrams are hashed into a fixed number of weights; a text is the vector of
its n-gram counts scaled to unit length, and its score the logistic of a sparse
dot product. Training streams through one task: its memory is the weights.

Defined results: null and empty texts have no n-grams and get the score of the
bias; repeated rows get equal scores and are learned from once; without labelled
rows of both kinds the weights are zero; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches
from sparkloom.llm.toxicity import training_sample

TOKEN = re.compile(r"\w+|[^\w\s]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
SAME, SAME_PAIR = np.uint64(1), np.uint64(2)


def ngrams(text: str | None, bits: int = 18) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the hashed n-grams and their values; unit length."""
    tokens = TOKEN.findall(text or "")
    one = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    two = one[:-1] * MIX + one[1:]
    # A token after itself and a pair after itself become one sign each, whatever they are.
    again, pair = one[1:] == one[:-1], two[2:] == two[:-2]
    two[np.flatnonzero(again)] = SAME
    two[np.flatnonzero(pair) + 2] = SAME_PAIR
    index = np.concatenate([one * MIX >> np.uint64(64 - bits), two * MIX >> np.uint64(64 - bits)]).astype(np.int64)
    index, counts = np.unique(index, return_counts=True)
    values = np.sqrt(counts)
    return index, values / max(1e-12, float(np.linalg.norm(values)))


@dataclass
class Ftrl:
    """Per-coordinate proximal updates; the last coordinate is the bias."""

    bits: int = 18
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.01
    z: np.ndarray = field(default=None)
    n: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        self.z = np.zeros((1 << self.bits) + 1)
        self.n = np.zeros((1 << self.bits) + 1)

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, index: np.ndarray, values: np.ndarray, truth: int) -> None:
        index, values = np.append(index, 1 << self.bits), np.append(values, 1.0)
        w = self.weights(index)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
        g = (p - truth) * values
        sigma = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += g - sigma * w
        self.n[index] += g * g


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bits: int = 18

    def score(self, text: str | None) -> float:
        index, values = ngrams(text, self.bits)
        return float(1 / (1 + np.exp(-np.clip(self.weights[index] @ values + self.weights[-1], -30, 30))))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id", most: int = 6000, epochs: int = 3, bits: int = 18) -> Model:
    """A model from at most ``most`` labelled rows outside the held-out fold,
    passed ``epochs`` times in the order of a hash of their id."""
    sample = training_sample(docs, labels, label, most, text, key)
    passes = sample.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Ftrl(bits), set()
        for part, texts in text_batches(batches, "text"):
            for x, y in zip(texts, part.column("label").to_pylist(), strict=True):
                model.learn(*ngrams(x, bits), y)
                seen.add(y)
        weights = model.weights(slice(None)) if len(seen) > 1 else np.zeros((1 << bits) + 1)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(weights[at])], ["at", "weight"])

    rows = passes.select("text", "label", "epoch", "at").coalesce(1).sortWithinPartitions("epoch", "at", "text").mapInArrow(fit, "at bigint, weight double").toArrow()
    weights = np.zeros((1 << bits) + 1)
    weights[rows["at"].to_numpy()] = rows["weight"].to_numpy()
    return Model(weights, bits)


def quality_score(model: Model, spark, text: str | Column = "text") -> Column:
    """The score column of a whole text column; the weights have a fixed size and are broadcast."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = held.value
        return pa.array([own.score(x) for x in texts.to_pylist()], pa.float64())

    return score(F.col(text) if isinstance(text, str) else text)
