"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, composes, maps look-alike letters of other scripts to
Latin and digits (and @ and $ between letters) to the letters they stand for.
Words are joined by single spaces, so a pattern that begins with a space is
anchored at a word's start and one that also ends with a space is a whole word.

The lexicon is learned from labelled rows: a stem or word qualifies if it begins a
far larger share of the words of toxic rows; of a chain of stems with the same
rows the longest is taken. Matches inside an exception phrase do not count. The
phrases are a given table and those that are learned: a matched word with a
neighbour that three clean rows hold and no toxic one. The score is a logistic
function of the matched weight per word of the whole text and of the densest
passage of 120 words, fitted on the same rows. A word that is repeated counts
once.

Defined results: null and empty texts match nothing and get the score of no
match; repeated rows get equal scores and are learned from once, as toxic if one of
them is labelled so, wherever the rows lie; without labelled rows of both kinds a small built-in lexicon is used; extra columns are
not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import held_out, text_batches, written

# Look-alikes of Latin letters (Cyrillic, then Greek) after lower-casing.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһкмтвнпгԛԝαβεικνορτυχ", "aeopcyxijsdhkmtbhnrqwabeikvoptux")
# Digits by the letters they are written for.
DIGITS = str.maketrans("0134578", "oieastb")
INSIDE = re.compile(r"(?<=[^\W_])[@$](?=[^\W_])")
WORD = re.compile(r"[^\W_]+")

#: Used where nothing can be learned.
BUILT_IN = {"idiot": 3.0, "moron": 3.0, "stupid": 2.0, "worthless": 2.0, "scum": 3.0, "loser": 2.0, "pathetic": 2.0, "disgusting": 2.0}
#: Words of the passages whose density counts.
PASSAGE = 120
#: Phrases in which a word of the lexicon says nothing about the writer's tone.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "pond scum")


def fold(text: str | None) -> str:
    """The folded words of a text, each after one space, with a space at the end."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(LOOKALIKES)
    if "@" in text or "$" in text:
        text = INSIDE.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return f" {' '.join(WORD.findall(text.translate(DIGITS)))} "


@dataclass(frozen=True)
class Model:
    """patterns: weight of each (space-anchored); factors: of the logistic function,
    for its constant and the features."""

    patterns: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    factors: tuple[float, ...] = (-2.5, 1.0, 1.0)
    built: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"built": {}}

    def automaton(self):
        if "a" not in self.built:
            import ahocorasick

            a = ahocorasick.Automaton()
            for pattern, weight in self.patterns.items():
                a.add_word(pattern, (len(pattern), weight))
            for phrase in self.exceptions:
                a.add_word(fold(phrase), (len(fold(phrase)), None))
            a.make_automaton()
            self.built["a"] = a
        return self.built["a"]

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the longest match at each word, without those in exception phrases."""
        a = self.automaton()
        if not len(a):
            return []
        found: dict[int, tuple[int, float]] = {}
        free: dict[int, int] = {}  # the end of the exception phrase around each word
        for last, (size, weight) in a.iter(folded):
            start, end = last + 1 - size, last + 1
            if weight is None:
                at = start
                while 0 <= at < end - 1:
                    free[at] = max(end, free.get(at, 0))
                    at = folded.find(" ", at + 1, end)
            elif start not in found or found[start][0] < end:
                found[start] = (end, weight)
        return [(s, e, w) for s, (e, w) in sorted(found.items()) if e > free.get(s, 0)]

    def features(self, text: str | None) -> tuple[float, float]:
        """Of the different matched words the weight for each hundred different
        words of the text, and for each hundred words of the passage of
        PASSAGE words that has most; as logarithms."""
        folded = fold(text)
        matches = self.matches(folded)
        if not matches:
            return 0.0, 0.0
        places, number, before = [], 0, 0
        for start, _, weight in matches:
            number += folded.count(" ", before, start)
            before = start
            places.append((number, folded[start : folded.index(" ", start + 1)], weight))
        total = sum({word: weight for _, word, weight in places}.values())
        most, low, held = 0.0, 0, Counter()
        inside = 0.0
        for number, word, weight in places:
            while places[low][0] <= number - PASSAGE:
                held[places[low][1]] -= 1
                inside -= 0.0 if held[places[low][1]] else places[low][2]
                low += 1
            held[word] += 1
            inside += weight if held[word] == 1 else 0.0
            most = max(most, inside)
        words = folded.count(" ") - 1
        return math.log1p(100 * total / (len(set(folded.split())) + 10)), math.log1p(100 * most / (min(words, PASSAGE) + 10))

    def phrases(self, text: str | None) -> set[str]:
        """The matched words of a text with the word before and with the word after."""
        folded, out = fold(text), set()
        for start, _, _ in self.matches(folded):
            end = folded.index(" ", start + 1)
            before, after = folded.rfind(" ", 0, start), folded.find(" ", end + 1)
            if start > 0 and before >= 0:
                out.add(folded[before + 1 : end])
            if after > 0:
                out.add(folded[start + 1 : after])
        return out

    def score(self, text: str | None) -> float:
        z = sum(f * x for f, x in zip(self.factors, (1.0, *self.features(text)), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


DEFAULT = Model({f" {w} ": x for w, x in BUILT_IN.items()})


def _stems(folded: str, longest: int = 12) -> Counter[str]:
    """How many different words have each beginning of 3 to ``longest`` letters,
    and the words that are no longer themselves."""
    out: Counter[str] = Counter()
    for word in set(folded.split()):
        n = len(word)
        for k in range(3, min(n, longest) + 1):
            out[" " + word[:k]] += 1
        if 2 < n <= longest:
            out[f" {word} "] += 1
    return out


def log_odds(toxic: int, other: int, toxic_words: int, other_words: int) -> float:
    """How much more of the words of toxic rows than of other rows a stem begins."""
    return math.log((toxic + 0.5) / (toxic_words + 1)) - math.log((other + 0.5) / (other_words + 1))


def chosen(counts: dict[str, tuple[int, int, int]], rows: int, toxic_words: int, other_words: int, least_odds: float = 1.5, least_share: float = 0.02) -> dict[str, float]:
    """The lexicon, pattern to log-odds weight, from each stem's toxic rows and its
    occurrences in toxic and in other rows; ``rows`` are toxic.

    A stem qualifies if the lower end of its log-odds' 95 % interval reaches
    ``least_odds``. From each shortest qualifying stem the search goes on to its extensions
    while at most three of them, all qualifying, have nearly all its rows.
    """
    support = max(3, least_share * rows)
    good = {}
    for k, (df, toxic, other) in counts.items():
        weight = log_odds(toxic, other, toxic_words, other_words)
        error = math.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
        if df >= support and weight - 1.96 * error >= least_odds:
            good[k] = (df, weight)
    below: dict[str, list[str]] = {}
    for k in good:
        below.setdefault(k[:-1], []).append(k)
    out: dict[str, float] = {}

    def walk(k: str) -> None:
        nexts = below.get(k, [])
        if 0 < len(nexts) <= 3 and sum(good[x][0] for x in nexts) >= 0.9 * good[k][0]:
            for x in nexts:
                walk(x)
        else:
            out[k] = round(good[k][1], 6)

    for k in sorted(good):
        if k[:-1] not in good:
            walk(k)
    return out


def _fit(rows: np.ndarray, truth: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic factors, the constant first, by damped Newton steps."""
    x = np.column_stack([np.ones(len(rows)), rows])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - truth) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """text, label and at (the least hash of an id) of at most ``most`` labelled rows
    outside the held-out fold, the first by a hash of their id; each text once, with
    its highest label. Written, as it is read more than once."""
    fold = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    ids = fold.groupBy(key).agg((F.max(label) > 0).cast("int").alias("_label")).orderBy(F.xxhash64(key), key).limit(most)
    rows = docs.select(F.col(key), F.col(text).alias("_text")).join(F.broadcast(ids), key)  # at most ``most`` short rows
    once = rows.where("_text is not null").groupBy(F.col("_text").alias("text")).agg(F.max("_label").alias("label"), F.min(F.xxhash64(key)).alias("at"))
    return written(once, "sample")


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id", most: int = 6000, exceptions: tuple[str, ...] = EXCEPTIONS, least_clean: int = 3) -> Model:
    """A model from at most ``most`` labelled rows outside the held-out fold.
    ``least_clean``: rows that make a phrase an exception."""
    sample = training_sample(docs, labels, label, most, text, key)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text", 4 << 20):
            rows, found = Counter(), (Counter(), Counter())
            for x, y in zip(texts, part.column("label").to_pylist(), strict=True):
                folded = fold(x)
                stems = _stems(folded)
                stems[""] = len(set(folded.split()))
                found[y].update(stems)
                rows.update(stems.keys() if y else ())
            keys = list(found[0] | found[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (rows, found[1], found[0]))], ["stem", "df", "toxic", "other"])

    stems = sample.select("text", "label").mapInArrow(count, "stem string, df bigint, toxic bigint, other bigint")
    stems = written(stems.groupBy("stem").agg(F.sum("df").alias("df"), F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "stems")
    whole = stems.where("stem = ''").first()
    if whole is None or not whole["toxic"] or not whole["other"]:
        return DEFAULT
    # What is left is frequent in the bounded sample's toxic rows and rare in the others.
    often = (F.col("stem") != "") & (F.col("df") >= max(3, 0.02 * whole["df"]))
    odds = (F.col("toxic") + 0.5) * (whole["other"] + 1) / ((F.col("other") + 0.5) * (whole["toxic"] + 1))
    found = stems.where(often & (odds >= math.exp(1.5))).toArrow().to_pydict()
    counts = {k: x for k, *x in zip(found["stem"], found["df"], found["toxic"], found["other"], strict=True)}
    patterns = chosen(counts, whole["df"], whole["toxic"], whole["other"])
    if not patterns:
        return DEFAULT
    model = Model(patterns, exceptions)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text", 4 << 20):
            found = (Counter(), Counter())
            for x, y in zip(texts, part.column("label").to_pylist(), strict=True):
                found[y].update(model.phrases(x))
            keys = list(found[0] | found[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (found[1], found[0]))], ["phrase", "toxic", "other"])

    phrases = sample.select("text", "label").mapInArrow(near, "phrase string, toxic bigint, other bigint").groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # Bounded by the sample, as the stems are.
    learned = sorted(r["phrase"] for r in phrases.where((F.col("toxic") == 0) & (F.col("other") >= least_clean)).select("phrase").collect())
    model = Model(patterns, (*exceptions, *learned))

    names = ["x", "y", "label"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text"):
            found = [(*model.features(x), y) for x, y in zip(texts, part.column("label").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.float64()) for i in range(3)], names)

    rows = sample.select("text", "label").mapInArrow(measure, "x double, y double, label double").toArrow().sort_by([(n, "ascending") for n in names])
    factors = _fit(np.column_stack([rows[n].to_numpy() for n in names[:2]]), rows["label"].to_numpy())
    return Model(patterns, model.exceptions, tuple(map(float, factors)))


def toxicity_score(model: Model, text: str | Column = "text") -> Column:
    """The score column of a whole text column."""
    held: dict[int, Model] = {}

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = held.setdefault(0, model)
        return pa.array([own.score(x) for x in texts.to_pylist()], pa.float64())

    return score(F.col(text) if isinstance(text, str) else text)
