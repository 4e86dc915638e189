"""Benchmark passages in documents, found by q-gram lemma filtering.

Texts are lower-cased words joined by single spaces. A benchmark item is cut
into overlapping windows; a window of m characters is found where a document
holds it within an edit budget e that is a share of m. By the q-gram lemma such
a place shares at least m + 1 - q(e + 1) character q-grams with the window, on
diagonals no further apart than e. So the shared q-grams are counted in diagonal
bands that overlap by half, bands that reach the bound are kept, and a banded
alignment verifies each. No place of a whole window within the budget is missed;
windows begin every ``stride`` characters, so any piece of window + stride - 1
characters of an item holds one. Items shorter than ``least`` characters have
too few grams for the lemma and are found exactly, as whole words.

The benchmark is a stated query set: it is matched in blocks whose index has a
bounded size, each against all documents, and documents are not shuffled.

Defined results: null and empty texts have no passages; items without a word
never match; equal items give a match each; repeated documents give repeated matches; an empty
benchmark or table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches, written

WORD = re.compile(r"[^\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Between documents that are searched together; no window holds it.
SEPARATOR = "\x00"


@dataclass(frozen=True)
class Rule:
    """q: of the grams; window and stride: of an item's windows; share: of a
    window's characters that may be edits; least: characters of an item that is
    found with edits."""

    q: int = 10
    window: int = 96
    stride: int = 16
    share: float = 0.08
    least: int = 24
    band: int = 8

    def budget(self, m: int) -> int:
        """The edits allowed, few enough that the lemma's bound stays positive."""
        return max(0, min(int(self.share * m), self.band, int((m - self.q + 1 - 0.15 * m) // self.q)))

    def bound(self, m: int) -> int:
        return max(1, m + 1 - self.q * (self.budget(m) + 1))


def normal(text: str | None) -> str:
    return " ".join(WORD.findall(text)).lower() if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_hashes(values: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each run of q values, built from runs of powers of two."""
    out, size, run, done = None, 1, values.astype(np.uint64) + np.uint64(1), 0
    total = len(values) - q + 1
    if total <= 0:
        return np.zeros(0, dtype=np.uint64)
    while True:
        if q & size:
            part = run[done : done + total]
            out = part * MIX if out is None else (out ^ (out >> np.uint64(29))) * MIX + part
            done += size
        if size * 2 > q:
            return out * MIX
        run = run[:-size] * np.uint64(0x100000001B3 + 2 * size) + run[size:]
        size *= 2


def windows(item: str, rule: Rule) -> list[tuple[int, int]]:
    """(start, end) of the windows that cover a normal text; the last ends with it."""
    n = len(item)
    if not n:
        return []
    if n <= rule.window:
        return [(0, n)]
    starts = [*range(0, n - rule.window, rule.stride), n - rule.window]
    return [(s, s + rule.window) for s in starts]


def edits(pattern: np.ndarray, region: np.ndarray, width: int) -> tuple[int, int]:
    """The least edits between the pattern and a part of the region that begins
    at one of its first ``width`` places, and the end of that part, by a banded
    alignment. The region is padded where it ends early."""
    m = len(pattern)
    padded = np.full(m + width, np.uint32(0xFFFFFFFF))
    padded[: min(len(region), m + width)] = region[: m + width]
    steps = np.arange(width)
    row = np.zeros(width, dtype=np.int64)
    for i in range(m):
        new = row + (padded[i : i + width] != pattern[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    best = int(row.argmin())
    return int(row[best]), min(m + best, len(region))


class Index:
    """The windows of a block of benchmark items, by their q-grams."""

    def __init__(self, items: list[tuple[int, str]], rule: Rule = Rule()):
        self.rule, self.items, self.spans, self.of_item = rule, [], [], []
        self.short: dict[str, list[int]] = {}
        grams, at, of, bounds, budgets = [], [], [], [], []
        for key, text in items:
            whole = normal(text)
            if not whole:
                continue
            hashes = gram_hashes(codes(whole), rule.q)
            exact = len(whole) < max(rule.least, rule.q)
            for start, end in windows(whole, rule):
                number, m = len(self.spans), end - start
                self.spans.append((key, start, end, len(whole)))
                self.of_item.append(len(self.items))
                bounds.append(1 if exact else rule.bound(m))
                budgets.append(0 if exact else rule.budget(m))
                if exact:
                    self.short.setdefault(whole, []).append(number)
                    continue
                n = m - rule.q + 1
                grams.append(hashes[start : start + n])
                at.append(np.arange(n, dtype=np.int32))
                of.append(np.full(n, number, dtype=np.int32))
            self.items.append(whole)
        grams = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        order = np.argsort(grams, kind="stable")
        self.at = np.concatenate(at)[order] if at else np.zeros(0, dtype=np.int32)
        self.of = np.concatenate(of)[order] if of else np.zeros(0, dtype=np.int32)
        self.grams, first, many = np.unique(grams[order], return_index=True, return_counts=True)
        self.first, self.many = first.astype(np.int32), many.astype(np.int32)
        self.bits = 20
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[self.grams >> np.uint64(64 - self.bits)] = True
        self.bounds, self.budgets = np.array(bounds, dtype=np.int64), budgets
        self.long = [i for i, b in enumerate(budgets) if len(self.text(i)) >= max(rule.least, rule.q)]
        self.least = int(self.bounds[self.long].min()) if self.long else 0
        self.longest = max((e - s for _, s, e, _ in self.spans), default=0) + 2 * rule.band
        #: No shorter normal text holds anything.
        self.shortest = min([*map(len, self.short), *([rule.least - rule.band] if self.long else [])], default=1 << 60)
        self.built: dict = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"built": {}}

    def text(self, window: int) -> str:
        """The normal text of a window."""
        _, start, end, _ = self.spans[window]
        return self.items[self.of_item[window]][start:end]

    def exact(self, text: str) -> list[tuple[int, int, int, int]]:
        """search() for the short items."""
        if not self.short:
            return []
        if "a" not in self.built:
            import ahocorasick

            self.built["a"] = ahocorasick.Automaton()
            for item in self.short:
                self.built["a"].add_word(item, item)
            self.built["a"].make_automaton()
        out, edge = [], (" ", SEPARATOR)
        for last, item in self.built["a"].iter(text):
            start, end = last + 1 - len(item), last + 1
            if (not start or text[start - 1] in edge) and (end == len(text) or text[end] in edge):
                out += [(w, start, end, 0) for w in self.short[item]]
        return out

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(window, start, end, edits) of every verified place in a normal text;
        a window's places in overlapping bands count once each."""
        return sorted([*self.exact(text), *self.edited(text)])

    def edited(self, text: str) -> list[tuple[int, int, int, int]]:
        """search() for the items that are found with edits."""
        if not self.long or len(text) < self.rule.q:
            return []
        values = codes(text)
        hashes = gram_hashes(values, self.rule.q)
        places = np.flatnonzero(self.seen[hashes >> np.uint64(64 - self.bits)])
        index = np.searchsorted(self.grams, hashes[places])
        hit = self.grams[np.minimum(index, len(self.grams) - 1)] == hashes[places]
        places, index = places[hit], index[hit]
        if len(places) < self.least:
            return []
        # A place of any window has the least bound's number of hits close by.
        ends = np.flatnonzero(places[self.least - 1 :] - places[: len(places) - self.least + 1] <= self.longest)
        mark = np.zeros(len(places) + 1, dtype=np.int64)
        np.add.at(mark, ends, 1)
        np.add.at(mark, ends + self.least, -1)
        near = np.cumsum(mark[:-1]) > 0
        places, index = places[near], index[near]
        if not len(places):
            return []
        many = self.many[index].astype(np.int64)
        posting = np.repeat(self.first[index], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        of = self.of[posting].astype(np.int64)
        # Shifted by the longest window, so that diagonals are positive.
        diagonal = np.repeat(places, many) - self.at[posting] + self.longest
        band = diagonal // self.rule.band
        scale = np.int64(1) << 36
        # Half-overlapping bands: each hit counts in its own and in the one before.
        keys, counts = np.unique(np.concatenate([of * scale + band, of * scale + band - 1]), return_counts=True)
        kept = counts >= self.bounds[keys // scale]
        out = {}
        for w, b in zip((keys[kept] // scale).tolist(), (keys[kept] % scale).tolist(), strict=True):
            low = b * self.rule.band - self.longest
            start, shift = max(0, low), max(0, -low)
            own = self.text(w)
            stop = low + 2 * self.rule.band + len(own)
            exact = text.find(own, start, stop)
            if exact >= 0:
                out[w, exact, True] = (w, exact, exact + len(own), 0)
                continue
            pattern = codes(own)
            region = np.concatenate([np.full(shift, 0xFFFFFFFE, dtype=np.uint32), values[start:stop]])
            cost, end = edits(pattern, region, 2 * self.rule.band + 1)
            if cost <= self.budgets[w]:
                end = end - shift + start
                # Exact starts and edited ends are told apart, so that none takes another's place.
                out[w, end // self.rule.band, False] = (w, max(0, end - len(pattern)), end, cost)
        return list(out.values())


def searched(own: Index, texts: list[str | None], most: int = 1 << 20) -> list[list[tuple[int, int, int, int]]]:
    """search() of each text, several short texts at once. Texts of over ``most``
    characters are searched in parts that overlap by the longest place."""
    out: list[list] = [[] for _ in texts]
    held: list[tuple[int, str]] = []
    size = 0

    def long(whole: str) -> list[tuple[int, int, int, int]]:
        found = {}
        for at in range(0, len(whole), most):
            for w, start, end, cost in own.edited(whole[at : at + most + own.longest]):
                found.setdefault((w, (at + end) // own.rule.band), (w, at + start, at + end, cost))
            # A sign more on each side tells whether a word begins and ends at the cuts.
            low = max(0, at - 1)
            for w, start, end, cost in own.exact(whole[low : at + most + own.longest + 1]):
                if at <= low + start < at + most:
                    found[w, low + start, True] = (w, low + start, low + end, cost)
        return sorted(found.values())

    def flush() -> None:
        if not held:
            return
        begins = np.cumsum([0, *(len(x) + 1 for _, x in held)])
        for w, start, end, cost in own.search(SEPARATOR.join(x for _, x in held)):
            at = int(np.searchsorted(begins, max(start, end - 1), side="right")) - 1
            start = max(start, int(begins[at]))
            out[held[at][0]].append((w, start - int(begins[at]), end - int(begins[at]), cost))
        held.clear()

    for i, text in enumerate(texts):
        whole = normal(text)
        if len(whole) > most:
            out[i] = long(whole)
        elif len(whole) >= own.shortest:
            held.append((i, whole))
            size += len(whole)
        if size > 1 << 18:
            flush()
            size = 0
    flush()
    return out


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """The characters of ``text`` from the word at ``start`` of its normal form to that at ``end``."""
    at, first, last = 0, None, 0
    for m in WORD.finditer(text):
        size = len(m[0].lower())
        if at + size > start and first is None:
            first = m.start()
        if at < end:
            last = m.end()
        at += size + 1
        if at >= end:
            break
    return first or 0, last


def blocks(benchmark: DataFrame, text: str, key: str, rule: Rule, most: int = 200_000) -> Iterator[Index]:
    """Indexes of about ``most`` characters each, until all items are covered. A
    character takes about 80 bytes of an index, so a block about 16 MB."""
    items = benchmark.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // most)
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("key", "text"), F.lit(n)) == block).orderBy("key", "text").collect()
        yield Index([(r["key"], r["text"]) for r in rows], rule)


def passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", rule: Rule = Rule()) -> DataFrame:
    """A row per document and item with a verified passage: ``key``, ``item_key``,
    start and end (characters of the document from the first to the last
    place), edits (the fewest of a place), n_windows matched of n_item_windows."""
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    schema = "key bigint, item bigint, start bigint, end bigint, edits int, n_windows int, n_item_windows int"
    out = None
    for index in blocks(benchmark, item_text, item_key, rule):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own = held.value
            for part, texts in text_batches(batches, "text", 4 << 20):
                rows = []
                for key, text, found in zip(part.column(0).to_pylist(), texts, searched(own, texts), strict=True):
                    by: dict[int, list] = {}
                    for w, start, end, cost in found:
                        by.setdefault(own.spans[w][0], []).append((w, start, end, cost))
                    for item, places in sorted(by.items(), key=lambda x: (x[0] is None, x[0] or 0)):
                        start, end = original_span(text, min(p[1] for p in places), max(p[2] for p in places))
                        whole = len(windows(" " * own.spans[places[0][0]][3], own.rule))
                        rows.append((key, item, start, end, min(p[3] for p in places), len({p[0] for p in places}), whole))
                names = ["key", "item", "start", "end", "edits", "n_windows", "n_item_windows"]
                types = [pa.int64()] * 4 + [pa.int32()] * 3
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        part = rows.mapInArrow(find, schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"key": key, "item": item_key})


def contaminated(benchmark: DataFrame, text: str | Column = "text", item_text: str = "text", item_key: str = "item_id", rule: Rule = Rule()) -> Column:
    """True where a whole text column holds a passage of any item. All blocks are
    held at once; uncontaminated() takes a few at a time."""
    value, out = F.col(text) if isinstance(text, str) else text, F.lit(False)
    for index in blocks(benchmark, item_text, item_key, rule):
        out = out | _found(benchmark.sparkSession.sparkContext.broadcast(index))(value)
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id", rule: Rule = Rule(), most: int = 200_000, at_once: int = 4) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage. A worker holds ``at_once``
    blocks of the benchmark; what is left after these is written for the next."""
    flags: list[Column] = []
    for index in blocks(benchmark, item_text, item_key, rule, most):
        if len(flags) == at_once:
            docs, flags = written(docs.where(~reduce(or_, flags)), "uncontaminated"), []
        flags.append(_found(docs.sparkSession.sparkContext.broadcast(index))(F.col(text)))
    return docs.where(~reduce(or_, flags)) if flags else docs


def _found(held):
    @F.arrow_udf("boolean")
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([bool(x) for x in searched(held.value, texts.to_pylist())], pa.bool_())

    return found
