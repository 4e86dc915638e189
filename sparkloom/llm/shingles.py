"""Pairs of texts by the Jaccard similarity of their sets of five-word shingles.

Sets meet in tables of MinHash entries, so many that a pair at the threshold
shares none with probability 1e-4 at most; sets that meet are compared in full.
In a bucket a search from set to set gives a spanning forest of its links, so a
group of near copies costs about one comparison a member. A bucket of over
``most`` sets is cut into blocks, and every two blocks meet in a task: memory is
bounded by two blocks, and no link is lost.

Defined results: words are split at white space, ASCII letters are lower-cased;
texts under five words have no set; equal sets are one node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches, written
from sparkloom.llm.simhash import LOWER

ROWS = 4
#: Sets of a bucket that one task holds, half of them at most of one block.
MOST = 2048
#: Sets that are compared one by one; more are compared by a matrix of common shingles.
FEW = 16


def shingle_set(text: str | None, words: int = 5, seed: int = 42) -> np.ndarray:
    """The sorted distinct hashes of the shingles."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(parts) < words:
        return np.zeros(0, dtype=np.uint64)
    joined = map(b" ".join, zip(*(islice(parts, k, None) for k in range(words)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(seed)), np.uint64, len(parts) - words + 1))


def tables_for(threshold: float, miss: float = 1e-4) -> int:
    return max(1, math.ceil(math.log(miss) / math.log(1 - threshold**ROWS))) if threshold < 1 else 1


def table_keys(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A key a table from ROWS least permuted hashes of a set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(own), 4096):
        x = own[start : start + 4096] * factors[:, None]
        x ^= x >> np.uint64(32)
        least = np.minimum(least, (x * np.uint64(0x9E3779B97F4A7C15)).min(axis=1))
    out = np.zeros(len(factors) // ROWS, dtype=np.uint64)
    for part in least.reshape(-1, ROWS).T:
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + part
    return out


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles every two sets share.

    Shingles that a sixteenth of the sets have are columns of 0-1 matrices, a
    thousand at a time, whose products are added up; the pairs of sets that
    share one of the others are counted one by one, and there are few.
    """
    n, sizes = len(sets), [len(x) for x in sets]
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    order = np.argsort(column, kind="stable")
    order = order[counts[column[order]] > 1]
    row, column = row[order], column[order]
    out = np.zeros((n, n), dtype=np.float32)
    often = counts[column] * 16 > n
    place = np.cumsum(np.r_[False, np.diff(column[often]) != 0]) if often.any() else np.zeros(0, dtype=np.int64)
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, 1024):
        a, b = np.searchsorted(place, [start, start + 1024])
        x = np.zeros((n, 1024), dtype=np.float32)
        x[row[often][a:b], place[a:b] - start] = 1
        out += x @ x.T
    row, column = row[~often], column[~often]
    first = np.searchsorted(column, column)
    many = np.searchsorted(column, column, side="right") - first
    for start in range(0, len(row), 1 << 16):
        m = many[start : start + (1 << 16)]
        left = np.repeat(row[start : start + (1 << 16)], m)
        right = row[np.repeat(first[start : start + (1 << 16)], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
        np.add.at(out, (left, right), 1)
    return out


def spanning(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Edges that connect exactly the sets that links of the threshold connect."""
    sizes = np.array([len(x) for x in sets])
    shared = common(sets) if len(sets) > FEW else None

    def linked(at: int, others: np.ndarray) -> np.ndarray:
        """Which of the others are linked to a set."""
        n, m = sizes[at], sizes[others]
        # Sets whose sizes differ too much cannot be alike.
        able = np.flatnonzero(np.minimum(n, m) >= threshold * np.maximum(n, m))
        both = shared[at, others[able]].astype(np.int64) if shared is not None else np.array([np.isin(sets[at], sets[i], assume_unique=True).sum() for i in others[able]], dtype=np.int64)
        return others[able[both >= threshold * (n + m[able] - both) - 1e-9]]

    edges, left = [], np.ones(len(sets), dtype=bool)
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first] = False
        todo = [first]
        while todo and left.any():
            at = todo.pop()
            found = linked(at, np.flatnonzero(left))
            left[found] = False
            edges += [(at, int(i)) for i in found]
            todo += found.tolist()
    return edges


def links(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.8, seed: int = 42, most: int = MOST) -> DataFrame:
    """u, v: pairs of ids that connect the documents of equal sets and those that
    links of at least ``threshold`` connect."""
    tables = tables_for(threshold)
    factors = np.random.default_rng(seed).integers(0, 1 << 63, tables * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))

    def name(own: np.ndarray) -> int:
        return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes(), seed)).view(np.int64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text"):
            ids, nodes, keys = [], [], []
            for i, value in zip(part.column(0).to_pylist(), texts, strict=True):
                own = shingle_set(value)
                if len(own):
                    ids.append(i)
                    nodes.append(name(own))
                    keys.append(table_keys(own, factors).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["key", "node", "keys"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text"):
            sets = [x for x in map(shingle_set, texts) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([name(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "set"])

    signed = written(rows.mapInArrow(sign, "key bigint, node bigint, keys array<bigint>"), "shingled")
    nodes = written(signed.groupBy("node").agg(F.min("key").alias("least"), F.first("keys").alias("keys")), "shingle_nodes")
    keyed = nodes.select("node", F.posexplode("keys").alias("t", "k"))
    shared = written(keyed.groupBy("t", "k").count().where("count > 1"), "shingle_buckets")
    members = written(keyed.join(shared, ["t", "k"]), "shingle_members")
    # Only the first document of each node that meets another is read again.
    firsts = nodes.join(members.select("node").distinct(), "node", "left_semi").select(F.col("least").alias("key"))
    sets = rows.join(firsts, "key", "left_semi").mapInArrow(read, "node bigint, set binary").groupBy("node").agg(F.first("set").alias("set"))
    sets = written(sets, "shingle_sets")

    deal = ("t", "k", "a", "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, names, held = None, [], []

        def flush() -> pa.RecordBatch:
            found = spanning(held, threshold)
            return pa.RecordBatch.from_arrays([pa.array([names[e[i]] for e in found], pa.int64()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            for node, value, *key in zip(*(batch.column(x).to_pylist() for x in ("node", "set", *deal)), strict=True):
                if key != bucket:
                    if len(held) > 1:
                        yield flush()
                    bucket, names, held = key, [], []
                names.append(node)
                held.append(np.frombuffer(value, dtype=np.uint64))
        if len(held) > 1:
            yield flush()

    # One block, or so many that two of them hold ``most`` sets.
    blocks = F.when(F.col("count") <= most, 1).otherwise(F.ceil(2 * F.col("count") / most)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    dealt = members.withColumn("_blocks", blocks).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.select("node", "t", "k", F.least("_own", "_other").alias("a"), F.greatest("_own", "_other").alias("b"))
    met = dealt.join(sets, "node").repartition(*deal).sortWithinPartitions(*deal, "node")
    found = written(met.mapInArrow(near, "u bigint, v bigint").distinct(), "shingle_links")
    least = nodes.select("node", "least")
    ends = found.join(least.withColumnsRenamed({"node": "u", "least": "a"}), "u").join(least.withColumnsRenamed({"node": "v", "least": "b"}), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    copies = signed.select("node", "key").join(least, "node").where("key <> least").select(F.col("least").alias("u"), F.col("key").alias("v"))
    return ends.union(copies).where("u <> v").distinct()
