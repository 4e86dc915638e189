"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints that differ in at most ``radius`` of their bits agree on all bits
of at least one of 2^(radius+1) - 1 masks: every bit position gets a non-zero
vector of radius+1 bits, mask v keeps the positions whose vector has an odd
product with v, and any ``radius`` positions leave a v that is orthogonal to
all of them. So no linked pair is missed.

Equal fingerprints become one node. Nodes that share a masked value form a
bucket; a bucket of at most ``most`` nodes is compared in blocks and gives one
edge for each node and link class, not all pairs. For larger buckets each node
is listed under every fingerprint within radius/2 bits: nodes linked within an
even radius meet there, no more than 65 of them can meet at radius 2, and all
that meet are linked, so a star joins them and nothing is dropped.
Components come from min-label propagation with pointer jumping over written
tables.

Defined results: a null text counts as empty, whose fingerprint is zero; rows
with a null id get a fingerprint but the ids of others name their component;
repeated rows stay rows of one component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches, written

BITS = 64
LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
#: Shingles whose bits are added up at once.
BLOCK = 1 << 16
_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the unsigned 64-bit ``hashes`` have each bit set, lowest first.

    Eight bit positions are added up at once, one in each byte of a word, in
    runs of 255 that no byte overflows in."""
    total = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), BLOCK):
        part = hashes[start : start + BLOCK]
        runs = np.arange(0, len(part), 255)
        for shift in range(8):
            sums = np.add.reduceat((part >> np.uint64(shift)) & _LANES, runs)
            total[shift::8] += sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint: a bit is set if over half the shingle hashes have it."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), seed)
    shingles = map(b" ".join, zip(*(islice(parts, k, None) for k in range(words)), strict=False))
    n = len(parts) - words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    return int(np.packbits(bit_counts(hashes) * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3, seed: int = 42) -> DataFrame:
    """``key`` and fp (the bits as a signed long) of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text"):
            found = np.fromiter((fingerprint(x, words, seed) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(sign, "key bigint, fp bigint").withColumnRenamed("key", key)


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks of 64 bits, as signed longs."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(BITS)]
    masks = [sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _linked_in(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join all of ``fps`` linked within the radius: a spanning forest."""
    n = len(fps)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        ra, rb = root(int(a)), root(int(b))
        if ra != rb:
            parent[rb] = ra
            edges.append((int(a), int(b)))
    return edges


def links(nodes: DataFrame, radius: int = 2, most: int = 128) -> DataFrame:
    """u, v: edges that connect exactly the fingerprints ``nodes.fp`` (distinct)
    that links of at most ``radius`` bits connect."""
    if radius % 2:
        raise ValueError("the exact way for large buckets needs an even radius")
    masks = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("k")) for t, m in enumerate(covering_masks(radius))))
    keyed = nodes.select("fp", F.explode(masks).alias("m")).select("fp", "m.t", "m.k")
    shared = written(keyed.groupBy("t", "k").count().where("count > 1"), "buckets")
    members = written(keyed.join(shared, ["t", "k"]), "members")

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, k, held = None, None, []

        def flush() -> pa.RecordBatch | None:
            if len(held) < 2:
                return None
            fps = np.array(held, dtype=np.int64)
            found = _linked_in(fps.view(np.uint64), radius)
            u, v = (pa.array([held[e[i]] for e in found], pa.int64()) for i in (0, 1))
            return pa.RecordBatch.from_arrays([u, v], ["u", "v"])

        for batch in batches:
            for fp, t2, k2 in zip(*(batch.column(x).to_pylist() for x in ("fp", "t", "k")), strict=True):
                if (t2, k2) != (t, k):
                    if out := flush():
                        yield out
                    t, k, held = t2, k2, []
                held.append(fp)
        if out := flush():
            yield out

    light = members.where(F.col("count") <= most).select("fp", "t", "k")
    light = light.repartition("t", "k").sortWithinPartitions("t", "k", "fp").mapInArrow(small, "u bigint, v bigint")
    heavy = members.where(F.col("count") > most).select("fp").distinct()
    near = heavy.select("fp", F.explode(_within(F.col("fp"), radius // 2)).alias("at"))
    # A fingerprint of its own list meets nodes up to radius/2 away; two nodes in
    # one list are at most radius apart.
    stars = near.groupBy("at").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1")
    star = near.join(stars, "at").where("fp <> u").select("u", F.col("fp").alias("v"))
    return light.union(star).distinct()


def _within(fp: Column, bits: int) -> Column:
    """All values at most ``bits`` bit flips away, as an array."""
    flips = [0]
    for _ in range(bits):
        flips = sorted({x ^ (1 << i) for x in flips for i in range(BITS)} | set(flips))
    return F.array(*(fp.bitwiseXOR(F.lit(x - (1 << 64) if x >> 63 else x).cast("bigint")) for x in flips))


def components(edges: DataFrame, salts: int = 16) -> DataFrame:
    """node, label: the smallest node that the undirected edges (u, v) reach.

    Each round takes the least label among a node's neighbours, then the label
    of that label, so the rounds grow with the logarithm of a chain's length.
    The table of labels is salted where it is looked up by label, as one
    component may hold a large part of the nodes.
    """
    both = written(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    while True:
        offered = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("offer"))
        stepped = labels.join(offered.withColumnRenamed("u", "node"), "node", "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("offer", "label")).alias("label"))
        stepped = written(stepped, "labels")
        salt = F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")
        jump = stepped.where("label < node").select(F.col("node").alias("label"), F.col("label").alias("next"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
        jumped = stepped.withColumn("_salt", salt).join(jump, ["label", "_salt"], "left")
        after = written(jumped.select("node", "was", F.coalesce("next", "label").alias("label")), "labels")
        changed = after.where("label <> was").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """``key``, fp and component_id (the smallest id that links reach) of every row."""
    signed = written(fingerprints(docs, text, key, words, seed), "fingerprints")
    nodes = written(signed.groupBy("fp").agg(F.min(key).alias("least"), F.count("*").alias("n")), "nodes")
    labels = components(links(nodes.select("fp"), radius))
    joined = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    classes = written(joined.where("label is not null or n > 1").select("fp", F.coalesce("label", "fp").alias("label"), "least"), "classes")
    names = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    # One row for each fingerprint that has company; the rows of a hot one are
    # on the other side, whose partitions adaptive execution splits.
    salt, salts = "_salt", 16
    named = classes.withColumn(salt, F.pmod(F.xxhash64("fp"), F.lit(salts)).cast("int")).join(names.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["label", salt])
    company = written(named.select("fp", "component_id"), "company")
    return signed.join(company, "fp", "left").select(key, "fp", F.coalesce("component_id", key).alias("component_id"))
