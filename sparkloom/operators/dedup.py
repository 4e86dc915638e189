"""Duplicates of documents: by URL, by content hash, by SimHash, by MinHash, by
embedding, and these in order.

"Earlier" means a smaller id. A document is compared with all earlier ones, so
in a chain A~B~C both B and C are duplicates although A and C differ.
Rows with equal signatures are joined once, through their first document.

Texts too short for a signature (no word, under five characters) have the zero
signature, and so are alike; null texts and ids are no documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import url as U
from sparkloom.store import reused

try:
    # CPython's own, without the cost of OpenSSL's set-up for each short text.
    from _md5 import md5
except ImportError:
    from hashlib import md5

WORDS = re.compile(r"\b\w+\b")
#: Grams whose bits are added up at once.
BLOCK = 1 << 14


# -- exact ------------------------------------------------------------------


def first_per_key(df: DataFrame, key: Column, order: Column, kept: str = "_first") -> DataFrame:
    """The row of least ``order`` (unique) for each key. The aggregate is partial
    before the shuffle, so a key that many rows share costs one row a task."""
    keyed = df.withColumn("_key", key).withColumn(kept, order)
    names = df.columns
    best = keyed.groupBy("_key").agg(F.min_by(F.struct(*names), kept).alias("row"))
    return best.select("row.*")


def url_dedup(df: DataFrame, url: str = "url", order: str = "page_id") -> DataFrame:
    """canonical_url and the first row's id for each; without nulls."""
    c = df.where(F.col(url).isNotNull()).withColumn("canonical_url", U.canonical(F.col(url)))
    return c.groupBy("canonical_url").agg(F.min(order).alias(order), F.count("*").alias("n_rows"))


def exact_groups(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """content_hash, first id and size of each group of equal texts with two rows or more."""
    return df.groupBy(F.md5(F.col(text)).alias("content_hash")).agg(F.min(key).alias("first_id"), F.count("*").alias("n_docs")).where("n_docs > 1")


# -- SimHash ----------------------------------------------------------------


def simhash_value(text: str | None) -> int:
    """64 bits from md5 of word 3-grams and words: a bit is set if more tokens have it than not."""
    words = WORDS.findall((text or "").lower())
    if not words:
        return 0
    # Words have no spaces, so they can be encoded at once.
    coded = " ".join(words).encode("utf-8", "surrogatepass").split(b" ")
    grams = Counter(coded)
    grams.update(map(b" ".join, zip(coded, coded[1:], coded[2:], strict=False)))
    ones, total, rest = np.zeros(64), 0, iter(grams.items())
    while part := list(islice(rest, BLOCK)):
        raw = np.frombuffer(b"".join([md5(g).digest() for g, _ in part]), dtype=np.uint8).reshape(-1, 16)[:, :8]
        times = np.fromiter((n for _, n in part), np.float32, len(part))
        ones += times @ np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
        total += int(times.sum())
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<i8")[0])


def simhash(text: Column) -> Column:
    """The fingerprint column of a text column."""

    @F.arrow_udf("bigint")
    def sign(texts: pa.Array) -> pa.Array:
        return pa.array([simhash_value(x) for x in texts.to_pylist()], pa.int64())

    return sign(text)


def block_keys(fp: Column, blocks: int = 6, kept: int = 3, bits: int = 64) -> Column:
    """(table, key) pairs: fingerprints that differ in at most blocks - kept bits share one."""
    cuts = [round(i * bits / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), kept):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*(F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(m).cast("bigint")).alias("k")) for i, m in enumerate(masks)))


def _bucket_links(least_only: bool, threshold: int):
    """For rows (t, k, fp, id) sorted by bucket: the links inside each, or of each
    fingerprint that with the smallest id if it is smaller than its own. In blocks."""

    def found(fps: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 20) // len(fps))
        for low in range(0, len(fps), step):
            d = np.bitwise_count(fps[low : low + step, None] ^ fps[None, :])
            near = (d <= threshold) & (ids[low : low + step, None] > ids[None, :])
            if least_only:
                # Sorted by id, so the first is the smallest.
                i = np.flatnonzero(near.any(axis=1))
                j = near[i].argmax(axis=1)
            else:
                i, j = np.nonzero(near)
            if len(i):
                at = low + i
                columns = (fps[at].view(np.int64), fps[j].view(np.int64), ids[at], ids[j], d[i, j].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fp", "fp2", "id", "id2", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            own = [batch.column(c).to_numpy() for c in ("t", "k", "fp", "id")]
            rest = own if rest is None else [np.concatenate(x) for x in zip(rest, own, strict=True)]
            new = np.flatnonzero((rest[0][1:] != rest[0][:-1]) | (rest[1][1:] != rest[1][:-1])) + 1
            # The last bucket may go on in the next batch.
            for a, b in pairwise([0, *new.tolist()]):
                if b - a > 1:
                    yield from found(rest[2][a:b].view(np.uint64), rest[3][a:b])
            last = int(new[-1]) if len(new) else 0
            rest = [x[last:] for x in rest]
        if rest is not None and len(rest[0]) > 1:
            yield from found(rest[2].view(np.uint64), rest[3])

    return run


def _simhash_links(nodes: DataFrame, threshold: int, least_only: bool, most: int = 256) -> DataFrame:
    """fp, fp2, id, id2 (smaller) and distance of links between ``nodes`` (fp, id).

    Fingerprints meet where half of their blocks are equal. A bucket of over
    ``most`` is dealt again by its other blocks: these are cut finer, so that
    linked fingerprints still agree on 52 bits or so and at most a few thousand
    different ones can meet, however many rows the bucket has.
    """
    keyed = nodes.withColumn("m", F.explode(block_keys(F.col("fp"), threshold + 3, 3))).select("fp", "id", F.col("m.t").alias("t"), F.col("m.k").alias("k"))
    large = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > most).select("t", "k", F.lit(True).alias("_large"))
    keyed = keyed.join(large, ["t", "k"], "left")
    pieces = 2 * threshold + 3
    finer = F.explode(block_keys(F.col("fp"), pieces, pieces - threshold))
    again = keyed.where("_large").select("fp", "id", F.col("t").alias("t0"), F.col("k").alias("k0"), finer.alias("m"))
    again = again.select("fp", "id", (1000 + F.col("m.t") + 10_000 * F.col("t0")).alias("t"), F.xxhash64("k0", "m.k").alias("k"))
    buckets = keyed.where("_large is null").select("fp", "id", F.col("t").cast("int").alias("t"), "k").unionByName(again.select("fp", "id", F.col("t").cast("int").alias("t"), "k"))
    met = buckets.select("t", "k", "fp", F.col("id").cast("bigint").alias("id")).repartition("t", "k").sortWithinPartitions("t", "k", "id")
    return met.mapInArrow(_bucket_links(least_only, threshold), "fp bigint, fp2 bigint, id bigint, id2 bigint, distance int")


def simhash_pairs(signed: DataFrame, key: str = "doc_id", threshold: int = 3) -> DataFrame:
    """a < b and distance of the first documents of every two different
    fingerprints at most ``threshold`` apart; no pair is missed."""
    nodes = signed.where(F.col("fp").isNotNull() & F.col(key).isNotNull()).groupBy("fp").agg(F.min(key).alias("id"))
    near = _simhash_links(nodes, threshold, False).distinct()
    return near.select("fp", "fp2", F.col("id2").alias("a"), F.col("id").alias("b"), "distance")


def simhash_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: int = 3) -> DataFrame:
    """``key``, duplicate_of (the first earlier document near it) and similarity of each near-duplicate."""
    rows = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull())
    signed = reused(rows.select(key, simhash(F.col(text)).alias("fp")))
    first = reused(signed.groupBy("fp").agg(F.min(key).alias("id"), F.count("*").alias("n")))
    near = _simhash_links(first.select("fp", "id"), threshold, True).select("fp", F.col("id2").alias("duplicate_of"), "distance")
    # A fingerprint's first document is near to all its others.
    near = near.unionByName(first.where("n > 1").select("fp", F.col("id").cast("bigint").alias("duplicate_of"), F.lit(0).alias("distance")))
    best = near.groupBy("fp").agg(F.min(F.struct("duplicate_of", "distance")).alias("best"))
    hit = signed.join(best, "fp").where(F.col("best.duplicate_of") < F.col(key))
    return hit.select(key, F.col("best.duplicate_of").alias("duplicate_of"), (1 - F.col("best.distance") / 64).alias("similarity"))


# -- MinHash ----------------------------------------------------------------

PRIME = (1 << 61) - 1


def permutations(n: int = 128, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**31 - 1, n, dtype=np.uint64), rng.integers(0, 2**31 - 1, n, dtype=np.uint64)


def _least(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of (a x + b) modulo PRIME for each a and b; a x + b is under 2^63."""
    out, prime = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64), np.uint64(PRIME)
    values, rest = np.empty((2, min(len(x), 256), len(a)), dtype=np.uint64)
    for start in range(0, len(x), 256):
        part = x[start : start + 256, None]
        v, high = values[: len(part)], rest[: len(part)]
        np.multiply(part, a, out=v)
        v += b
        np.right_shift(v, np.uint64(61), out=high)
        v &= prime
        v += high
        # Below PRIME the difference wraps to a larger number.
        np.minimum(v, np.subtract(v, prime, out=high), out=v)
        np.minimum(out, v.min(axis=0), out=out)
    return out


def _gram_hash(grams: Iterable[str]) -> np.ndarray:
    return np.frombuffer(b"".join([md5(g.encode("utf-8", "surrogatepass")).digest() for g in grams]), dtype="<u4")[::4].astype(np.uint64)


def minhash_value(text: str | None, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least permuted hash of the distinct character 5-grams, per permutation; zeros under 5 characters."""
    t = (text or "").lower()
    grams = {t[i : i + 5] for i in range(len(t) - 4)}
    if not grams:
        return np.zeros(len(a), dtype=np.int64)
    return _least(_gram_hash(grams), a, b).astype(np.int64)


class Signer:
    """minhash_value() of many texts: grams are packed into words of five 12-bit letters, and
    the hashes of up to ``most`` of them are kept. Texts with letters beyond the first 4095 go
    by minhash_value()."""

    def __init__(self, n: int = 128, seed: int = 42, most: int = 1 << 20):
        self.a, self.b = permutations(n, seed)
        self.most = most
        self.code = np.zeros(0x110000, dtype=np.uint64)
        self.letters = np.zeros(1, dtype="<u4")
        none = np.zeros(0, dtype=np.uint64)
        #: Sorted grams and their hashes: many, and those since, which are few.
        self.kept, self.fresh = (none, none), (none, none)

    def _coded(self, points: np.ndarray) -> np.ndarray | None:
        codes = self.code[points]
        if not codes.all():
            new = np.unique(points[codes == 0])
            if len(self.letters) + len(new) > 4096:
                return None
            self.code[new] = np.arange(len(self.letters), len(self.letters) + len(new), dtype=np.uint64)
            self.letters = np.concatenate([self.letters, new])
            codes = self.code[points]
        return codes

    def _hashes(self, grams: np.ndarray) -> np.ndarray:
        """The hashes of sorted distinct grams."""
        out, missing = np.empty(len(grams), dtype=np.uint64), np.ones(len(grams), dtype=bool)
        for known, hashed in (self.kept, self.fresh):
            if len(known):
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                hit = known[at] == grams
                out[hit] = hashed[at[hit]]
                missing &= ~hit
        if missing.any():
            new = grams[missing]
            shifts = np.arange(48, -1, -12, dtype=np.uint64)
            points = self.letters[(new[:, None] >> shifts) & np.uint64(4095)]
            text = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            out[missing] = _gram_hash(text[i : i + 5] for i in range(0, len(text), 5))
            self.fresh = self._merged(self.fresh, (new, out[missing]))
            if len(self.fresh[0]) > 1 << 14:
                room = len(self.kept[0]) + len(self.fresh[0]) <= self.most
                self.kept = self._merged(self.kept, self.fresh) if room else self.fresh
                self.fresh = (self.fresh[0][:0], self.fresh[1][:0])
        return out

    @staticmethod
    def _merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(one[0], two[0])
        return np.insert(one[0], at, two[0]), np.insert(one[1], at, two[1])

    def __call__(self, text: str | None) -> np.ndarray:
        t = (text or "").lower()
        if len(t) < 5:
            return np.zeros(len(self.a), dtype=np.int64)
        c = self._coded(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4"))
        if c is None:
            return minhash_value(text, self.a, self.b)
        grams = c[:-4]
        for i in range(1, 5):
            grams = (grams << np.uint64(12)) | c[i : len(c) - 4 + i]
        return _least(self._hashes(np.unique(grams)), self.a, self.b).view(np.int64)


def minhash(text: Column, n: int = 128, seed: int = 42) -> Column:
    held: list[Signer] = []

    @F.arrow_udf("array<bigint>")
    def sign(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Signer(n, seed))
        flat = np.concatenate([np.zeros(0, dtype=np.int64), *map(held[0], texts.to_pylist())])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * n), pa.array(flat))

    return sign(text)


def jaccard(a: Column, b: Column) -> Column:
    """The share of equal entries of two signatures."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return equal / F.size(a)


def _small(sigs: np.ndarray) -> np.ndarray:
    """A byte of each entry. Its first bits are the sketch: signatures with a share s of
    entries equal agree in s + (1 - s) / 2 of these."""
    return (sigs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8)


def _words(small: np.ndarray) -> np.ndarray:
    """The sketches of bytes of entries, word by word."""
    return np.ascontiguousarray(np.packbits(small >> 7, axis=1).view(np.uint64).T)


def _apart(n: int, threshold: float) -> int:
    """Differing sketch bits that a pair at the threshold exceeds with a probability of 3e-5 at most: four
    standard deviations over the mean."""
    free = n - math.ceil(threshold * n - 1e-9)
    return math.ceil(free / 2 + 4 * math.sqrt(free) / 2)


def _matrix(sigs: pa.Array, n: int) -> np.ndarray:
    return sigs.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, n)


def _signed(docs: DataFrame, text: str, key: str, n: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows as ``key`` and the two halves h, g of a 128-bit hash of the signature; and
    id (the first row), h, g and sig of each signature."""
    rows = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(key, minhash(F.col(text), n, seed).alias("sig"))
    rows = reused(rows.select(key, "sig", F.xxhash64("sig").alias("h"), F.xxhash64(F.lit(1), "sig").alias("g")))
    return rows, reused(rows.groupBy("h", "g").agg(F.min(key).cast("bigint").alias("id"), F.first("sig").alias("sig")))


def _met(apart: int):
    """For rows (t, k, id, bound, sketch) sorted by bucket and id: (id, id2) where the
    earlier id2 is under the row's bound and the sketches are near."""

    def met(batches):
        names, rest = ("t", "k", "id", "bound"), None
        for batch in batches:
            cols = [batch.column(x).to_numpy() for x in names]
            cols.append(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(batch), -1))
            rest = cols if rest is None else [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            t, k = rest[0], rest[1]
            if not len(t):
                continue
            # The last bucket may go on in the next batch.
            cut = int(np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (k[1:] != k[:-1])])[-1])
            done, rest = [x[:cut] for x in rest], [x[cut:] for x in rest]
            if cut:
                yield from paired(*done)
        if rest is not None and len(rest[0]):
            yield from paired(*rest)

    def paired(t, k, ids, bound, sketch):
        for a, b in _eligible(t, k, ids, np.minimum(ids, bound), sketch, apart):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["id", "id2"])

    return met


def _eligible(t: np.ndarray, k: np.ndarray, ids: np.ndarray, limits: np.ndarray, sketches: np.ndarray, apart: int, most: int = 1 << 21):
    """(id, earlier id) of rows, sorted by (t, k, id), that share t and k, where the
    earlier id is under the row's limit and the sketches are near; in blocks."""
    new = np.r_[True, (t[1:] != t[:-1]) | (k[1:] != k[:-1])]
    bucket = np.cumsum(new) - 1
    start = np.flatnonzero(new)[bucket]
    values = np.unique(np.concatenate([ids, limits]))
    place = bucket * len(values) + np.searchsorted(values, ids)
    count = np.searchsorted(place, bucket * len(values) + np.searchsorted(values, limits)) - start
    left = np.flatnonzero(count)
    total = np.cumsum(count[left])
    at = 0
    while at < len(left):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right")))
        part = left[at:stop]
        many = count[part]
        a = np.repeat(part, many)
        b = np.repeat(start[part], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        near = np.bitwise_count(sketches[a] ^ sketches[b]).sum(axis=1, dtype=np.int64) <= apart
        yield ids[a[near]], ids[b[near]]
        at = stop


class _Block:
    """Signatures by id, with what decides whether others are alike: sketches, bytes of entries, entries."""

    def __init__(self, ids: np.ndarray, sigs: np.ndarray, threshold: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.sigs = ids[order], sigs[order]
        self.small = _small(self.sigs)
        self.words = _words(self.small)
        self.apart, self.need = _apart(sigs.shape[1], threshold), math.ceil(threshold * sigs.shape[1] - 1e-9)

    def alike(self, other: _Block, i: int, low: int, high: int, first: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Places from low to high of signatures alike to the other's i-th, and how many entries are equal."""
        differ = sum(np.bitwise_count(own[low:high] ^ theirs[i]) for own, theirs in zip(self.words, other.words, strict=True))
        near = np.flatnonzero(differ <= self.apart) + low
        if len(near):
            # Equal entries have equal bytes.
            same = self.small[near] == other.small[i]
            near = near[np.bitwise_count(same.view(np.uint64)).sum(axis=1, dtype=np.int64) >= self.need]
        for start in range(0, len(near), step := 16 if first else max(len(near), 1)):
            part = near[start : start + step]
            equal = (self.sigs[part] == other.sigs[i]).sum(axis=1)
            good = equal >= self.need
            if good.any() or not first:
                return part[good], equal[good]
        return near[:0], near[:0]


#: Signatures of a block that is read, those that a task compares with it, and those compared at once.
READ, HELD, STEP = 1 << 16, 1 << 15, 1 << 15


def _compared(table: DataFrame, n: int, threshold: float, how: str):
    """For rows (id, sig) what is alike in ``table``, a written one of such rows: ``first``
    gives id, the first smaller id and the share; ``pairs`` id2, id and share of all smaller
    ids; ``links`` id and the number of other ids.

    The table's files are read block by block, in the order of their smallest ids, by each
    task for up to HELD rows, so nothing is dealt or joined and no pair is missed but by its sketch.
    """
    found = table.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min("id").alias("least")).orderBy("least", "path")
    files = [(r["path"], r["least"]) for r in found.collect()]

    def blocks() -> Iterator[tuple[int, _Block]]:
        """Blocks with the smallest id from each on."""
        parts, least = [], 0

        def whole() -> _Block:
            return _Block(*(np.concatenate(x) for x in zip(*parts, strict=True)), threshold)

        for path, start in files:
            system, name = fs.FileSystem.from_uri(path)
            with system.open_input_file(name) as stream:
                for batch in pq.ParquetFile(stream).iter_batches(READ // 2, columns=["id", "sig"]):
                    least = least if parts else start
                    parts.append((batch.column("id").to_numpy(), _matrix(batch.column("sig"), n)))
                    if sum(len(x[0]) for x in parts) > READ // 2:
                        yield least, whole()
                        parts = []
        if parts:
            yield least, whole()

    def firsts(own: _Block) -> pa.RecordBatch:
        bound, share = own.ids.copy(), np.zeros(len(own.ids))
        for least, block in blocks():
            if least >= bound.max():
                break
            stop = np.searchsorted(block.ids, bound)
            for i in np.flatnonzero(stop):
                low, step = 0, 2048
                while low < stop[i]:
                    at, equal = block.alike(own, i, low, min(low + step, stop[i]), True)
                    if len(at):
                        bound[i], share[i] = block.ids[at[0]], equal[0] / n
                        break
                    low, step = low + step, min(2 * step, STEP)
        hit = bound < own.ids
        return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (own.ids, bound, share)], ["id", "duplicate_of", "similarity"])

    def pairs(own: _Block) -> Iterator[pa.RecordBatch]:
        for least, block in blocks():
            if least >= own.ids[-1]:
                break
            for i, stop in enumerate(np.searchsorted(block.ids, own.ids)):
                for low in range(0, stop, STEP):
                    at, equal = block.alike(own, i, low, min(low + STEP, stop))
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(block.ids[at]), pa.array(np.repeat(own.ids[i], len(at))), pa.array(equal / n)], ["id2", "id", "similarity"])

    def links(own: _Block) -> pa.RecordBatch:
        total = np.zeros(len(own.ids), dtype=np.int64)
        for _, block in blocks():
            for i in range(len(own.ids)):
                for low in range(0, len(block.ids), STEP):
                    at, _ = block.alike(own, i, low, low + STEP)
                    total[i] += np.count_nonzero(block.ids[at] != own.ids[i])
        return pa.RecordBatch.from_arrays([pa.array(own.ids), pa.array(total)], ["id", "n_links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def done() -> Iterator[pa.RecordBatch]:
            own = _Block(np.concatenate([x.column("id").to_numpy() for x in held]), np.concatenate([_matrix(x.column("sig"), n) for x in held]), threshold)
            if how == "pairs":
                yield from pairs(own)
            else:
                yield firsts(own) if how == "first" else links(own)

        for batch in batches:
            held += [batch] * (len(batch) > 0)
            if sum(map(len, held)) >= HELD:
                yield from done()
                held = []
        if held:
            yield from done()

    return run


def minhash_pairs(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.5, n: int = 128, seed: int = 42) -> DataFrame:
    """a < b and similarity of pairs at least ``threshold`` alike. Different signatures
    are joined through their first documents; every further document of a signature
    has a pair with its first, of similarity 1, which is its membership."""
    rows, nodes = _signed(docs, text, key, n, seed)
    near = nodes.select("id", "sig").mapInArrow(_compared(nodes, n, threshold, "pairs"), "id2 bigint, id bigint, similarity double")
    copies = rows.join(nodes.select("h", "g", "id"), ["h", "g"]).where(F.col("id") < F.col(key))
    return near.select(F.col("id2").alias("a"), F.col("id").alias("b"), "similarity").unionByName(copies.select(F.col("id").alias("a"), F.col(key).alias("b"), F.lit(1.0).alias("similarity")))


def minhash_links(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.5, n: int = 128, seed: int = 42) -> DataFrame:
    """Of each document ``key``, class_id (the first document of its signature) and n_links, the
    number of other classes at least ``threshold`` alike: as many rows as documents."""
    rows, nodes = _signed(docs, text, key, n, seed)
    found = nodes.select("id", "sig").mapInArrow(_compared(nodes, n, threshold, "links"), "id bigint, n_links bigint")
    member = nodes.select("h", "g", "id").join(found, "id")
    return rows.select(key, "h", "g").join(member, ["h", "g"]).select(key, F.col("id").alias("class_id"), "n_links")


def minhash_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.5, n: int = 128, seed: int = 42) -> DataFrame:
    """``key``, duplicate_of and similarity: the first earlier document at least ``threshold`` alike.

    Most documents have one among the first few thousand and are then done; the
    others are compared with all earlier ones.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull())
    signed = reused(rows.select(F.col(key).cast("bigint").alias("id"), minhash(F.col(text), n, seed).alias("sig")))
    found = signed.mapInArrow(_compared(signed, n, threshold, "first"), "id bigint, duplicate_of bigint, similarity double")
    return found.select(F.col("id").alias(key), "duplicate_of", "similarity")


# -- embeddings -------------------------------------------------------------


def unit(vector: Column) -> Column:
    """The vector scaled to length one."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-10))
    return F.transform(v, lambda x: x / norm)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


#: Random vectors that a bucket of cosine_pairs() holds, about, and bits of its sketches.
CROWD, SKETCH = 1024, 128


def planes_for(rows: int, threshold: float, miss: float = 1e-4) -> tuple[int, int]:
    """Bits a table and tables, so that a pair at the threshold is missed with
    probability ``miss`` at most and a bucket of random vectors stays small."""
    bits = max(6, math.ceil(math.log2(max(rows, 2) / CROWD)))
    same = 1 - math.acos(min(1.0, threshold)) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - same**bits)))


def cosine_pairs(vectors: DataFrame, threshold: float = 0.95, vector: str = "embedding", key: str = "vec_id", seed: int = 42, inclusive: bool = False) -> DataFrame:
    """a < b and similarity of pairs above the threshold; equal vectors go through
    their first row.

    Vectors meet in buckets of signs of projections. In a bucket 128-bit sketches
    of further signs are compared in blocks, and only pairs whose sketches differ
    in no more bits than a pair at the threshold does (four standard deviations
    over its mean, so 3e-5 are missed) are compared in full.
    """
    nodes = reused(vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).groupBy(vector).agg(F.min(key).cast("bigint").alias("id")).withColumn("u", unit(F.col(vector))).select("id", "u"))
    bits, tables = planes_for(nodes.count(), threshold)
    held: dict[int, np.ndarray] = {}

    @F.arrow_udf("struct<keys:array<bigint>,sketch:binary>")
    def signs(values: pa.Array) -> pa.Array:
        flat = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1) if len(values) else np.zeros((0, 1))
        if flat.shape[1] not in held:
            held[flat.shape[1]] = np.random.default_rng(seed).standard_normal((flat.shape[1], bits * tables + SKETCH))
        found = flat @ held[flat.shape[1]] > 0
        keys = found[:, : bits * tables].reshape(len(values), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
        offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * tables)
        sketch = np.packbits(found[:, bits * tables :], axis=1).tobytes()
        fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(SKETCH // 8), len(values), [None, pa.py_buffer(sketch)])
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())), fixed.cast(pa.binary())], ["keys", "sketch"])

    share = math.acos(min(1.0, threshold)) / math.pi
    apart = math.ceil(SKETCH * share + 4 * math.sqrt(SKETCH * share * (1 - share)))
    signed = nodes.select("id", signs("u").alias("s")).select("id", F.lit(np.iinfo(np.int64).max).alias("bound"), "s.sketch", F.posexplode("s.keys").alias("t", "k"))
    near = signed.repartition("t", "k").sortWithinPartitions("t", "k", "id").mapInArrow(_met(apart), "id2 bigint, id bigint").distinct()
    near = near.join(nodes, "id").join(nodes.select(F.col("id").alias("id2"), F.col("u").alias("u2")), "id2")
    near = near.select(F.col("id").alias("a"), F.col("id2").alias("b"), dot(F.col("u"), F.col("u2")).alias("similarity"))
    return near.where(F.col("similarity") >= threshold if inclusive else F.col("similarity") > threshold)


def cosine_duplicates(vectors: DataFrame, threshold: float = 0.95, vector: str = "embedding", key: str = "vec_id", keep: str = "first", inclusive: bool = False) -> DataFrame:
    """``key`` of the vectors to drop: those with an earlier (keep="first") or a later (keep="last") one alike."""
    pairs = cosine_pairs(vectors, threshold, vector, key, inclusive=inclusive)
    gone = pairs.select(F.col("b" if keep == "first" else "a").alias(key))
    ends = F.min(key) if keep == "first" else F.max(key)
    ranked = vectors.where(F.col(vector).isNotNull()).groupBy(vector).agg(ends.alias("_kept"), F.min(key).alias("_first"), F.count("*").alias("_n"))
    many = ranked.where("_n > 1")
    copies = vectors.join(many.select(vector, "_kept"), vector).where(F.col(key) != F.col("_kept")).select(key)
    # A dropped first row stands for its equal rows.
    of_gone = gone.join(many, gone[key] == many["_first"]).select(vector)
    equal = vectors.join(of_gone, vector, "left_semi").select(key)
    return gone.union(copies).union(equal).distinct()


def cosine_nearest(vectors: DataFrame, threshold: float = 0.95, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key``, duplicate_of (the most similar earlier row at least ``threshold`` alike, the
    first of equals) and similarity. A copy's most similar is the first row of its vector."""
    pairs = cosine_pairs(vectors, threshold, vector, key, inclusive=True)
    # Rounded, so that ties do not depend on the order of sums.
    best = pairs.groupBy(F.col("b").alias(key)).agg(F.max(F.struct(F.round("similarity", 12).alias("s"), (-F.col("a")).alias("a"))).alias("x"))
    found = best.select(key, (-F.col("x.a")).alias("duplicate_of"), F.col("x.s").alias("similarity"))
    first = vectors.where(F.col(vector).isNotNull()).groupBy(vector).agg(F.min(key).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    # A zero vector is not alike to anything, its copies neither.
    zero = F.forall(vector, lambda x: x == 0)
    copies = vectors.join(first, vector).where((F.col(key) > F.col("_first")) & ~zero).select(key, F.col("_first").alias("duplicate_of"), F.lit(1.0).alias("similarity"))
    return found.unionByName(copies)


def combined(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, reason (simhash before minhash), duplicate_of and similarity."""
    s, m = simhash_duplicates(docs, text, key), minhash_duplicates(docs, text, key)
    both = s.withColumn("r", F.lit(0)).unionByName(m.withColumn("r", F.lit(1)))
    best = both.groupBy(key).agg(F.min_by(F.struct("r", "duplicate_of", "similarity"), "r").alias("x"))
    return best.select(key, F.when(F.col("x.r") == 0, "simhash").otherwise("minhash").alias("reason"), "x.duplicate_of", "x.similarity")


class Bloom:
    """A set with false positives and no false negatives, by double hashing of md5; for probing only."""

    def __init__(self, expected: int, rate: float = 0.01):
        if expected <= 0 or not 0 < rate < 1:
            raise ValueError("expected must be positive and rate between 0 and 1")
        self.m = max(1, int(-expected * math.log(rate) / math.log(2) ** 2))
        self.k = max(1, int(self.m / expected * math.log(2)))
        self.bits = np.zeros(self.m, dtype=bool)
        self.added = 0

    def _at(self, item: str) -> list[int]:
        digest = hashlib.md5(item.encode()).digest()
        one, two = int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:], "big")
        return [(one + i * two) % self.m for i in range(self.k)]

    def add(self, item: str) -> None:
        self.bits[self._at(item)] = True
        self.added += 1

    def __contains__(self, item: str) -> bool:
        return bool(self.bits[self._at(item)].all())

    def __len__(self) -> int:
        return self.added


def stats(found: DataFrame) -> DataFrame:
    """Duplicates per reason."""
    return found.groupBy("reason").agg(F.count("*").alias("n_docs"))


