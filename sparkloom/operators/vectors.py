"""Vectors: nearest neighbours of a query set, gap scores, farthest-point samples
and a deterministic hashing embedder."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T

#: Query vectors that are matched at once.
BLOCK = 2048
#: Rows that are held against them at once.
PART = 1024


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def knn(queries: DataFrame, vectors: DataFrame, k: int = 5, vector: str = "embedding", key: str = "vec_id", euclidean: bool = True) -> DataFrame:
    """query, neighbour, distance of the ``k`` nearest other rows of each query row.

    The query set is matched in blocks of fixed size against every partition,
    which keeps its k best of each query; the merge sees k rows a query and
    partition. Ties go to the smaller id.
    """
    q = queries.where(F.col(vector).isNotNull()).select(key, vector)
    rows = vectors.where(F.col(vector).isNotNull()).select(key, vector)
    spark, found = vectors.sparkSession, None
    n = q.count()
    for block in range(-(-n // BLOCK)):
        part = q.where(F.pmod(F.xxhash64(key), F.lit(-(-n // BLOCK))) == block) if n > BLOCK else q
        table = part.orderBy(key).toArrow()
        held = spark.sparkContext.broadcast((table[key].to_numpy(), _matrix(table[vector].combine_chunks())))

        def near(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            ids, matrix = held.value
            best_d, best_i = np.full((len(ids), 0), np.inf), np.zeros((len(ids), 0), dtype=np.int64)
            for batch in (b.slice(at, PART) for b in batches for at in range(0, len(b), PART)):
                own, other = batch.column(0).to_numpy(), _matrix(batch.column(1))
                if euclidean:
                    d = np.sqrt(np.maximum((matrix**2).sum(1)[:, None] + (other**2).sum(1)[None, :] - 2 * matrix @ other.T, 0))
                else:
                    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-10)
                    d = 1 - unit(matrix) @ unit(other).T
                d[ids[:, None] == own[None, :]] = np.inf
                d, i = np.hstack([best_d, d]), np.hstack([best_i, np.broadcast_to(own, d.shape)])
                order = np.lexsort((i, np.round(d, 12)), axis=1)[:, :k]
                best_d, best_i = np.take_along_axis(d, order, 1), np.take_along_axis(i, order, 1)
            at, slot = np.nonzero(np.isfinite(best_d))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(best_i[at, slot], pa.int64()), pa.array(best_d[at, slot])], ["query", "neighbour", "distance"])

        part = rows.mapInArrow(near, "query bigint, neighbour bigint, distance double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query bigint, neighbour bigint, distance double")
    best = F.slice(F.array_sort(F.collect_list(F.struct(F.round("distance", 12).alias("r"), "neighbour", "distance"))), 1, k)
    return found.groupBy("query").agg(best.alias("b")).select("query", F.explode("b").alias("b")).select("query", "b.neighbour", "b.distance")


def gap_scores(queries: DataFrame, vectors: DataFrame, k: int = 5, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and the mean distance to the ``k`` nearest others, fewer where there are fewer; NaN where there are none."""
    near = knn(queries, vectors, k, vector, key).groupBy(F.col("query").alias(key)).agg(F.avg("distance").alias("gap"))
    return queries.where(F.col(vector).isNotNull()).select(key).join(near, key, "left").select(key, F.coalesce("gap", F.lit(float("nan"))).alias("gap"))


def lonely(queries: DataFrame, vectors: DataFrame, distance: float = 0.20, most: int = 10, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The ``most`` loneliest query rows: nearest other further than ``distance``."""
    near = knn(queries, vectors, 1, vector, key)
    return near.where(F.col("distance") > distance).orderBy(F.desc(F.round("distance", 9)), "query").limit(most)


# -- farthest points ----------------------------------------------------------


def fps_cosine(ids: list, vectors: np.ndarray, quality: np.ndarray, k: int, alpha: float = 1.0, min_quality: float = 0.0, novelty: float = 0.0) -> list[tuple]:
    """(id, rank, distance) of a lazy-greedy sample that starts with the best
    quality and then takes the largest cosine distance x quality^alpha.

    Distances to the sample only shrink, so an old bound that still leads after
    it is renewed is exact. Quality is floored at .01.
    """
    at = np.flatnonzero(quality >= min_quality)
    if not len(at) or k <= 0:
        return []
    unit = vectors[at] / np.maximum(np.linalg.norm(vectors[at], axis=1, keepdims=True), 1e-10)
    if len(at) <= k:
        return [(ids[i], r, 1.0) for r, i in enumerate(at)]
    weight = np.maximum(quality[at], 0.01) ** alpha
    start = int(np.argmax(quality[at]))
    chosen, distance = [(start, 1.0)], 1 - unit @ unit[start]
    fresh = np.ones(len(at), dtype=np.int64)
    heap = [(-float(distance[i] * weight[i]), i) for i in range(len(at)) if i != start]
    heapq.heapify(heap)
    while heap and len(chosen) < k:
        _, i = heapq.heappop(heap)
        if fresh[i] < len(chosen):
            new = 1 - max(float(unit[i] @ unit[j]) for j, _ in chosen[fresh[i] :])
            distance[i], fresh[i] = min(distance[i], new), len(chosen)
            heapq.heappush(heap, (-float(distance[i] * weight[i]), i))
        elif distance[i] >= novelty:
            chosen.append((i, float(distance[i])))
    return [(ids[at[i]], r, d) for r, (i, d) in enumerate(chosen)]


def fps_euclidean(vectors: np.ndarray, quality: np.ndarray, k: int, alpha: float = 1.0) -> list[int]:
    """Row numbers: best quality first, then the largest distance^alpha x quality."""
    n = len(vectors)
    if not 1 <= k <= n:
        raise ValueError(f"k must be between 1 and {n}")
    chosen = [int(np.argmax(quality))]
    distance = np.linalg.norm(vectors - vectors[chosen[0]], axis=1)
    while len(chosen) < k:
        score = distance**alpha * quality
        score[chosen] = -np.inf
        chosen.append(int(np.argmax(score)))
        distance = np.minimum(distance, np.linalg.norm(vectors - vectors[chosen[-1]], axis=1))
    return chosen


def fps_sample(df: DataFrame, k: int, vector: str = "embedding", key: str = "vec_id", quality: str = "quality", alpha: float = 1.0, shard_rows: int = 1024, min_quality: float = 0.0, euclidean: bool = False) -> DataFrame:
    """``key``, rank and novelty of a quality-weighted farthest-point sample: that of fps_cosine over all rows, or
    of fps_euclidean, by distance^alpha x quality and with k from 1 to the number of rows.

    A round takes the ``shard_rows`` rows of largest distance x quality^alpha to
    the points so far. Scores only shrink, so points are chosen among these while
    they are ahead of all rows left out; then the next round begins.
    """
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("v"), F.col(quality).cast("double").alias("q"))
    rows = rows.where((F.col("q") >= min_quality) & ~F.isnan("q"))
    schema = f"{key} {kind}, rank bigint, novelty double"
    least = rows.select("id").limit(max(k, 0) + 1).count()
    if euclidean and not 1 <= k <= least:
        raise ValueError(f"k must be between 1 and {least}")
    if least <= k and not euclidean:
        return spark.createDataFrame([(r["id"], i, 1.0) for i, r in enumerate(rows.select("id").orderBy("id").limit(k).collect())] if k > 0 else [], schema)
    unit = lambda m: m if euclidean else m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-10)

    def apart(own: np.ndarray, points: np.ndarray) -> np.ndarray:
        """The distance of each row to the nearest point."""
        if not euclidean:
            return 1 - (own @ points.T).max(axis=1)
        out = np.full(len(own), np.inf)
        for p in points:
            out = np.minimum(out, np.linalg.norm(own - p, axis=1))
        return out

    def worth(d: np.ndarray, q: np.ndarray) -> np.ndarray:
        return d**alpha * q if euclidean else d * np.maximum(q, 0.01) ** alpha

    start = rows.orderBy(F.desc("q"), "id").first()
    chosen, points = [(start["id"], 0, 1.0)], [unit(np.array([start["v"]]))[0]]
    while len(chosen) < k:
        held = spark.sparkContext.broadcast(np.array(points))

        def far(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                d = apart(unit(_matrix(batch.column("v"))), held.value)
                score = worth(d, batch.column("q").to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d), pa.array(score)], [*batch.schema.names, "d", "score"])

        scored = rows.mapInArrow(far, f"id {kind}, v array<double>, q double, d double, score double")
        scored = scored.where((F.col("d") >= 0) & ~F.col("id").isin([c[0] for c in chosen]))
        best = scored.orderBy(F.desc("score"), "id").limit(shard_rows + 1).collect()
        if not best:
            break
        # The last of a full list bounds all that are not in it.
        bound = (-best[-1]["score"], best[-1]["id"]) if len(best) > shard_rows else None
        ids, d, own = [r["id"] for r in best], np.array([r["d"] for r in best]), unit(np.array([r["v"] for r in best]))
        q = np.array([r["q"] for r in best])
        left = np.ones(len(best), dtype=bool)
        while len(chosen) < k:
            open_ = np.flatnonzero(left & (d >= 0))
            if not len(open_):
                break
            score = worth(d, q)
            at = min(open_.tolist(), key=lambda i: (-score[i], ids[i]))
            if bound is not None and (-score[at], ids[at]) > bound:
                break
            chosen.append((ids[at], len(chosen), float(d[at])))
            points.append(own[at])
            left[at] = False
            d = np.minimum(d, apart(own, own[at][None]))
        if bound is None:
            break
    return spark.createDataFrame(chosen, schema)


class OnlineSampler:
    """Accepts a vector at a time: the first always, then those whose distance to
    the accepted ones reaches the threshold and whose weighted distance is positive."""

    def __init__(self, threshold: float = 0.1, alpha: float = 1.0):
        self.threshold, self.alpha = threshold, alpha
        self.kept: list[np.ndarray] = []

    def offer(self, vector, quality: float) -> tuple[bool, float]:
        v = np.asarray(vector, dtype=np.float64)
        v = v / max(float(np.linalg.norm(v)), 1e-10)
        distance = 1 - max((float(v @ o) for o in self.kept), default=0.0)
        if self.kept and distance < self.threshold:
            return False, distance
        if self.kept and distance * max(quality, 0.01) ** self.alpha <= 0:
            return False, distance
        self.kept.append(v)
        return True, distance


def reservoir(rows: list[tuple], size: int, ratio: float, alpha: float = 1.0) -> list[tuple]:
    """(id, rank, distance) of each full reservoir of (id, vector, quality) rows, max(int(n x ratio), 1) of it."""
    out = []
    for start in range(0, len(rows), size):
        part = rows[start : start + size]
        out += fps_cosine([r[0] for r in part], np.array([r[1] for r in part]), np.array([r[2] for r in part]), max(int(len(part) * ratio), 1), alpha)
    return out


# -- embedding ----------------------------------------------------------------


def mean_pool(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The mean of (rows, tokens, size) states over the tokens of a (rows, tokens) mask; zeros where it is empty."""
    weights = mask.astype(np.float64)[:, :, None]
    return (hidden * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), 1e-9)


def embedded(text: Column, encode: Callable[[list[str]], np.ndarray], batch: int = 64) -> Column:
    """The vectors that ``encode`` gives for batches of texts, scaled to length one.
    A batch that does not fit in memory is halved, down to one text; null gives null."""

    def encoded(texts: list[str]) -> list[np.ndarray]:
        try:
            return list(np.asarray(encode(texts), dtype=np.float64))
        except MemoryError:
            if len(texts) == 1:
                raise
            half = len(texts) // 2
            return encoded(texts[:half]) + encoded(texts[half:])

    @F.arrow_udf("array<float>")
    def made(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        out: list[list[float] | None] = [None] * len(rows)
        at = [i for i, x in enumerate(rows) if x is not None]
        for start in range(0, len(at), batch):
            part = at[start : start + batch]
            for i, v in zip(part, encoded([rows[i] for i in part]), strict=True):
                out[i] = (v / max(float(np.linalg.norm(v)), 1e-10)).tolist()
        return pa.array(out, pa.list_(pa.float32()))

    return made(text)


def hashed_embedding(text: Column, size: int = 64) -> Column:
    """A deterministic embedding: word counts added up by hash and scaled to length one."""
    words = T.tokens(F.coalesce(text, F.lit("")))
    slots = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(size)).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter(slots, lambda s: s == i)).cast("double"))
    norm = F.greatest(F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-10))
    return F.transform(counts, lambda x: (x / norm).cast("float"))


