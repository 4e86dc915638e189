"""The map: projection to two dimensions, density clusters, importance."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S
from sparkloom.operators import monitor


class Projector(Protocol):
    def project(self, df: DataFrame) -> DataFrame: ...


class Clusterer(Protocol):
    def cluster(self, df: DataFrame) -> DataFrame: ...


class AxisScorer(Protocol):
    def axis(self, df: DataFrame) -> DataFrame: ...


class ImportanceAxis:
    """z: the importance of a row's domain, quality and content type."""

    def axis(self, df: DataFrame) -> DataFrame:
        return df.withColumn("z", S.importance(F.col("domain"), F.col("quality_score"), F.col("content_type")))


class PcaProjector:
    """x, y: the first two principal components, each with its largest weight
    positive. Fitted once; later calls project with the same components."""

    def __init__(self, vector: str = "embedding"):
        self.vector, self.components = vector, None

    def project(self, df: DataFrame) -> DataFrame:
        vectors = df.withColumn("_v", array_to_vector(F.transform(F.col(self.vector), lambda x: x.cast("double"))))
        if self.components is None:
            fitted = PCA(k=2, inputCol="_v", outputCol="_p").fit(vectors.where("_v is not null"))
            pc = fitted.pc.toArray()
            self.components = pc * np.where(pc[np.abs(pc).argmax(axis=0), [0, 1]] < 0, -1.0, 1.0)
        axes = [F.array(*(F.lit(float(w)) for w in self.components[:, i])) for i in (0, 1)]
        value = vector_to_array("_v")
        dots = [F.aggregate(F.zip_with(value, a, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v) for a in axes]
        return vectors.withColumns({"x": dots[0], "y": dots[1]}).drop("_v")


def hdbscan(points: np.ndarray, min_size: int = 5, weights: np.ndarray | None = None) -> np.ndarray:
    """Density clusters by excess of mass; -1 is noise. Sizes are capped at max(2, n // 10).
    ``weights``: the rows that each point stands for, of which all sizes are sums."""
    n = len(points)
    if n < 2:
        return np.full(n, -1)
    weights = np.ones(n, dtype=np.int64) if weights is None else weights
    rows = int(weights.sum())
    min_size = max(2, min(min_size, max(2, rows // 10)))
    d = np.sqrt(np.maximum(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2), 0))
    order = np.argsort(d, axis=1)
    enough = (np.cumsum(weights[order], axis=1) >= min(min_size, rows)).argmax(axis=1)
    core = d[np.arange(n), order[np.arange(n), enough]]
    reach = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    # Minimum spanning tree, a vertex at a time.
    inside, best, source = np.zeros(n, dtype=bool), np.full(n, np.inf), np.zeros(n, dtype=int)
    at, tree = 0, []
    for _ in range(n - 1):
        inside[at] = True
        closer = ~inside & (reach[at] < best)
        best[closer], source[closer] = reach[at][closer], at
        at = int(np.where(inside, np.inf, best).argmin())
        tree.append((float(best[at]), int(source[at]), at))
    tree.sort()
    # Single-linkage merges: node n + i joins two nodes.
    parent, label, size, kids, height = list(range(n)), list(range(n)), dict(enumerate(weights.tolist())), {}, {}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (w, a, b) in enumerate(tree):
        ra, rb = root(a), root(b)
        la, lb, new = label[ra], label[rb], n + i
        kids[new], height[new], size[new] = (la, lb), w, size[la] + size[lb]
        parent[rb] = ra
        label[ra] = new

    def leaves(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            x = todo.pop()
            if x < n:
                out.append(x)
            else:
                todo += kids[x]
        return out

    # Condensed tree: a cluster lives until both parts of a split are large enough.
    born, stability, children, first = {0: 0.0}, {0: 0.0}, {0: []}, {0: 2 * n - 2}
    todo, count = [(2 * n - 2, 0)], 1
    while todo:
        node, cluster = todo.pop()
        while node >= n:
            rate = 1 / height[node] if height[node] > 0 else 1e12
            a, b = kids[node]
            big = [x for x in (a, b) if x >= n and size[x] >= min_size]
            if len(big) == 2:
                stability[cluster] += (rate - born[cluster]) * size[node]
                for x in big:
                    born[count], stability[count], children[count], first[count] = rate, 0.0, [], x
                    children[cluster].append(count)
                    todo.append((x, count))
                    count += 1
                break
            lost = sum(size[x] for x in (a, b) if x not in big)
            stability[cluster] += (rate - born[cluster]) * lost
            if not big:
                break
            node = big[0]
    keep = {c: True for c in born}
    for c in sorted(born, reverse=True):
        below = sum(stability[x] for x in children[c])
        if c == 0 or children[c] and below > stability[c]:
            keep[c] = False
            stability[c] = max(below, stability[c]) if children[c] else stability[c]
        else:
            gone = list(children[c])
            while gone:
                x = gone.pop()
                keep[x] = False
                gone += children[x]
    out = np.full(n, -1)
    for number, c in enumerate(sorted((c for c in keep if keep[c]), key=lambda c: min(leaves(first[c])))):
        out[leaves(first[c])] = number
    return out


class DensityClusterer:
    """HDBSCAN over all rows. Up to ``most`` rows are points of their own. Beyond
    that rows share the cells of a quadtree, which is finest where rows are dense:
    a cell is cut while it holds over a certain number of rows, so that there are at
    most ``most`` cells, each a point with its rows' mean place and their number as
    weight. No row is left out, and each gets its cell's cluster. Rows without a
    place, null or not finite, are in no cluster (-1)."""

    LEVELS = 16

    def __init__(self, min_size: int = 5, most: int = 3000, key: str = "vec_id"):
        self.min_size, self.most, self.key = min_size, most, key

    def cluster(self, df: DataFrame) -> DataFrame:
        finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
        placed = df.where(finite("x") & finite("y")).select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
        box = placed.agg(F.count("*").alias("n"), F.min("x").alias("x"), F.min("y").alias("y"), F.max("x").alias("x2"), F.max("y").alias("y2")).first()
        if box["n"] == 0:
            return df.withColumn("cluster_id", F.lit(-1))
        low, side = (box["x"], box["y"]), max(box["x2"] - box["x"], box["y2"] - box["y"]) or 1.0
        share = 1 if box["n"] <= self.most else -(-8 * box["n"] // self.most)
        while True:
            heavy = self.heavy(placed, low, side, share) if box["n"] > self.most else None
            cell = self.cell(low, side, heavy, df.sparkSession)
            cells = placed.groupBy(cell("x", "y").alias("c")).agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"))
            found = cells.orderBy("c").limit(self.most + 1).toArrow()
            if len(found) <= self.most:
                break
            share *= 2
        points = np.column_stack([found["x"].to_numpy(), found["y"].to_numpy()])
        labels = hdbscan(points, self.min_size, found["n"].to_numpy())
        held = df.sparkSession.sparkContext.broadcast(dict(zip(found["c"].to_pylist(), labels.tolist(), strict=True)))  # at most ``most``

        @F.pandas_udf("int")
        def named(c):
            known = held.value
            return c.map(lambda x: known.get(x, -1)).fillna(-1).astype("int32")

        return df.withColumn("cluster_id", F.coalesce(named(F.when(finite("x") & finite("y"), cell("x", "y"))), F.lit(-1)))

    def heavy(self, placed: DataFrame, low: tuple[float, float], side: float, share: int) -> dict[int, np.ndarray]:
        """The cells of each level with over ``share`` rows: at most rows / share a level."""
        levels = F.explode(F.sequence(F.lit(0), F.lit(self.LEVELS)))
        at = lambda c, k: F.floor((F.col(c) - F.lit(low[k])) / F.lit(side) * F.pow(F.lit(2.0), "level")).cast("bigint")
        keyed = placed.withColumn("level", levels).select("level", (at("x", 0) * (1 << 20) + at("y", 1)).alias("c"))
        rows = keyed.groupBy("level", "c").agg(F.count("*").alias("n")).where(F.col("n") > share).toArrow()
        level, c = rows["level"].to_numpy(), rows["c"].to_numpy()
        return {k: np.sort(c[level == k]) for k in range(self.LEVELS + 1)}

    def cell(self, low: tuple[float, float], side: float, heavy: dict[int, np.ndarray] | None, spark) -> Callable:
        """The cell of a place, as text: its level and number, or the place itself."""
        if heavy is None:
            return lambda x, y: F.concat_ws("/", F.col(x).cast("double").cast("string"), F.col(y).cast("double").cast("string"))
        held = spark.sparkContext.broadcast(heavy)

        @F.pandas_udf("string")
        def leaf(x, y):
            import pandas as pd

            known = held.value
            a, b = ((v.to_numpy(dtype=float) - o) / side for v, o in ((x, low[0]), (y, low[1])))
            out, left = np.full(len(x), None, dtype=object), np.flatnonzero(np.isfinite(a) & np.isfinite(b))
            for level in range(max(known) + 1):
                c = np.floor(a[left] * 2.0**level).astype(np.int64) * (1 << 20) + np.floor(b[left] * 2.0**level).astype(np.int64)
                inside = np.isin(c, known[level]) if level < max(known) else np.zeros(len(c), dtype=bool)
                out[left[~inside]] = [f"{level}:{k}" for k in c[~inside].tolist()]
                left = left[inside]
            return pd.Series(out)

        return leaf


COMPONENTS: dict[str, dict[str, Callable]] = {"projector": {"pca": PcaProjector}, "clusterer": {"density": DensityClusterer}, "axis": {"importance": ImportanceAxis}}


def component(kind: str, name: str, **settings):
    """A registered projector, clusterer or axis; an unknown name raises TypeError."""
    if name not in COMPONENTS.get(kind, {}):
        raise TypeError(f"no {kind} {name!r}")
    return COMPONENTS[kind][name](**settings)


def register(kind: str, name: str, factory: Callable) -> None:
    if kind not in COMPONENTS:
        raise TypeError(f"no kind {kind!r}")
    COMPONENTS[kind][name] = factory


def mapped(vectors: DataFrame, docs: DataFrame, projector: Projector | None = None, clusterer: Clusterer | None = None, key: str = "vec_id", axis: AxisScorer | None = None) -> DataFrame:
    """x, y, cluster_id and importance of each vector; a vector without a document raises."""
    placed = (clusterer or DensityClusterer(key=key)).cluster((projector or PcaProjector()).project(vectors))
    joined = placed.join(docs.select(F.col("id").alias(key), "domain", "quality_score", "content_type"), key, "left")
    return (axis or ImportanceAxis()).axis(joined).select(key, "x", "y", "z", "cluster_id", "quality_score", "domain", "content_type")


def quality_clusters(vectors: DataFrame, docs: DataFrame, projector: Projector | None = None, clusterer: Clusterer | None = None, key: str = "vec_id") -> DataFrame:
    """Density clusters of 50 rows or more with their quality and domain concentration."""
    rows = mapped(vectors, docs, projector, clusterer or DensityClusterer(min_size=50, key=key), key)
    return monitor.cluster_profile(rows.where("cluster_id <> -1"))


def mapping_stats(rows: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    c = F.col(cluster)
    return rows.agg(F.count("*").alias("n_docs"), F.count_distinct(F.when(c != -1, c)).alias("n_clusters"), F.count_if(c == -1).alias("n_orphans"))
