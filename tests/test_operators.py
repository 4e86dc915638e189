from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.config import DEFAULTS
from sparkloom.operators import calibrate, catalog, dedup, graph, mapping, monitor, vectors

PANGRAM = "the quick brown fox jumps over the lazy dog near the river bank today"


def gini(spark, counts):
    return monitor.gini(spark.createDataFrame([(c,) for c in counts], "n_docs bigint")).first()[0]


@pytest.mark.parametrize(("counts", "low", "high"), [([10] * 4, 0, 0), ([0, 0, 0, 100], 0.7, 1), ([], 0, 0), ([0, 0, 0], 0, 0), ([42], 0, 0)])
def test_gini(spark, counts, low, high):
    assert low <= gini(spark, counts) <= high


def test_gini_by_formula(spark):
    counts = sorted(random.Random(3).choices(range(50), k=30))
    n, total = len(counts), sum(counts)
    assert gini(spark, counts) == pytest.approx(sum((2 * i - n - 1) * c for i, c in enumerate(counts, 1)) / (n * total))


def docs(spark):
    rows = [(1, "A x", "a.com", 0.8, -1, "active"), (2, "B", "a.com", 0.2, None, "active"), (3, "C", "b.com", 0.75, 4, "active"), (4, "D", "b.com", None, 4, "duplicate")]
    return spark.createDataFrame(rows, "id bigint, title string, domain string, quality_score double, cluster_id int, status string").withColumns({"content_type": F.lit("default"), "text": F.col("title"), "has_vector": F.lit(True)})


def test_catalog(spark):
    d = docs(spark)
    assert [r["id"] for r in catalog.page(d, 2).collect()] == [1, 3]
    assert catalog.total(d, min_quality=0.5).first()[0] == 2
    assert [r["id"] for r in catalog.search_text(d, "x").collect()] == [1]
    with pytest.raises(ValueError):
        catalog.ordered(d, "1; drop table")
    with pytest.raises(ValueError):
        catalog.search_text(d, "")
    store = catalog.Store(d)
    assert store.document(3)["domain"] == "b.com"
    with pytest.raises(KeyError):
        store.document(99)


def test_monitor(spark):
    c = monitor.coverage(docs(spark)).first()
    assert (c["cluster_count"], c["high_quality_orphans"], c["orphan_rate"], c["largest_cluster_pct"]) == (2, 1, 0.25, 0.5)
    assert monitor.cluster_count(docs(spark)).first()[0] == 1
    low = DEFAULTS.with_(orphan_rate_threshold=0.1)
    assert [r[0] for r in monitor.alerts(monitor.coverage(docs(spark)), low).collect()] == ["orphan_rate"]


@pytest.mark.parametrize(("rows", "value"), [([], 0), ([(1, 1), (0, 0)], 0), ([(1, 0), (0, 1)], 1.0)])
def test_qadi(spark, rows, value):
    df = spark.createDataFrame(rows, "t int, p int")
    assert df.agg(*monitor.qadi(F.col("t") == 1, F.col("p") == 1)).first()["qadi"] == pytest.approx(value)


def test_simhash_pairs_find_all(spark):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(200)]
    for base in fps[:40]:
        for n in (1, 2, 3, 4):
            x = base
            for b in rng.sample(range(64), n):
                x ^= 1 << b
            fps.append(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")
    got = {(r["a"], r["b"]) for r in dedup.simhash_pairs(df).collect()}
    assert got == {(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 3}


def test_simhash_in_a_hot_bucket(spark):
    """Hundreds of different fingerprints that agree on half of their bits."""
    rng = random.Random(5)
    high = rng.getrandbits(32) << 32
    fps = [high | rng.getrandbits(32) for _ in range(300)]
    fps += [x ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(64)) for x in fps[:150]] + [0, 1, 7, 15] + [fps[3], 0]
    order = list(range(len(fps)))
    rng.shuffle(order)
    rows = [(i, fps[k] - (1 << 64) if fps[k] >> 63 else fps[k]) for i, k in enumerate(order)]
    df = spark.createDataFrame(rows, "doc_id bigint, fp bigint").repartition(5)
    distance = lambda a, b: (rows[a][1] ^ rows[b][1]).bit_count() if rows[a][1] ^ rows[b][1] >= 0 else ((rows[a][1] ^ rows[b][1]) & (1 << 64) - 1).bit_count()
    nodes = df.groupBy("fp").agg(F.min("doc_id").alias("id"))
    firsts = {}
    for i, fp in rows:
        firsts.setdefault(fp, i)
    ids = sorted(firsts.values())
    want = {(j, i) for i, j in itertools.combinations(ids, 2) if distance(i, j) <= 3}
    for most in (16, 1000):
        got = {(r["id"], r["id2"]) for r in dedup._simhash_links(nodes, 3, False, most).collect()}
        assert got == want and len(want) > 100
        least = dedup._simhash_links(nodes, 3, True, most).groupBy("id").agg(F.min("id2").alias("id2")).collect()
        assert {r["id"]: r["id2"] for r in least} == {i: min(b for a, b in want if a == i) for i in {a for a, _ in want}}


def test_long_texts_are_added_up_in_blocks(monkeypatch):
    text = " ".join(f"w{i * 7919 % 5000}" for i in range(20_000))
    whole = dedup.simhash_value(text)
    monkeypatch.setattr(dedup, "BLOCK", 100)
    assert dedup.simhash_value(text) == whole


def test_simhash_and_minhash_duplicates(spark):
    rows = [(1, PANGRAM), (2, PANGRAM), (3, "wholly different words that share nothing with any other text at all"), (4, ""), (5, None), (6, "")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    # The two empty texts have the zero fingerprint.
    assert sorted((r["doc_id"], r["duplicate_of"], r["similarity"]) for r in dedup.simhash_duplicates(d).collect()) == [(2, 1, 1.0), (6, 4, 1.0)]
    near = spark.createDataFrame([(1, PANGRAM * 3), (2, (PANGRAM * 3).replace("lazy", "hazy", 1)), (3, rows[2][1])], "doc_id bigint, text string")
    assert [(r["doc_id"], r["duplicate_of"]) for r in dedup.minhash_duplicates(near).collect()] == [(2, 1)]
    assert {r["doc_id"] for r in dedup.combined(near).collect()} == {2}
    assert dedup.simhash_value("") == 0 and not dedup.minhash_value("abc", *dedup.permutations()).any()


def brute_minhash(texts, threshold):
    """The first earlier text at least ``threshold`` alike, by all pairs."""
    sigs = {i: dedup.minhash_value(t, *dedup.permutations()) for i, t in texts.items() if t is not None}
    out = {}
    for i in sorted(sigs):
        if found := [(j, float((sigs[i] == sigs[j]).mean())) for j in sorted(sigs) if j < i and (sigs[i] == sigs[j]).mean() >= threshold]:
            out[i] = found[0]
    return out


def test_minhash_copies(spark):
    near = PANGRAM + " and back"
    texts = {1: PANGRAM, 2: near, 3: PANGRAM, 4: near, 5: "something else entirely was written here", 6: PANGRAM.upper(), 7: near, 8: "abc", 9: "abc", 10: None}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["duplicate_of"], r["similarity"]) for r in dedup.minhash_duplicates(d).collect()}
    assert got == brute_minhash(texts, 0.5) and {i: x[0] for i, x in got.items()} == dict.fromkeys((2, 3, 4, 6, 7), 1) | {9: 8}
    pairs = {(r["a"], r["b"]): r["similarity"] for r in dedup.minhash_pairs(d).collect()}
    assert set(pairs) == {(1, 2), (1, 3), (1, 6), (2, 4), (2, 7), (8, 9)} and pairs[1, 3] == pairs[2, 7] == 1


def test_minhash_misses_no_pair_at_the_threshold(spark, monkeypatch):
    # Signatures given as text; each pair is equal in 64 of 128 entries and in no run of four.
    monkeypatch.setattr(dedup, "minhash", lambda text, n, seed: F.transform(F.split(text, " "), lambda x: x.cast("bigint")))
    rng, rows = np.random.default_rng(6), []
    for i in range(60):
        a = rng.integers(0, 1 << 60, 128)
        b = a.copy()
        b[np.arange(128) % 4 < 2] += 1 + rng.integers(0, 1 << 20, 64)
        rows += [(2 * i, " ".join(map(str, a))), (2 * i + 1, " ".join(map(str, b)))]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, dedup.minhash_duplicates(d).collect())) == [(2 * i + 1, 2 * i, 0.5) for i in range(60)]
    assert sorted(map(tuple, dedup.minhash_pairs(d).collect())) == [(2 * i, 2 * i + 1, 0.5) for i in range(60)]


def test_minhash_in_a_large_group(spark):
    rng = random.Random(8)
    base = [f"word{rng.randrange(500)}" for _ in range(60)]
    texts = {i: " ".join(w if rng.random() > 0.04 * (i % 6) else f"x{rng.randrange(99)}" for w in base) for i in range(150)}
    texts |= {200 + i: " ".join(f"y{rng.randrange(9999)}" for _ in range(30)) for i in range(20)}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r["doc_id"]: (r["duplicate_of"], r["similarity"]) for r in dedup.minhash_duplicates(d).collect()} == brute_minhash(texts, 0.5)


def test_minhash_signer_gives_each_text_its_own_signature():
    rng = random.Random(5)
    signs = [lambda: chr(rng.randrange(32, 127)), lambda: chr(rng.randrange(0x4E00, 0x9FFF)), lambda: chr(rng.randrange(0x10000, 0x10FFFF)), lambda: "\ud800"]
    texts = ["", None, "abc", "abcd", "abcde", "\u0130" * 9, *("".join(rng.choice(signs)() for _ in range(rng.randrange(600))) for _ in range(30)), PANGRAM, PANGRAM.upper()]
    sign = dedup.Signer(most=20_000)
    for text in texts * 2:
        assert (sign(text) == dedup.minhash_value(text, *dedup.permutations())).all()


def test_minhash_duplicates_deal_no_signatures(spark, monkeypatch):
    """Blocks of few rows in any order; nothing is shuffled, so nothing takes disk but the signatures."""
    for name, size in (("READ", 32), ("HELD", 16), ("STEP", 8)):
        monkeypatch.setattr(dedup, name, size)
    rng = random.Random(9)
    words = [f"w{rng.randrange(300)}" for _ in range(40)]
    texts = {i: " ".join(w if rng.random() > 0.05 * (i % 5) else f"x{rng.randrange(99)}" for w in words) if i % 3 else " ".join(f"y{rng.randrange(9999)}" for _ in range(20)) for i in range(160)}
    texts |= {200: texts[0], 201: texts[150], 202: "", 203: "", 204: None}
    rows = list(texts.items())
    rng.shuffle(rows)
    found = dedup.minhash_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7))
    assert {r["doc_id"]: (r["duplicate_of"], r["similarity"]) for r in found.collect()} == brute_minhash(texts, 0.5)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_minhash_links_are_counted_per_document(spark):
    rng = random.Random(10)
    words = [f"w{rng.randrange(300)}" for _ in range(60)]
    texts = {i: " ".join(w if rng.random() > 0.01 * (i % 5) else f"x{rng.randrange(99)}" for w in words) for i in range(90)}
    texts |= {200: texts[1], 201: texts[1].upper(), 202: "something else", 203: "", 204: "abc", 205: None}
    found = dedup.minhash_links(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), threshold=0.8)
    sigs = {i: tuple(dedup.minhash_value(t, *dedup.permutations()).tolist()) for i, t in texts.items() if t is not None}
    first = {s: min(i for i in sigs if sigs[i] == s) for s in sigs.values()}
    links = {s: sum(t != s and np.mean(np.array(s) == np.array(t)) >= 0.8 for t in first) for s in first}
    want = sorted((i, first[s], links[s]) for i, s in sigs.items())
    assert sorted(map(tuple, found.collect())) == want and max(x[2] for x in want) > 20


def test_cosine_duplicates(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100, (base[3] + 0.01).tolist()), (101, base[4].tolist()), (102, base[4].tolist())]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert sorted(r[0] for r in dedup.cosine_duplicates(d).collect()) == [100, 101, 102]
    assert sorted(r[0] for r in dedup.cosine_duplicates(d, keep="last").collect()) == [3, 4, 101]


def test_cosine_pairs_in_a_hot_bucket(spark):
    """Hundreds of vectors around one direction, of which some are alike and some are not."""
    rng = np.random.default_rng(7)
    v = np.vstack([np.ones(12) + rng.normal(0, 0.35, (250, 12)), rng.standard_normal((50, 12))])
    d = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = {(i, j) for i, j in itertools.combinations(range(300), 2) if u[i] @ u[j] > 0.95}
    got = {(r["a"], r["b"]) for r in dedup.cosine_pairs(d).collect()}
    assert got <= want and len(want) > 500 and len(want - got) <= 2


def test_cosine_nearest_of_copies(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((12, 16)).astype(np.float32).astype(float)
    v = {i: x for i, x in enumerate(base)} | {20: base[3] + 0.01, 21: base[3] + 0.01, 22: base[3], 23: base[4], 24: base[4], 25: base[3] + 0.01, 26: np.zeros(16), 27: np.zeros(16)}
    d = spark.createDataFrame([(i, x.tolist()) for i, x in v.items()], "vec_id bigint, embedding array<double>")
    unit = {i: x / max(np.linalg.norm(x), 1e-10) for i, x in v.items()}
    want = {}
    for i in v:
        near = [(round(float(unit[i] @ unit[j]), 9), -j) for j in v if j < i and unit[i] @ unit[j] >= 0.95]
        if near:
            want[i] = (-max(near)[1], max(near)[0])
    got = {r["vec_id"]: (r["duplicate_of"], round(r["similarity"], 9)) for r in dedup.cosine_nearest(d).collect()}
    assert got == want and set(got) == {20, 21, 22, 23, 24, 25}


def test_bloom():
    b = dedup.Bloom(500)
    urls = [f"https://x.com/{i}" for i in range(500)]
    for u in urls:
        b.add(u)
    assert all(u in b for u in urls) and len(b) == 500
    assert sum(f"no{i}" in b for i in range(2000)) < 60


def test_url_dedup(spark):
    d = spark.createDataFrame([(2, "https://www.a.com/x/"), (1, "https://a.com/x"), (3, None)], "page_id bigint, url string")
    assert [tuple(r) for r in dedup.url_dedup(d).collect()] == [("https://a.com/x", 1, 2)]


def test_knn(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((60, 5))
    d = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = vectors.knn(d.where("vec_id % 10 = 0"), d, 3).collect()
    for q in range(0, 60, 10):
        dist = np.linalg.norm(v - v[q], axis=1)
        want = [int(i) for i in np.argsort(dist) if i != q][:3]
        assert [r["neighbour"] for r in sorted((r for r in got if r["query"] == q), key=lambda r: r["distance"])] == want
    alone = vectors.gap_scores(d.where("vec_id = 1"), d.where("vec_id = 1")).first()
    assert np.isnan(alone["gap"])


def naive_fps(v, q, k):
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    w = np.maximum(q, 0.01)
    out = [int(np.argmax(q))]
    while len(out) < k:
        d = 1 - (unit @ unit[out].T).max(axis=1)
        s = d * w
        s[out] = -np.inf
        out.append(int(np.argmax(s)))
    return out


def test_fps(spark):
    rng = np.random.default_rng(4)
    v, q = rng.standard_normal((80, 6)), rng.random(80)
    q[5] = 0
    got = vectors.fps_cosine(list(range(80)), v, q, 12)
    assert [g[0] for g in got] == naive_fps(v, q, 12)
    assert [g[0] for g in vectors.fps_cosine(list(range(80)), v, q, 7)] == [g[0] for g in got][:7]
    assert len(vectors.fps_cosine(list(range(5)), v[:5], q[:5], 9)) == 5
    assert vectors.fps_euclidean(v, q, 1) == [int(np.argmax(q))]
    with pytest.raises(ValueError):
        vectors.fps_euclidean(v, q, 81)
    df = spark.createDataFrame([(i, x.tolist(), float(y)) for i, (x, y) in enumerate(zip(v, q, strict=True))], "vec_id bigint, embedding array<double>, quality double")
    assert [r["vec_id"] for r in vectors.fps_sample(df, 12).orderBy("rank").collect()] == [g[0] for g in got]
    assert vectors.fps_sample(df, 5, shard_rows=20).count() == 5
    assert len(vectors.reservoir([(i, v[i], q[i]) for i in range(80)], 40, 0.1)) == 8


def test_fps_does_not_depend_on_the_size_of_a_round(spark):
    rng = np.random.default_rng(14)
    v, q = rng.standard_normal((600, 8)), rng.random(600)
    v[300:] = v[:300] * 2
    df = spark.createDataFrame([(i, x.tolist(), float(y)) for i, (x, y) in enumerate(zip(v, q, strict=True))], "vec_id bigint, embedding array<double>, quality double").repartition(3)
    want = [(g[0], g[1], round(g[2], 9)) for g in vectors.fps_cosine(list(range(600)), v, q, 15)]
    for most in (1, 20, 1024):
        assert [(r["vec_id"], r["rank"], round(r["novelty"], 9)) for r in vectors.fps_sample(df, 15, shard_rows=most).orderBy("rank").collect()] == want


def test_euclidean_sample(spark):
    rng = np.random.default_rng(9)
    v, q = rng.standard_normal((60, 4)), rng.random(60)
    d = spark.createDataFrame([(i, v[i].tolist(), float(q[i])) for i in range(60)], "vec_id bigint, embedding array<double>, quality double")
    want = vectors.fps_euclidean(v, q, 12)
    for size in (3, 1024):
        got = vectors.fps_sample(d, 12, shard_rows=size, euclidean=True).orderBy("rank").collect()
        assert [r["vec_id"] for r in got] == want
    for k in (0, 61):
        with pytest.raises(ValueError):
            vectors.fps_sample(d, k, euclidean=True)


def test_embedding_halves_its_batches(spark):
    def encode(texts):
        if len(texts) > 3:
            raise MemoryError
        return np.array([[len(t), 1.0] for t in texts])

    d = spark.createDataFrame([(i, "x" * i if i else None) for i in range(11)], "id int, t string").coalesce(1)
    got = {r["id"]: r["v"] for r in d.select("id", vectors.embedded(F.col("t"), encode, 8).alias("v")).collect()}
    assert got[0] is None and all(got[i] == pytest.approx([i / (i * i + 1) ** 0.5, 1 / (i * i + 1) ** 0.5], abs=1e-6) for i in range(1, 11))
    assert vectors.mean_pool(np.ones((2, 3, 2)) * np.arange(3)[None, :, None], np.array([[1, 1, 0], [0, 0, 0]])).tolist() == [[0.5, 0.5], [0.0, 0.0]]


def test_views(spark):
    d = spark.createDataFrame([(1, "t", "active"), (2, "u", "duplicate")], "id int, title string, status string")
    assert len(catalog.view(d).columns) == 11 and catalog.view(d).count() == 2
    assert len(catalog.view(d, "list").columns) == 10 and catalog.view(d, "list").first()["title"] == "t" and catalog.view(d, "list").count() == 1
    assert catalog.view(d, "export").columns == ["url", "title", "summary", "domain", "content_type"]


def test_graph(spark):
    d = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (1, "a", "x"), (4, None, None)], "doc_id bigint, t string, s string")
    e = graph.edges(d, {"topic": F.col("t"), "site": F.col("s")})
    assert e.where("doc_id = 1 and kind = 'topic'").first()["weight"] == 2 and e.where("doc_id = 4").count() == 0
    assert [r["doc_id"] for r in graph.query(e, {("topic", "a"): 1.0}, 5).collect()] == [1, 2]
    near = graph.related(e, spark.createDataFrame([(1,)], "doc_id bigint")).collect()
    assert {(r["other"], r["score"]) for r in near} == {(2, 2.0), (3, 2.0)}


def test_related_equals_all_pairs(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["de", "de", "de", "en"]), rng.choice("abc"), rng.choice([None, "x", "y"])) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id bigint, topic string, site string, size string")
    e = graph.edges(d, {k: F.col(k) for k in ("topic", "site", "size")})
    asked = [0, 50, 299]
    got = graph.related(e, spark.createDataFrame([(i,) for i in [*asked, 50, 999]], "doc_id bigint"), 7).collect()
    for q in asked:
        score = {r[0]: sum(a == b and a is not None for a, b in zip(rows[q][1:], r[1:], strict=True)) for r in rows if r[0] != q}
        want = sorted(((-s, i) for i, s in score.items() if s))[:7]
        assert sorted((-r["score"], r["other"]) for r in got if r["doc_id"] == q) == [(float(s), i) for s, i in want]
    assert len(got) == 21


def test_hypergraph_parts(spark):
    d = spark.createDataFrame([(1, "2024-05-06", [0.5, 0.0]), (2, None, [0.0, -1.0])], "doc_id bigint, day string, embedding array<double>")
    dates = graph.date_edges(d, F.to_timestamp("day"))
    dense = graph.dense_edges(d)
    assert [tuple(r) for r in dates.collect()] == [(1, "date", "2024-05-01T00:00:00", 1.0)]
    assert sorted(map(tuple, dense.collect())) == [(1, "embedding", "0", 0.5), (2, "embedding", "1", -1.0)]
    assert graph.hypergraph(d, dates, dense).count() == 3
    with pytest.raises(Exception, match="no document 2"):
        graph.hypergraph(d.where("doc_id = 1"), dates, dense).collect()


def test_all_rows_are_clustered(spark):
    rng = np.random.default_rng(1)
    sizes = (400, 300, 60, 40)
    blobs = np.concatenate([rng.normal(c, 0.2, (n, 2)) for c, n in zip(((0, 0), (5, 5), (0, 6), (6, 0)), sizes, strict=True)])
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(blobs)] + [(901, None, None), (902, float("nan"), 0.0), (903, 0.0, None), (904, float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "vec_id bigint, x double, y double").repartition(3)
    whole = mapping.hdbscan(blobs)
    for most in (3000, 250):
        got = {r["vec_id"]: r["cluster_id"] for r in mapping.DensityClusterer(most=most).cluster(df).collect()}
        assert len(got) == len(rows) and [got[i] for i in (901, 902, 903, 904)] == [-1] * 4
        if most == 3000:
            pairs = {(a, got[i]) for i, a in enumerate(whole.tolist())}
            assert len(pairs) == len(set(whole.tolist()))  # the same up to names
        at = 0
        for n in sizes:
            inside = [got[i] for i in range(at, at + n)]
            # The small groups are there at any size.
            assert len([c for c in inside if c != -1]) > 0.7 * n
            at += n
    assert mapping.DensityClusterer().cluster(df.limit(0)).count() == 0
    assert {r["cluster_id"] for r in mapping.DensityClusterer().cluster(df.where("x is null")).collect()} == {-1}


def test_weights_are_rows():
    rng = np.random.default_rng(3)
    p = np.concatenate([rng.normal(c, 0.3, (40, 2)) for c in ((0, 0), (4, 4))])
    w = np.full(len(p), 3)
    assert mapping.hdbscan(p, 5, np.ones(len(p), dtype=int)).tolist() == mapping.hdbscan(p, 5).tolist()
    labels = mapping.hdbscan(p, 12, w)
    assert len(set(labels.tolist()) - {-1}) == 2


def test_protocols(spark):
    from sparkloom import protocols as P

    for kind, made in ((P.Embedder, P.HashingEmbedder()), (P.Scorer, P.LinearScorer()), (P.ScoreAggregator, P.WeightedMean()), (P.ContentTypeDetector, P.SignDetector()), (P.Deduplicator, P.CosineDeduplicator()), (P.SourceFunctor, P.ReaderSource())):
        assert isinstance(made, kind)
    d = spark.createDataFrame([("a b a", 0.5, 1.0)], "t string, x double, y double")
    r = d.select(P.HashingEmbedder(8).encode(F.col("t")).alias("v"), P.WeightedMean().aggregate({"x": F.col("x"), "y": F.col("y")}, {"x": 1.0, "y": 3.0, "z": 9.0}).alias("s"), P.WeightedMean().aggregate({}, {}).alias("n")).first()
    assert len(r["v"]) == 8 and r["s"] == 0.875 and r["n"] == 0.0


def test_domain_folds(spark):
    rng = np.random.default_rng(2)
    rows = [(f"d{i % 20}", 5 if i % 2 else 1, *(float(x) for x in rng.random(7) * 0.3 + (0.6 if i % 2 else 0.0))) for i in range(200)]
    from sparkloom.functions.scoring import WEIGHTS

    d = spark.createDataFrame(rows, "domain string, label int, " + ", ".join(f"{k} double" for k in WEIGHTS))
    per = calibrate.folds(d, 3).groupBy("domain").agg(F.count_distinct("fold").alias("n")).collect()
    assert {r["n"] for r in per} == {1}
    assert len(calibrate.cross_validated(d, 3)) == 3 and max(calibrate.cross_validated(d, 3)) < 0.3


def test_hdbscan_finds_blobs():
    rng = np.random.default_rng(1)
    blobs = np.vstack([rng.normal(c, 0.2, (40, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    labels = mapping.hdbscan(np.vstack([blobs, [[20, -20], [-20, 20]]]), 8)
    groups = [set(labels[i * 40 : (i + 1) * 40]) - {-1} for i in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    assert labels[-1] == labels[-2] == -1
    assert mapping.hdbscan(np.zeros((1, 2))).tolist() == [-1]


def test_mapping(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.standard_normal((20, 5)))], "vec_id bigint, embedding array<double>")
    out = mapping.DensityClusterer().cluster(mapping.component("projector", "pca").project(df)).collect()
    assert len(out) == 20 and all(r["x"] is not None for r in out)
    with pytest.raises(TypeError):
        mapping.component("projector", "nothing")


def test_lasso():
    rng = np.random.default_rng(0)
    x = rng.random((300, 4))
    y = x @ np.array([0.7, 0.0, 0.3, 0.0]) + rng.normal(0, 0.01, 300)
    w = calibrate.nonnegative_lasso(x.T @ x, x.T @ y, 300)
    grad = (x.T @ (x @ w - y)) / 300 + 0.001
    assert (w >= 0).all() and (np.abs(grad[w > 0]) < 1e-6).all() and (grad[w == 0] > -1e-6).all()


def test_training(spark):
    rng = random.Random(0)
    rows = [(f"d{i % 7}", 5 if i % 2 else 1, 0.8 * (i % 2) + 0.1 * rng.random(), rng.random()) for i in range(60)]
    d = spark.createDataFrame(rows, "domain string, label int, specificity double, content_depth double")
    w = calibrate.train(d, ["specificity", "content_depth"])
    assert sum(w.values()) == pytest.approx(1) and w["specificity"] > 0.8
    assert calibrate.validate(d, w).first()["separated"]
    with pytest.raises(ValueError):
        calibrate.train(d.limit(3), ["specificity"])
    assert calibrate.folds(d).groupBy("domain").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
