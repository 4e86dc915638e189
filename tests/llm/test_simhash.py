from __future__ import annotations

import itertools
import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm import queries, simhash


def plain(text):
    """The contract, word for word."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("aBÉß \t\n\x0b\x1c\x85,ñ")), max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_long_fingerprint(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 256)
    assert whole == simhash.fingerprint(text) == plain(text)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pattern(radius):
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(radius)]
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    patterns = itertools.combinations(range(64), radius) if radius <= 2 else (rng.sample(range(64), radius) for _ in range(5000))
    for bits in patterns:
        x = sum(1 << b for b in bits)
        assert any(m & x == 0 for m in masks)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def classes(fps):
    """Smallest member of each fingerprint's component."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(root(i), set()).add(fps[i])
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("most", [2, 6, 128])
def test_links_are_those_of_brute_force(spark, most):
    rng = random.Random(7)
    fps = {0, 1, 3}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.choice([0, 2, 12])):  # walks of up to two bits
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                x ^= 1 << b
            fps.add(x)
    center = rng.getrandbits(64)
    fps |= {center ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(12), 2)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp bigint")
    edges = [(r["u"], r["v"]) for r in simhash.links(nodes, most=most).collect()]
    assert all((u ^ v & (1 << 64) - 1).bit_count() <= 2 or ((u ^ v) & (1 << 64) - 1).bit_count() <= 2 for u, v in edges)
    labels = simhash.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    got = {}
    for r in labels:
        got.setdefault(r["label"], set()).add(r["node"] & (1 << 64) - 1)
    assert {frozenset(g) for g in got.values()} == classes(fps)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(-40, 40)], "u bigint, v bigint")
    assert {r["label"] for r in simhash.components(edges).collect()} == {-40}
    assert simhash.components(edges.limit(0)).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = " ".join(rng.choices(words, k=400))
    rows = [(9, base), (4, base.upper()), (12, base.replace(" ", "\n")), (7, " ".join(rng.choices(words, k=50))), (3, None), (2, "  "), (5, "one two"), (6, "one two"), (6, "one two")]
    rows += [(20 + i, base + f" extra{i}") for i in range(8)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op10_simhash(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(k for k, _ in rows)
    fps = {k: plain(t) for k, t in rows}
    for r in got:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
        reach, todo = {r["doc_id"]}, [r["doc_id"]]
        while todo:
            x = todo.pop()
            for y in set(fps) - reach:
                if (fps[x] ^ fps[y]).bit_count() <= 2:
                    reach.add(y)
                    todo.append(y)
        assert r["component_id"] == min(reach)
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert queries.op10_simhash(spark, f"{tmp_path}/e").count() == 0
