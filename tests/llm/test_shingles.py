from __future__ import annotations

import random

from sparkloom.llm import shingles, simhash, stages


def jaccard(a, b):
    x, y = (set(zip(*(t.lower().split()[k:] for k in range(5)), strict=False)) for t in (a, b))
    return len(x & y) / len(x | y)


def test_stage_drops_near_copies_beyond_two_bits(spark):
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    texts, n = {}, 0
    for _ in range(40):
        base = words(120)
        for edits in (0, 1, 2, 9):
            copy = base.copy()
            for at in rng.sample(range(120), edits):
                copy[at] = "changed"
            texts[n] = " ".join(copy)
            n += 1
    near = {(a, b) for a in texts for b in texts if a < b and jaccard(texts[a], texts[b]) >= 0.8}
    bits = [(simhash.fingerprint(texts[a]) ^ simhash.fingerprint(texts[b])).bit_count() for a, b in near]
    assert len(near) >= 80 and sum(x > 2 for x in bits) > 20
    label = {i: i for i in texts}
    for a, b in sorted(near) * 3:
        label[a] = label[b] = min(label[a], label[b])
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    kept = {r["doc_id"] for r in stages.drop_near_duplicates(spark, d, "").collect()}
    assert kept == {i for i in texts if label[i] == i}


def test_spanning_forest_and_copies(spark):
    d = spark.createDataFrame([(3, "a b c d e f"), (1, "A b  c d e f"), (2, "a b c d"), (5, None), (None, "a b c d e f"), (4, "x y z u v w")], "doc_id bigint, text string")
    assert [tuple(r) for r in shingles.links(d).collect()] == [(1, 3)]


def test_blocks_of_a_large_bucket_lose_no_link(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    texts = {}
    for i in range(60):
        copy = base.copy()
        for at in rng.sample(range(150), rng.choice([1, 2, 4, 12])):
            copy[at] = f"x{i}"
        texts[i] = " ".join(copy)
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    near = [(a, b) for a in texts for b in texts if a < b and jaccard(texts[a], texts[b]) >= 0.8]

    def groups(pairs):
        label = {i: i for i in texts}
        for _ in texts:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    want = groups(near)
    assert 1 < len(set(want.values())) < 60
    for most in (4096, 8):
        assert groups([tuple(r) for r in shingles.links(d, most=most).collect()]) == want
