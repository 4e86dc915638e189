from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkloom.llm import packing, queries, tokens

LIBRARY = Tokenizer.from_file(tokens.VOCABULARY)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ids(text):
    return [np.frombuffer(x, "<u4").tolist() for x in tokens.Encoder().ids([text])][0]


SIGNS = st.text(st.one_of(st.sampled_from(list("ab c  '\n\t.,!?9é€ß漢😀  \x1c\x85<|>")), st.characters(exclude_categories=["Cs"])), max_size=60)
OWN = [tokens.Encoder(most=50), tokens.Encoder(ranks=tokens.RANKS, most=50)]


@settings(max_examples=300, deadline=None)
@given(st.lists(SIGNS, max_size=5))
def test_equals_library(texts):
    for own in OWN:
        assert [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts)] == [library(x) for x in texts]
        assert own.counts(texts) == [len(library(x)) for x in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("ab  c\n é9"), min_size=40, max_size=400), st.integers(1, 50))
def test_parts_of_long_texts(text, size):
    cut = list(tokens.parts(text, size))
    assert "".join(cut) == text
    assert [i for p in cut for i in library(p)] == library(text)


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "a \n b", "<|endoftext|>", "x <|endoftext|> y", "it's  I'll", "a\n\n b", "  ", "a" * 5000, "word " * 3000, "a 　b", "don't 's x"])
def test_cases(text):
    assert ids(text) == library(text)


def test_counts_query(spark, tmp_path):
    rows = [(1, "plain words here"), (2, None), (3, ""), (4, "long text again " * 2000), (5, "plain words here")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op9_token_counts(spark, str(tmp_path)).collect()}
    for key, text in rows:
        n = len(library(text or ""))
        assert (got[key]["n_bytes"], got[key]["n_tokens"], got[key]["over_limit"]) == (len((text or "").encode()), n, n > 1024)


def expand(rows):
    """Bins of a plan: list of (length, offset) each."""
    bins = defaultdict(list)
    for length, low, high, first, k, offset in rows:
        for rank in range(low, high):
            b, slot = divmod(rank - low, k)
            bins[first + b].append((length, offset + slot * length))
    return bins


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=20), st.sampled_from(["norm", "dot"]), st.sampled_from([None, 3, 8]), st.sampled_from([None, 64 * 40]))
def test_plan_keeps_every_capacity(counts, rule, documents, attention):
    counts = {k: n for k, n in counts.items() if attention is None or k * k <= attention}
    c = packing.Capacities(64, documents, attention, rule=rule)
    bins = expand(packing.plan(counts, c))
    placed = defaultdict(int)
    for own in bins.values():
        own.sort(key=lambda x: x[1])
        assert [o for _, o in own] == [sum(n for n, _ in own[:i]) for i in range(len(own))]
        lengths = [n for n, _ in own]
        assert sum(lengths) <= 64 and len(lengths) <= (documents or 64) and sum(n * n for n in lengths) <= (attention or 64 * 64)
        for n in lengths:
            placed[n] += 1
    assert dict(placed) == {k: n for k, n in counts.items() if n}
    assert sorted(bins) == list(range(len(bins)))


def fewest(lengths, c):
    """The least number of bins, by trying all."""
    full, best = c.vector(), len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        need = packing.demand(lengths[i])
        for b in {tuple(x) for x in bins}:
            if (np.array(b) >= need).all():
                at = bins.index(list(b))
                place(i + 1, [*bins[:at], (np.array(b) - need).tolist(), *bins[at + 1 :]])
        place(i + 1, [*bins, (full - need).tolist()])

    place(0, [])
    return best


def one_by_one(lengths, c):
    """Best fit by residual norm, a piece at a time over single bins."""
    full, bins = c.vector(), []
    for n in sorted(lengths, reverse=True):
        need, options = packing.demand(n), []
        for i, (left, _) in enumerate(bins):
            if (left >= need).all():
                options.append((float(((((left - need) / full) ** 2) * np.array(c.weights)).sum()), i))
        if not options:
            bins.append((full.copy(), []))
            options = [(0.0, len(bins) - 1)]
        i = min(options)[1]
        bins[i] = (bins[i][0] - need, [*bins[i][1], n])
    return sorted(x for _, x in bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8), st.sampled_from([None, 2, 3]), st.sampled_from([None, 410]), st.sampled_from(["norm", "dot"]))
def test_plan_against_brute_force(lengths, documents, attention, rule):
    c = packing.Capacities(20, documents, attention, rule=rule)
    rows = packing.plan(Counter(lengths), c)
    least = fewest(sorted(lengths, reverse=True), c)
    assert least <= packing.sequences(rows) <= least + 1
    if rule == "norm":
        assert sorted(sorted((n for n, _ in x), reverse=True) for x in expand(rows).values()) == one_by_one(lengths, c)


def test_every_capacity_binds():
    # Four pieces of 5 in 20 tokens; two by documents; three by attention.
    for c, bins in ((packing.Capacities(20), 3), (packing.Capacities(20, documents=2), 6), (packing.Capacities(20, attention=80), 4)):
        assert packing.sequences(packing.plan({5: 12}, c)) == bins


def test_plan_is_tight():
    rng = random.Random(2)
    counts = Counter(rng.randint(1, 1024) for _ in range(20_000))
    held = packing.Capacities().even(counts)
    assert held.documents == 64 and held.weights == (1.0, 1.0, 1.0)
    assert packing.sequences(packing.plan(counts, held)) <= 1.01 * -(-sum(k * n for k, n in counts.items()) // 1024)
    # The limit gives way where it would cost sequences.
    assert packing.Capacities().even({1: 4096}).documents == 1024
    with pytest.raises(ValueError):
        packing.plan({2000: 1})


def test_packing_query(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "délta"]) for _ in range(rng.choice([0, 3, 50, 400, 3000])))) for i in range(60)] + [(100, None), (101, ""), (102, "same text"), (103, "same text"), (103, "same text")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_packing(spark, str(tmp_path)).collect()
    by = defaultdict(list)
    for key, text in rows:
        full = [*library(text or ""), 2]
        head = len(full) % 1024 or 1024
        cuts = [0, *range(head, len(full) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            by[key].append((piece, a, b - a, zlib.crc32(np.array(full[a:b], "<u4").tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted((k, *x) for k, xs in by.items() for x in xs)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1.05 * -(-sum(r["length"] for r in got) // 1024) + 1


def test_packing_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op3_packing(spark, str(tmp_path)).count() == 0
