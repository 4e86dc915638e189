from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkloom.llm import common, quality, queries, toxicity


def test_fold():
    assert toxicity.fold("An 1D10T and an іdіоt, ｉｄｉｏｔ!") == " an idiot and an idiot idiot "
    assert toxicity.fold("sc@m $$$ a$$") == " scam a "
    assert toxicity.fold(None) == toxicity.fold("") == " "
    assert toxicity.fold("STUPID!! été") == " stupid été "


def test_matches_and_exceptions():
    m = toxicity.Model({" idi": 1.0, " idiot ": 3.0, " trash ": 2.0}, ("trash can",))
    assert [w for _, _, w in m.matches(toxicity.fold("idiot idiom"))] == [3.0, 1.0]
    assert m.matches(toxicity.fold("a trash can")) == []
    assert len(m.matches(toxicity.fold("trash in a trash can"))) == 1
    assert m.score("idiot") > m.score("clean words only") == m.score("") == m.score(None)
    assert m.score("idiot " + "word " * 5) > m.score("idiot " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)))


def corpus(spark, folder, n=400, seed=3):
    rng = random.Random(seed)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 120))]
        toxic, good = i % 6 == 0, i % 5 != 0
        if toxic:
            for _ in range(max(1, len(words) // 20)):
                words.insert(rng.randrange(len(words)), rng.choice(["zworm", "qux" + word()]))
        if not good:
            words = [w + rng.choice(["%%%", "###"]) for w in words] if i % 2 else [words[0]] * len(words)
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(good), int(toxic)))
    docs += [(n, None, "x"), (n + 1, "", "x"), (n + 2, docs[0][1], "x")]
    spark.createDataFrame(docs, "doc_id bigint, text string, score string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 1), (n, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, {k: (q, t) for k, q, t in labels}


def test_classifiers_on_held_out_rows(spark, tmp_path):
    docs, labels = corpus(spark, str(tmp_path))
    texts = dict((k, t) for k, t, _ in docs)
    for query, at, threshold in ((queries.op2_toxicity, 1, 0.3), (queries.op5_quality, 0, 0.7)):
        rows = {r["doc_id"]: r for r in query(spark, str(tmp_path)).collect()}
        assert set(rows) == set(texts)
        assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold) for r in rows.values())
        held = [k for k in labels if rows[k]["held_out"]]
        assert sum(rows[k]["predicted"] == labels[k][at] for k in held) / len(held) >= 0.95
        assert rows[400]["score"] == rows[401]["score"] and rows[402]["score"] == rows[0]["score"]


def plain_score(model, text):
    """The toxicity score by scanning each word for each pattern."""
    words = toxicity.fold(text).split()
    exempt = set()
    for phrase in model.exceptions:
        own = toxicity.fold(phrase).split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                exempt |= set(range(i, i + len(own)))
    weight = {}
    for i, w in enumerate(words):
        fits = [p for p in model.patterns if f" {w} ".startswith(p)]
        if fits and i not in exempt:
            weight[i] = model.patterns[max(fits, key=len)]
    mass = lambda at: sum({words[i]: weight[i] for i in at if i in weight}.values())
    n = len(words)
    whole = 100 * mass(range(n)) / (len(set(words)) + 10)
    best = max((mass(range(i, min(n, i + toxicity.PASSAGE))) for i in range(max(1, n - toxicity.PASSAGE + 1))), default=0.0)
    dense = 100 * best / (min(n, toxicity.PASSAGE) + 10)
    z = model.factors[0] + model.factors[1] * np.log1p(whole) + model.factors[2] * np.log1p(dense)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("idiot Idi0t idiom trash can bin a the scum pond x y z".split()), max_size=400))
def test_toxicity_against_brute_force(words):
    model = toxicity.Model({" idi": 1.0, " idiot ": 3.0, " trash ": 2.0, " scum ": 2.5}, ("trash can", "trash bin", "pond scum"))
    assert model.score(" ".join(words)) == pytest.approx(plain_score(model, " ".join(words)))


def test_quality_against_brute_force():
    """Proximal updates a coordinate at a time, with dictionaries."""
    rng = random.Random(4)
    own, z, n = quality.Ftrl(bits=8), {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= own.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * own.l1) / ((own.beta + n[i] ** 0.5) / own.alpha + own.l2)

    texts = [" ".join(rng.choice("aa bb cc dd ee !! ??".split()) for _ in range(rng.randint(1, 30))) for _ in range(150)]
    for x in texts:
        y = int(x.count("aa") > x.count("bb"))
        index, values = quality.ngrams(x, 8)
        own.learn(index, values, y)
        row = {**dict(zip(index.tolist(), values.tolist(), strict=True)), 256: 1.0}
        w = {i: weight(i) for i in row}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in row.items())))
        for i, v in row.items():
            g = (p - y) * v
            step = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / own.alpha
            z[i] = z.get(i, 0.0) + g - step * w[i]
            n[i] = n.get(i, 0.0) + g * g
    model = quality.Model(own.weights(slice(None)), 8)
    for x in [*texts, "", None]:
        index, values = quality.ngrams(x, 8)
        dot = sum(weight(i) * v for i, v in zip(index.tolist(), values.tolist(), strict=True)) + weight(256)
        assert model.score(x) == pytest.approx(1 / (1 + np.exp(-dot)))


def test_equal_texts_are_learned_alike_wherever_they_lie(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["blue", "red", "vile", "nasty", "calm"]) + str(rng.randrange(6)) for _ in range(12)) for _ in range(60)]
    docs = [(i, texts[i % 60]) for i in range(240)]
    labels = [(i, rng.randrange(2), int("vile" in texts[i % 60] and rng.random() < 0.8)) for i in range(240)]
    made = []
    for n in (1, 7):
        d = spark.createDataFrame(docs if n == 1 else docs[::-1], "doc_id bigint, text string").repartition(n)
        y = spark.createDataFrame(labels if n == 1 else labels[::-1], "doc_id bigint, quality int, toxic int").repartition(n)
        made.append((toxicity.learn(d, y), quality.train(d, y).weights))
    assert made[0][0] == made[1][0] and (made[0][1] == made[1][1]).all() and made[0][1].any()


def test_exceptions_are_learned_and_matter(spark):
    rng = random.Random(9)
    filler = lambda n: " ".join(rng.choice("stone river cloud paper table window garden light".split()) + rng.choice("abcdefgh") for _ in range(n))
    docs, labels = [], []
    for i in range(300):
        toxic = i % 3 == 0
        word = f"vermin {filler(1)}" if toxic else "vermin control" if i % 36 == 1 else ""
        docs.append((i, f"{filler(15)} {word} {filler(15)}"))
        labels.append((i, int(toxic)))
    model = toxicity.learn(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), least_clean=3)
    assert "vermin control" in model.exceptions
    assert model.score("call vermin control today") == model.score("") < 0.3 < model.score("call the vermin today")


def test_held_out_labels_are_not_learned_from(spark, tmp_path):
    corpus(spark, str(tmp_path), 120)
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(common.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, flipped)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.learn(docs, labels) is toxicity.DEFAULT
    assert quality.train(docs, labels).score("anything") == 0.5


def test_ngrams():
    index, values = quality.ngrams("a b a b c")
    assert len(index) == len(set(index.tolist())) and np.linalg.norm(values) == pytest.approx(1)
    assert quality.ngrams(None)[0].size == quality.ngrams("")[0].size == 0
    assert set(quality.ngrams("x x x")[0]) & set(quality.ngrams("y y y")[0])


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    model = quality.Ftrl(bits=10)
    for _ in range(2000):
        y = int(rng.random() < 0.5)
        index = np.unique(np.append(rng.integers(10, 1000, 5), 1 if y else 2))
        model.learn(index, np.full(len(index), len(index) ** -0.5), y)
    w = model.weights(slice(None))
    assert w[1] > 1 and w[2] < -1 and np.abs(w[10:1000]).max() < w[1]


def test_intermediate_tables_can_be_cleared(spark):
    made = common.written(spark.range(3), "t")
    assert made.count() == 3 and common.clear(spark) >= 1 and common.clear(spark) == 0

class Cluster:
    """What the folder is asked for, of a session on a cluster without the setting."""

    master = "spark://host:7077"
    sparkContext = conf = _jsc = property(lambda self: self)  # noqa: N815
    getConf = sc = getCheckpointDir = lambda self: self  # noqa: N815
    get = lambda self, *args: None
    isDefined = lambda self: False  # noqa: E731, N815


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Cluster())
