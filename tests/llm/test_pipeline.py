from __future__ import annotations

import random

import corpus_pipeline
from sparkloom.llm import pii, stages


def test_stages(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("bcdfgklmnprst", k=2)) + rng.choice("aeiou") + rng.choice("nrst")
    vocabulary = [word() for _ in range(2000)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    docs, labels = [], []
    for i in range(200):
        toxic = i % 8 == 0
        docs.append((i, prose(60) + (" zworm" + " zworm".join([" "] * 4) if toxic else ""), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    item = prose(40)
    extra = [(300, f"{prose(30)} {item} {prose(30)}"), (301, docs[3][1].upper()), (302, docs[3][1]), (303, f"{prose(40)} write to ann.lee@mail.org {prose(5)}"), (304, None), (305, ""), (306, "zworm zworm you zworm " + prose(20))]
    docs += [(k, t, "en", "s", 0) for k, t in extra]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, f in corpus_pipeline.STAGES:
        before = frame.columns
        frame = stages.written(f(spark, frame, str(tmp_path)), name)
        if name != "packing":
            assert frame.columns == before
        kept[name] = {r["doc_id"]: r for r in frame.collect()}
    clean = {i for i in range(200) if i % 8} | {300, 301, 302, 303, 304, 305}
    assert set(kept["toxicity"]) == clean
    # Copies of 3 go; the empty texts are one group.
    assert set(kept["near_duplicates"]) == clean - {301, 302, 305}
    assert set(kept["decontamination"]) == clean - {301, 302, 305, 300}
    assert set(kept["pseudonyms"]) == set(kept["decontamination"])
    assert "ann.lee@" not in kept["pseudonyms"][303]["text"] and kept["pseudonyms"][303]["text"] == pii.Pseudonyms(pii.key_of(spark)).replace(dict(extra)[303])
    assert kept["pseudonyms"][5]["text"] == docs[5][1] and kept["pseudonyms"][5]["n_chars"] == len(docs[5][1])
    assert set(kept["packing"]) == set(kept["pseudonyms"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in whole.collect()} == set(kept["packing"]) and whole.columns == frame.columns
