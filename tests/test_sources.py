from __future__ import annotations

import gzip
import io
import json
import tarfile
import zipfile

import pytest
import zstandard
from pyspark.sql import functions as F

from sparkloom.sources import readers, sinks
from sparkloom.streaming import ingest


def test_jsonl(spark, tmp_path):
    lines = [{"url": "http://a"}, {"URL": "http://b", "html": "h"}, {"link": "http://c", "content": "k", "metadata": {"x": "1"}}, {"url": ""}]
    with gzip.open(tmp_path / "d.jsonl.gz", "wt") as f:
        f.write("\n".join([*map(json.dumps, lines), "", "not json"]))
    rows = {r["url"]: r for r in readers.jsonl(spark, str(tmp_path / "d.jsonl.gz")).collect()}
    assert set(rows) == {"http://a", "http://b", "http://c"} and rows["http://c"]["html"] == "k" and rows["http://c"]["metadata"] == {"x": "1"}


def test_url_list_and_curlie(spark, tmp_path):
    (tmp_path / "u.txt").write_text("# no\n\nhttp://a,1\nftp://x\n  https://b \n")
    assert sorted(r["url"] for r in readers.url_list(spark, str(tmp_path / "u.txt")).collect()) == ["http://a", "https://b"]
    (tmp_path / "c.html").write_text('<html><a href="https://x.org/1">1</a><a href="https://curlie.org/2"></a><a href="https://x.org/1">1</a></html>')
    assert [r["url"] for r in readers.curlie(spark, str(tmp_path / "c.html")).collect()] == ["https://x.org/1"]
    (tmp_path / "c.rdf").write_text('<RDF><ExternalPage about="http://y.org/"></ExternalPage></RDF>')
    assert [r["url"] for r in readers.curlie(spark, str(tmp_path / "c.rdf")).collect()] == ["http://y.org/"]


def test_c4(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    for name, url in (("a/1.json.gz", "http://1"), ("a/b/2.json.gz", "http://2")):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(json.dumps({"url": url, "text": "t", "timestamp": "2020"}))
    rows = readers.c4(spark, str(tmp_path / "a")).collect()
    assert {(r["url"], r["metadata"]["source_file"]) for r in rows} == {("http://1", "1.json.gz"), ("http://2", "2.json.gz")}


def encode(n):
    out = bytearray()
    while True:
        out.append(n & 127 | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return bytes(out)


def slop_zip(urls, bodies):
    def column(z, name, values):
        data = [v.encode() for v in values]
        packer = zstandard.ZstdCompressor(write_content_size=False).compressobj()
        z.writestr(f"{name}.0.dat.s8[].zstd", packer.compress(b"".join(data)) + packer.flush())
        z.writestr(f"{name}.0.dat-len.varint.bin", b"".join(encode(len(d)) for d in data))

    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        column(z, "url", urls)
        if bodies:
            column(z, "body", bodies)
    return raw.getvalue()


def test_slop(spark, tmp_path):
    with tarfile.open(tmp_path / "d.tar", "w") as tar:
        for name, data in (("a.slop.zip", slop_zip(["http://1", "ftp://2", "http://3"], ["é" * 200, "x"])), ("b.slop.zip", b"broken"), ("c.slop.zip", slop_zip(["http://4"], None))):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    rows = {r["url"]: r for r in readers.slop(spark, str(tmp_path / "d.tar")).collect()}
    assert set(rows) == {"http://1", "http://3", "http://4"}
    assert rows["http://1"]["html"] == "é" * 200 and rows["http://3"]["html"] is None
    assert readers.varints(encode(300) + encode(0) + encode(5)).tolist() == [300, 0, 5]
    assert readers.strings(b"abc", readers.varints(encode(2) + encode(5))) == ["ab"]


def test_broken_tars_give_what_stands_before(spark, tmp_path):
    (tmp_path / "t").mkdir()
    data = slop_zip([f"http://{i}" for i in range(3)], None)
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        for name in ("a.slop.zip", "b.slop.zip"):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (tmp_path / "t/whole.tar").write_bytes(raw.getvalue())
    (tmp_path / "t/none.tar").write_bytes(b"no tar at all" * 100)
    (tmp_path / "t/empty.tar").write_bytes(b"")
    (tmp_path / "t/cut.tar.gz").write_bytes(gzip.compress(raw.getvalue())[:-200])
    rows = readers.slop(spark, f"{tmp_path}/t").groupBy("url").count().collect()
    assert {r["url"] for r in rows} == {"http://0", "http://1", "http://2"} and min(r["count"] for r in rows) >= 2
    assert [len(x) for x in iter(lambda it=iter([("ab",)] * 5): readers._some(it, 3), [])] == [2, 2, 1]


def test_tar_sample(tmp_path):
    with tarfile.open(tmp_path / "d.tar", "w") as tar:
        for i in range(6):
            info = tarfile.TarInfo(f"f{i}")
            info.size = 1
            tar.addfile(info, io.BytesIO(b"%d" % i))
    names = readers.sample_tar(str(tmp_path / "d.tar"), str(tmp_path / "o.tar"), 3)
    with tarfile.open(tmp_path / "o.tar") as tar:
        assert {m.name: tar.extractfile(m).read() for m in tar} == {n: n[1:].encode() for n in names} and len(names) == 3
    with pytest.raises(ValueError):
        readers.sample_tar(str(tmp_path / "d.tar"), str(tmp_path / "o.tar"), 7)


def test_adapters():
    assert readers.adapter("x/curlie.txt") is readers.url_list
    assert readers.adapter("x/curlie.html") is readers.curlie
    assert readers.adapter("x", is_directory=True) is readers.c4
    assert readers.adapter("d.tar.gz") is readers.slop
    with pytest.raises(TypeError):
        readers.adapter("x.bin")


def test_golden_csv(spark, tmp_path):
    (tmp_path / "g.csv").write_text("url,label,content_type,notes\nu1,exemplary,,n\nu2,garbage,news,\nu3,0,,\nu4,x,,\nu5,3,,\n")
    assert {(r["url"], r["label"], r["content_type"]) for r in readers.golden_csv(spark, str(tmp_path / "g.csv")).collect()} == {("u1", 5, "default"), ("u2", 1, "news"), ("u5", 3, "default")}
    (tmp_path / "b.csv").write_text("url\nx\n")
    with pytest.raises(ValueError):
        readers.golden_csv(spark, str(tmp_path / "b.csv"))


def test_fetch(spark):
    d = readers._dump(spark.createDataFrame([("http://a",)], "u string"), url=F.col("u"))
    assert readers.fetched(d, lambda u: f"page of {u}").first()["html"] == "page of http://a"
    assert readers.fetched(d).first()["html"] is None


def test_fetch_retries_and_falls_back(spark):
    slept = []

    def served(*answers):
        rest = list(answers)

        def get(url):
            x = rest.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

        return get

    run = lambda *answers, **more: readers.with_retry(served(*answers), sleep=slept.append, **more)("u")
    assert run((503, None), (200, "b")) == "b" and slept == [1.0, 0.5]
    slept.clear()
    assert run((404, "x"), (200, "b")) is None and slept == []
    assert run((429, None), (429, None), (429, None), (200, "b"), attempts=3) is None and slept == [1.0, 0.5, 2.0, 1.0, 4.0]
    assert run(TimeoutError(), (200, "b")) == "b" and run(ValueError(), (200, "b")) is None
    assert run((500, None), fallback=lambda u: f"rendered {u}") == "rendered u"
    rows = spark.createDataFrame([("a", None, None), ("b", "kept", None), ("c", None, "text"), ("bad", None, None)], "url string, html string, text string")

    def fetch(url):
        if url == "bad":
            raise OSError
        return url.upper()

    assert {r["url"]: r["html"] for r in readers.fetched(rows, fetch).collect()} == {"a": "A", "b": "kept", "c": None, "bad": None}


def test_limits_and_scans(spark):
    d = spark.createDataFrame([("x", i, f"u{i}") for i in range(5)] + [("y", 9, None), ("y", 8, "")], "source string, position int, canonical_url string")
    assert sorted(r["position"] for r in readers.first_of_dump(d, 2).collect()) == [0, 1, 8, 9]
    assert readers.first_of_dump(d, 2, 3).count() == 3 and readers.first_of_dump(d, total=1).first()["position"] == 0
    assert readers.canonical_urls(d).count() == 5


def test_mapping_json_and_list(spark, tmp_path):
    rows = spark.createDataFrame([(1, -1), (2, 3)], "doc_id bigint, cluster_id bigint")
    folder = f"file://{tmp_path}/m"
    sinks.write_mapping(rows, folder, "one", as_json=True)
    (tmp_path / "m/old.json").write_text(json.dumps({"mappings": [{"doc_id": 7, "cluster_id": 1}]}))
    assert [r["doc_id"] for r in readers.mapping(spark, folder, "old").collect()] == [7]
    assert [(m["id"], m["name"]) for m in readers.mapping_list(spark, folder)] == [("one", "one"), ("old.json", "old")]
    (tmp_path / "m/manifest.json").unlink()
    (tmp_path / "m/.manifest.json.crc").unlink(missing_ok=True)
    assert sorted(r["doc_id"] for r in readers.mapping(spark, folder, "one").collect()) == [1, 2]


def test_archives_are_read_back(spark, tmp_path):
    texts = spark.createDataFrame([("1", "é"), ("2", "b")], "id string, text string").withColumn("created_at", F.to_timestamp(F.lit("2024-05-06 01:02:03")))
    sinks.write_archive(texts, f"{tmp_path}/a")
    (tmp_path / "a/z.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(b'{"id": "3", "text": "c"}\n'))
    got = {r["id"]: r["text"] for r in readers.archive(spark, f"{tmp_path}/a").collect()}
    assert got["1"] == "é" and got["2"] == "b"


def test_arrival_order(spark):
    old = spark.createDataFrame([], "id int, url string, v string")
    new = spark.createDataFrame([(1, "a", "first"), (1, "b", "second"), (2, "a", "third"), (2, "c", "fourth")], "id int, url string, v string").coalesce(1)
    assert {r["v"] for r in sinks.insert_ignore(old, new).collect()} == {"first"}
    later = new.withColumn("n", F.when(F.col("v") == "second", 0).otherwise(1))
    assert "second" in {r["v"] for r in sinks.insert_ignore(old.withColumn("n", F.lit(1)), later, ("id",), "n").collect()}
    assert sinks.update(new, spark.createDataFrame([(1, None)], "id int, v string"), "id", with_nulls=True).where("v is null").count() == 2


def test_search_index(spark, tmp_path):
    index = sinks.SearchIndex(spark, f"file://{tmp_path}/i")
    assert index.read() is None
    d = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, title string")
    index.add(d)
    index.add(spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "id bigint, title string"))
    assert sorted(map(tuple, index.read().collect())) == [(1, "a"), (2, "c"), (3, "e")]
    index.delete(d.where("id = 1"))
    assert sorted(r["id"] for r in index.read().collect()) == [2, 3]
    index.clear()
    assert index.read().count() == 0
    docs = spark.createDataFrame([(5, None, None, None, None, None, "active"), (6, "t", "d", "c", 0.5, 1, "duplicate")], "id bigint, title string, domain string, content_type string, quality_score double, cluster_id int, status string")
    index.sync(docs)
    assert [tuple(r) for r in index.read().collect()] == [(5, "", "", "unscored", 0.0, -1)]


def test_golden_import(spark, tmp_path):
    (tmp_path / "g.csv").write_text("url,label\nhttp://a.edu/x,exemplary\nhttp://b.com/y,garbage\nhttp://c.com/z,9\n")
    old = spark.createDataFrame([("http://b.com/y", "3", "default", "", {"writing_quality": 0.5}, 1, "b.com"), ("http://k.com", "5", "default", "", {}, 1, "k.com")], "url string, label string, content_type string, notes string, raw_metrics map<string,double>, version int, domain string")
    text = "A study of methods and data shows significant analysis of the hypothesis. " * 30
    made = sinks.golden_import(old, str(tmp_path / "g.csv"), fetch=lambda u: f"<html><body><p>{text}</p></body></html>" if "a.edu" in u else None)
    got = {r["url"]: r for r in made.collect()}
    assert set(got) == {"http://a.edu/x", "http://b.com/y", "http://k.com"}
    assert got["http://a.edu/x"]["raw_metrics"]["source_reputation"] == 0.9 and got["http://a.edu/x"]["label"] == "5"
    assert got["http://b.com/y"]["label"] == "1" and set(got["http://b.com/y"]["raw_metrics"].values()) == {0.0}


def test_inserts_and_updates(spark):
    old = spark.createDataFrame([(1, "u1", "a"), (2, "u2", "b")], "id int, url string, v string")
    new = spark.createDataFrame([(2, "u9", "x"), (3, "u3", "y"), (3, "u3", "y"), (4, "u1", "z")], "id int, url string, v string")
    assert [tuple(r) for r in sinks.insert_ignore(old, new).collect()] == [(3, "u3", "y")]
    changed = spark.createDataFrame([("u1", "n"), ("u7", "m")], "url string, v string")
    assert {(r["url"], r["v"]) for r in sinks.upsert(old, changed, "url", ("v",)).collect()} == {("u1", "n"), ("u2", "b"), ("u7", "m")}
    assert {(r["id"], r["v"]) for r in sinks.update(old, spark.createDataFrame([(1, "q")], "id int, v string"), "id").collect()} == {(1, "q"), (2, "b")}
    assert sinks.replace(old, new.limit(1), "id").count() == 2


def test_mapping_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(1, -1), (2, 3)], "doc_id int, cluster_id int")
    folder = f"file://{tmp_path}/m"
    assert sinks.write_mapping(rows, folder, "one").items() >= {"id": "one", "n_docs": 2, "n_clusters": 1, "n_orphans": 1}.items()
    sinks.write_mapping(rows.limit(1), folder, "two")
    assert readers.mapping(spark, folder).count() == 1 and readers.mapping(spark, folder, "one").count() == 2
    found = sinks.storage(spark, folder, f"{folder}/none")
    assert found["bytes"] == sum(e["bytes"] for e in sinks.exports(spark, folder)) > 0 and found["files"] >= 3 and found["entries"][f"{folder}/none"] == []
    assert {e["name"] for e in sinks.exports(spark, folder)} >= {"one", "two", "manifest.json"}
    texts = rows.withColumn("created_at", F.to_timestamp(F.lit("2024-05-06 01:02:03")))
    sinks.write_archive(texts, f"{folder}/archive")
    assert (tmp_path / "m/archive/y=2024/m=05/d=06").exists()


def test_stream_equals_batch(spark, tmp_path):
    long = "plain words in a row " * 10
    rows = [("https://www.a.com/x", long), ("https://a.com/x/", long), ("https://a.com/login", long), ("https://b.com/y", "short"), ("https://c.com/z", long)]
    pages = spark.createDataFrame(rows, "url string, text string")
    pages.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = ingest.documents(ingest.files(spark, f"{tmp_path}/in", pages.schema, files_per_trigger=1))
    told = []
    assert ingest.run(stream, f"{tmp_path}/out", f"{tmp_path}/ck", interval=0, report=told.append) == {"batches": 3, "rows": 5}
    assert told[-1]["rows"] == 5 and told[0]["rows_per_second"] >= 0
    got = sorted(r["canonical_url"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted(r["canonical_url"] for r in ingest.documents(pages).collect()) == ["https://a.com/x", "https://c.com/z"]


def test_online_sample(spark, tmp_path):
    rows = [(1, [1.0, 0.0], 0.5), (2, [1.0, 0.001], 0.9), (3, [0.0, 1.0], 0.5)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, quality double")
    v.coalesce(1).write.parquet(f"{tmp_path}/v")
    stream = ingest.online_sample(ingest.files(spark, f"{tmp_path}/v", v.schema), shards=1)
    ingest.run(stream, f"{tmp_path}/o", f"{tmp_path}/c")
    assert sorted(r["vec_id"] for r in spark.read.parquet(f"{tmp_path}/o").collect()) == [1, 3]
    kept = []
    ingest.run(ingest.files(spark, f"{tmp_path}/v", v.schema), "", f"{tmp_path}/c2", ingest.reservoir_each(kept, 0.7))
    assert [k[1] for k in kept] == [2, 3]

class Cluster:
    """What the folder is asked for, of a session on a cluster without the setting."""

    master = "spark://host:7077"
    sparkContext = conf = _jsc = property(lambda self: self)  # noqa: N815
    getConf = sc = getCheckpointDir = lambda self: self  # noqa: N815
    get = lambda self, *args: None
    isDefined = lambda self: False  # noqa: E731, N815


def test_a_cluster_needs_a_shared_folder():
    from sparkloom import store

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_folder(Cluster())
