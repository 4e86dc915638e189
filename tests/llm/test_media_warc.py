from __future__ import annotations

import hashlib
import io
import os
import random
import struct
import tracemalloc
import zlib

import numpy as np
import pytest

from sparkloom.llm import media, queries, warc


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1023, 1024, 1025, 5000, 16 * 64 * 3, 200_000])
def test_round_trip(n):
    data = media.padded(os.urandom(n))
    assert len(data) % 64 == 0 and len(data) >= 64
    file = media.wrap(data)
    tracks, error = media.probe(file)
    assert error is None and len(tracks) == 1
    t = tracks[0]
    assert media.payload(file, t) == data
    assert (t.codec, t.kind, t.duration, t.timescale) == ("raw ", "soun", len(data), media.RATE)
    frames = t.keyframes()
    assert len(frames) == -(-len(data) // 1024)
    at = file.index(b"mdat") + 4
    assert frames[0].tolist() == [at, 64]


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def test_foreign_layout():
    """Two chunk sizes, sizes from a table, media data first, a 64-bit box size, no sync table."""
    samples = [os.urandom(n) for n in (5, 7, 11, 13, 17)]
    body = b"".join(samples)
    mdat = struct.pack(">I4sQ", 1, b"mdat", len(body) + 16) + body
    u = lambda *x: struct.pack(f">{len(x)}I", *x)
    chunks = [16, 16 + 5 + 7, 16 + 5 + 7 + 11 + 13]
    stbl = box(b"stbl", box(b"stsd", u(0, 1), box(b"avc1", bytes(8))), box(b"stts", u(0, 2, 2, 10, 3, 20)), box(b"stsc", u(0, 2, 1, 2, 1, 3, 1, 1)), box(b"stsz", u(0, 0, 5, 5, 7, 11, 13, 17)), box(b"stco", u(0, 3, *chunks)))
    moov = box(b"moov", box(b"trak", box(b"mdia", box(b"mdhd", u(0, 0, 0, 1000, 80, 0)), box(b"hdlr", u(0, 0), b"vide", bytes(13)), box(b"minf", stbl))))
    tracks, error = media.probe(mdat + moov)
    assert error is None
    t = tracks[0]
    assert (t.codec, t.kind, t.timescale, t.duration) == ("avc1", "vide", 1000, 80)
    assert t.times.tolist() == [0, 10, 20, 40, 60]
    assert media.payload(mdat + moov, t) == body and len(t.keyframes()) == 5
    starts = np.cumsum([16, 5, 7, 11, 13])
    assert t.offsets.tolist() == starts.tolist()


@pytest.mark.parametrize("cut", [0, 5, 40, 300, 600])
def test_faults_are_told(cut):
    file = media.wrap(media.padded(b"x" * 2000))
    assert media.probe(file[:cut])[1] is not None
    assert media.probe(b"not a file at all, but text")[1] is not None


def u(*x):
    return struct.pack(f">{len(x)}I", *x)


def small(stts=(0, 1, 2, 10), stsc=(0, 1, 1, 2, 1), stsz=(0, 4, 2), stco=(0, 1, 0), stss=(0, 1, 1)):
    stbl = box(b"stbl", box(b"stsd", u(0, 1), box(b"avc1", bytes(8))), box(b"stts", u(*stts)), box(b"stsc", u(*stsc)), box(b"stsz", u(*stsz)), box(b"stco", u(*stco)), box(b"stss", u(*stss)))
    return box(b"moov", box(b"trak", box(b"tkhd", u(0, 0, 0, 1, 0)), box(b"mdia", box(b"mdhd", u(0, 0, 0, 1000, 80, 0)), box(b"hdlr", u(0, 0), b"vide", bytes(13)), box(b"minf", stbl)))) + bytes(600)


MANY = 0xFFFFFFF0


@pytest.mark.parametrize("tables", [{"stsz": (0, 1, MANY)}, {"stsz": (0, 4, MANY)}, {"stsz": (0, 0, MANY)}, {"stts": (0, 1, MANY, 1)}, {"stts": (0, MANY, 1, 1)}, {"stsc": (0, 1, 1, MANY, 1)}, {"stsc": (0, MANY, 1, 1, 1)}, {"stsc": (0, 1, MANY, 1, 1)}, {"stsc": (0, 1, 0, 2, 1)}, {"stco": (0, MANY, 0)}, {"stss": (0, MANY, 1)}, {"stss": (0, 1, 0)}, {"stss": (0, 1, 3)}, {"stss": (0, 2, 2, 1)}])
def test_counts_are_held_against_the_file(tables):
    assert media.probe(small())[1] is None
    tracemalloc.start()
    tracks, error = media.probe(small(**tables))
    frames = [t.keyframes() for t in tracks]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    if tables == {"stsc": (0, 1, 1, MANY, 1)}:
        assert error is None  # a chunk may have room for more samples than there are
    else:
        assert error and (not tracks or not len(frames[0]) or "stts" in tables)
    assert peak < 5e6


def test_damaged_files_never_raise():
    rng = random.Random(3)
    whole = [small(), media.wrap(media.padded(b"y" * 3000)), fragmented()[0]]
    for _ in range(3000):
        data = bytearray(rng.choice(whole))
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(min(len(data), 900))
            data[at] = rng.choice([0, 1, 255, rng.randrange(256)])
        tracks, _ = media.probe(bytes(data[: rng.choice([len(data), rng.randrange(len(data))])]))
        for t in tracks:
            media.feature(t)
            assert (t.offsets >= 0).all()


def fragmented():
    """Two fragments: sizes in the first's run, defaults in the second's; bases at the fragment."""
    stbl = box(b"stbl", box(b"stsd", u(0, 1), box(b"hvc1", bytes(8))), box(b"stts", u(0, 0)), box(b"stsc", u(0, 0)), box(b"stsz", u(0, 0, 0)), box(b"stco", u(0, 0)))
    trak = box(b"trak", box(b"tkhd", u(0, 0, 0, 7, 0)), box(b"mdia", box(b"mdhd", u(0, 0, 0, 1000, 0, 0)), box(b"hdlr", u(0, 0), b"vide", bytes(13)), box(b"minf", stbl)))
    moov = box(b"moov", trak, box(b"mvex", box(b"trex", u(0, 7, 1, 40, 6, 0x10000))))
    samples = [os.urandom(n) for n in (9, 4, 5, 6, 6)]

    def one(run, time, body):
        make = lambda offset: box(b"moof", box(b"mfhd", u(0, 1)), box(b"traf", box(b"tfhd", u(0x20000, 7)), box(b"tfdt", u(0, time)), box(b"trun", run(offset))))
        return make(len(make(0)) + 8) + box(b"mdat", body)

    a = one(lambda at: u(0x205, 3, at, 0, 9, 4, 5), 0, b"".join(samples[:3]))
    b = one(lambda at: u(0x401, 2, at, 0x10000, 0), 120, b"".join(samples[3:]))
    return moov + a + b, samples


def test_fragments():
    file, samples = fragmented()
    tracks, error = media.probe(file)
    assert error is None and len(tracks) == 1
    t = tracks[0]
    assert (t.codec, t.duration, t.sizes.tolist(), t.times.tolist(), t.sync.tolist()) == ("hvc1", 200, [9, 4, 5, 6, 6], [0, 40, 80, 120, 160], [0, 4])
    assert media.payload(file, t) == b"".join(samples)
    assert [file[a : a + n] for a, n in t.keyframes().tolist()] == [samples[0], samples[4]]
    assert media.probe(file.replace(u(0x401, 2), u(0x001, MANY)))[1] is not None


def test_query_columns(spark, tmp_path):
    long = "é" * 40_000
    rows = [(1, "abc", "clash"), (2, None, "x"), (3, "", "x"), (4, long, "x"), (5, "abc", "x")]
    spark.createDataFrame(rows, "doc_id bigint, text string, media string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op1_media(spark, str(tmp_path)).collect()}
    for key, text, _ in rows:
        raw = (text or "").encode()
        data = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = got[key]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
    assert got[1]["media_sha256"] == got[5]["media_sha256"] and got[2]["feature"] == got[3]["feature"]
    probed = media.probed(media.wrapped(spark.createDataFrame([("hello",), (None,)], "text string"))).select("tracks").collect()
    assert probed[0][0][0]["codec"] == "raw " and probed[0][0][0]["keyframes"][0]["length"] == 64


def archive(*members):
    return b"".join(members)


def test_reader_frames_and_verifies():
    pages = [b"", b"\r\n\r\n" * 50, os.urandom(200_000), b"WARC/1.1\r\nContent-Length: 5\r\n\r\n"]
    data = archive(*(warc.member(i, f"http://x/{i}", p, None, False) for i, p in enumerate(pages)))
    for chunk in (7, 1000, 1 << 16):
        got = list(warc.Reader(io.BytesIO(data), payloads=True, chunk=chunk))
        assert [r.payload for r in got] == pages
        assert [r.payload_sha1 for r in got] == [hashlib.sha1(p).hexdigest() for p in pages]
    # Each record is a gzip member of its own.
    one = zlib.decompressobj(31)
    assert one.decompress(data).endswith(b"\r\n\r\n\r\n\r\n") and one.unused_data
    with pytest.raises(warc.Broken):
        list(warc.Reader(io.BytesIO(data[:-20])))
    raw = zlib.decompress(warc.member(1, None, b"payload", None, False), 31).replace(b"payload", b"pAyload")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(warc.Broken, match="digest"):
        list(warc.Reader(io.BytesIO(packer.compress(raw) + packer.flush())))


def test_revisits(spark, tmp_path):
    big, other = "x" * 1000, "y" * 5000
    rows = [(1, "u", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u\n", other), (6, "u", None), (7, "u", big), (8, "u", "é" * 500), (9, "u", "é" * 500)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in queries.op6_warc(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for key, _, html in rows:
        raw = (html or "").encode()
        best = max(k for k, _, h in rows if h == html)
        r = got[key]
        revisit = len(raw) >= 1000 and best != key
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", best) if revisit else ("response", None))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op6_warc(spark, str(tmp_path)).count() == 0
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op1_media(spark, str(tmp_path)).count() == 0
