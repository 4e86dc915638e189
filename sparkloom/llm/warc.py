"""WARC archives: one gzip member per record, written and read sequentially.

Writing: each task writes archives of bounded size to the shared folder, under
names that hold its attempt, and returns one row for each; the table of these
rows is written by Spark, so only the archives of attempts that were committed
are ever read. Reading: a task streams through an archive with incremental zlib
decompression, one member at a time, frames each block by its content length
and verifies block and payload digests. Memory is a chunk and, where payloads
are asked for, one payload.

Of records with equal payloads of at least ``least`` bytes the one with the
largest key is the response and the others revisit it.

Defined results: a null payload counts as empty; rows with equal keys and equal
payloads are each a response if their key is the largest; null keys come before
all others; a null target becomes the record's own name; an empty table gives no
archives and an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import new_folder, written

CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Broken(ValueError):
    """An archive that does not follow the format or fails a digest."""


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload_bytes: int
    payload_sha1: str
    payload: bytes | None


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def name(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def key_of(name: str) -> int | None:
    key = name.removeprefix("<urn:page:").removesuffix(">")
    return int(key) if key else None


def member(key: int | None, target: str | None, payload: bytes, refers_to: int | None, revisit: bool, when: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as a gzip member."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in target) if target else name(key)[1:-1]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(key)}",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: {_digest(hashlib.sha1(payload).digest())}",
        f"WARC-Block-Digest: {_digest(hashlib.sha1(block).digest())}",
        *([f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    body = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(body) + packer.flush()


class Reader:
    """The records of an archive stream, in order."""

    def __init__(self, stream: BinaryIO, payloads: bool = False, chunk: int = CHUNK):
        self.stream, self.payloads, self.chunk = stream, payloads, chunk
        self.raw = b""  # compressed and not yet used

    def __iter__(self) -> Iterator[Record]:
        while True:
            if not self.raw:
                self.raw = self.stream.read(self.chunk)
                if not self.raw:
                    return
            self.unpacker, self.text = zlib.decompressobj(31), bytearray()
            yield self._record()
            # The rest of the member is the blank lines that end the record.
            while self._more():
                pass
            if bytes(self.text) != b"\r\n\r\n":
                raise Broken("a record does not end where its content length says")

    def _more(self) -> bool:
        """Decompress some more of this member into ``text``; False at its end."""
        while not self.unpacker.eof:
            if not self.raw:
                self.raw = self.stream.read(self.chunk)
                if not self.raw:
                    raise Broken("an archive ends inside a member")
            try:
                out = self.unpacker.decompress(self.raw, self.chunk)
            except zlib.error as e:
                raise Broken(str(e)) from e
            self.raw = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            if out:
                self.text += out
                return True
        return False

    def _headers(self) -> tuple[str, dict[str, str]]:
        while (end := self.text.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise Broken("a header does not end")
        first, *lines = bytes(self.text[:end]).decode("utf-8", "replace").split("\r\n")
        del self.text[: end + 4]
        return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}

    def _record(self) -> Record:
        first, headers = self._headers()
        if not first.startswith("WARC/"):
            raise Broken("not a WARC record")
        left = int(headers.get("content-length", -1))
        if left < 0:
            raise Broken("a record without a content length")
        while len(self.text) < left and b"\r\n\r\n" not in self.text:
            if not self._more():
                raise Broken("a block is cut off")
        cut = self.text.find(b"\r\n\r\n") + 4
        http, block = {}, hashlib.sha1()
        if headers.get("content-type", "").startswith("application/http") and 4 <= cut <= left:
            block.update(self.text[:cut])
            left -= cut
            http = self._headers()[1]
        body, kept, size = hashlib.sha1(), [], left
        while left:
            if not self.text and not self._more():
                raise Broken("a block is cut off")
            part = bytes(self.text[:left])
            del self.text[:left]
            body.update(part)
            block.update(part)
            left -= len(part)
            if self.payloads:
                kept.append(part)
        if "warc-block-digest" in headers and headers["warc-block-digest"] != _digest(block.digest()):
            raise Broken(f"{headers.get('warc-record-id')}: wrong block digest")
        told = headers.get("warc-payload-digest")
        if headers.get("warc-type") == "revisit":
            sha1 = base64.b32decode((told or "").removeprefix("sha1:")).hex()
            return Record(headers, http, int(http.get("content-length", 0)), sha1, None)
        if told and told != _digest(body.digest()):
            raise Broken(f"{headers.get('warc-record-id')}: wrong payload digest")
        return Record(headers, http, size, body.hexdigest(), b"".join(kept) if self.payloads else None)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def resolved(pages: DataFrame, key: str = "page_id", payload: str = "html", target: str = "url", least: int = 1000) -> DataFrame:
    """key, target, payload, revisit and refers_to of each row.

    Payload groups of at least a thousandth of all rows are at most a thousand,
    so they are broadcast; the others are joined by digest, and no digest of
    that join has more than a thousandth of the rows.
    """
    rows = pages.select(F.col(key).cast("bigint").alias("key"), F.col(target).alias("target"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = rows.where(F.length("payload") >= least)
    groups = written(long.groupBy("digest").agg(F.max("key").alias("best"), F.count("*").alias("n")).where("n > 1"), "groups")
    total = pages.count()
    share = max(2, total // 1000)
    hot = groups.where(F.col("n") >= share).select("digest", "best")
    others = groups.where(F.col("n") < share).select("digest", "best")
    marked = long.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left")
    first = marked.where("hot").drop("hot")
    second = marked.where("hot is null").drop("hot", "best").join(others, "digest", "left")
    short = rows.where(F.length("payload") < least).withColumn("best", F.lit(None).cast("bigint"))
    every = first.unionByName(second).unionByName(short)
    revisit = F.col("best").isNotNull() & ~F.col("key").eqNullSafe(F.col("best"))
    return every.select("key", "target", "payload", revisit.alias("revisit"), F.when(revisit, F.col("best")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = 32 << 20) -> DataFrame:
    """Write ``resolved`` records below ``folder``; path and n_records of each archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        out, path, size, count, number = None, "", 0, 0, 0
        made: list[tuple[str, int]] = []
        for batch in batches:
            for key, target, payload, revisit, refers in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if out is None:
                    path = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                    out, size, count, number = system.open_output_stream(f"{base}/{path}", compression=None), 0, 0, number + 1
                data = member(key, target, payload, refers, revisit)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    made.append((f"{folder}/{path}", count))
                    out = None
        if out is not None:
            out.close()
            made.append((f"{folder}/{path}", count))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())], ["path", "n_records"])

    return written(records.select("key", "target", "payload", "revisit", "refers_to").mapInArrow(write, "path string, n_records bigint"), "archives")


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives at ``archives.path``: key, target, record_type,
    payload_bytes, payload_digest (hex SHA-1), refers_to and, where asked for, payload."""
    files = archives.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "target", "record_type", "payload_bytes", "payload_digest", "refers_to", *["payload"] * payloads]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * payloads]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, base = _filesystem(path)
                rows, held = [], 0
                with system.open_input_stream(base, compression=None) as stream:
                    for r in Reader(stream, payloads):
                        refers = r.headers.get("warc-refers-to")
                        row = (key_of(r.headers["warc-record-id"]), r.headers.get("warc-target-uri"), r.headers["warc-type"], r.payload_bytes, r.payload_sha1, key_of(refers) if refers else None)
                        rows.append((*row, *[r.payload] * payloads))
                        held += 200 + len(r.payload or b"")
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names)
                            rows, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names)

    schema = "key bigint, target string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint" + ", payload binary" * payloads
    return archives.select("path").repartition(max(1, files)).mapInArrow(read, schema)


def archived(pages: DataFrame, key: str = "page_id", payload: str = "html", target: str = "url", least: int = 1000) -> DataFrame:
    """Write a record per row, then the records as read back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(resolved(pages, key, payload, target, least), folder))
