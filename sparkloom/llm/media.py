"""Media columns in ISO base media containers.

``probe`` walks the nested boxes of a file and decodes its sample tables (sizes,
chunk offsets, samples per chunk, times, sync samples) and the runs of its movie
fragments; it gives each track's codec, duration and the byte ranges of its
keyframes and never touches the media data. Counts are held against the bytes
that stand for them before anything is made of their size, so memory is bounded
by the file. ``wrap`` stores bytes losslessly as a track of 8-bit samples; ``payload``
reads a track's bytes back through its sample table.

Defined results: null bytes wrap as an empty payload and probe as null; files
that are cut off or not ISO media give the tracks found before the fault and
``error``; repeated rows give equal files and features; extra columns stay.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches

#: Boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"udta", b"dinf", b"mvex", b"moof", b"traf"}
UNIT = 64
RATE = 8000
#: Samples from one sync sample to the next.
GROUP = 16
CODEC = b"raw "


@dataclass
class Track:
    kind: str = ""
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    sync: np.ndarray | None = None  # sample numbers from 0; None: all
    number: int = 0

    def keyframes(self) -> np.ndarray:
        """(offset, length) of every sync sample in the file."""
        at = np.arange(len(self.offsets)) if self.sync is None else self.sync
        return np.column_stack([self.offsets[at], self.sizes[at]])


class Fault(ValueError):
    """The file breaks the format."""


def boxes(data: memoryview, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, body start, end) of the boxes from start to end."""
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise Fault("a box header is cut off")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise Fault(f"box {kind!r} has {size} bytes where {end - start} are left")
        yield kind, start + head, start + size
        start += size


def walk(data: memoryview, start: int, end: int, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """All boxes with the types on the way to them, containers first."""
    for kind, body, stop in boxes(data, start, end):
        yield (*path, kind), body, stop
        if kind in CONTAINERS and len(path) < 16:
            yield from walk(data, body, stop, (*path, kind))


def _table(data: memoryview, at: int, stop: int, kind: str, columns: int = 1) -> np.ndarray:
    """A counted table of big-endian numbers whose count stands at ``at``."""
    count = struct.unpack_from(">I", data, at)[0]
    width = np.dtype(kind).itemsize * columns
    if at + 4 + count * width > stop:
        raise Fault("a sample table is cut off")
    out = np.frombuffer(data, dtype=kind, count=count * columns, offset=at + 4).astype(np.int64)
    return out.reshape(-1, columns) if columns > 1 else out


def probe(data: bytes) -> tuple[list[Track], str | None]:
    """The tracks of a file, and what is wrong with it."""
    view = memoryview(data)
    tracks: list[Track] = []
    tables: list[dict] = []
    extra: dict[int, tuple[int, int, int]] = {}
    runs = Runs()
    error = None
    try:
        found = False
        for path, at, stop in walk(view, 0, len(view)):
            found = True
            kind = path[-1]
            if kind == b"trak":
                tracks.append(Track())
                tables.append({})
            if kind == b"trex":
                number, _, *defaults = struct.unpack_from(">5I", view, at + 4)
                extra[number] = tuple(defaults)
            elif kind in (b"moof", b"tfhd", b"tfdt", b"trun"):
                runs.read(view, kind, at, stop, extra)
            if not tracks or b"trak" not in path:
                continue
            track, own = tracks[-1], tables[-1]
            if kind == b"tkhd":
                track.number = struct.unpack_from(">I", view, at + (20 if view[at] == 1 else 12))[0]
            elif kind == b"mdhd":
                if view[at] == 1:
                    track.timescale, track.duration = struct.unpack_from(">IQ", view, at + 20)
                else:
                    track.timescale, track.duration = struct.unpack_from(">II", view, at + 12)
            elif kind == b"hdlr" and path[-2] == b"mdia":
                track.kind = bytes(view[at + 8 : at + 12]).decode("latin-1")
            elif kind == b"stsd":
                if struct.unpack_from(">I", view, at + 4)[0]:
                    track.codec = bytes(view[at + 12 : at + 16]).decode("latin-1")
            elif kind == b"stsz":
                fixed, count = struct.unpack_from(">II", view, at + 4)
                if fixed and fixed * count > len(view):
                    raise Fault("samples lie beyond the end")
                own["sizes"] = np.full(count, fixed, dtype=np.int64) if fixed else _table(view, at + 8, stop, ">u4")
            elif kind == b"stz2":
                bits = view[at + 7]
                if bits == 4:
                    count = struct.unpack_from(">I", view, at + 8)[0]
                    if at + 12 + -(-count // 2) > stop:
                        raise Fault("a sample table is cut off")
                    raw = np.frombuffer(view, dtype=np.uint8, count=-(-count // 2), offset=at + 12)
                    own["sizes"] = np.column_stack([raw >> 4, raw & 15]).reshape(-1)[:count].astype(np.int64)
                elif bits in (8, 16):
                    own["sizes"] = _table(view, at + 8, stop, f">u{bits // 8}")
                else:
                    raise Fault(f"sample sizes of {bits} bits")
            elif kind == b"stco":
                own["chunks"] = _table(view, at + 4, stop, ">u4")
            elif kind == b"co64":
                own["chunks"] = _table(view, at + 4, stop, ">u8")
            elif kind == b"stsc":
                own["runs"] = _table(view, at + 4, stop, ">u4", 3)
            elif kind == b"stts":
                own["deltas"] = _table(view, at + 4, stop, ">u4", 2)
            elif kind == b"stss":
                track.sync = np.zeros(0, dtype=np.int64)
                track.sync = _table(view, at + 4, stop, ">u4") - 1
        if not found:
            error = "no boxes"
        elif 0 < len(view) - max(b for _, _, b in boxes(view, 0, len(view))) < 8:
            error = "a box header is cut off"
    except (Fault, struct.error, ValueError, IndexError) as e:
        error = str(e)
    for track, own in zip(tracks, tables, strict=True):
        try:
            if own or track.number not in runs.found:
                _place(track, own)
        except Fault as e:
            error = error or str(e)
            track.sync = np.zeros(0, dtype=np.int64)
        if track.number in runs.found:
            runs.append(track)
        if len(track.offsets) and int((track.offsets + track.sizes).max()) > len(view):
            error = error or "samples lie beyond the end"
    return tracks, error


def _place(track: Track, own: dict) -> None:
    """Each sample's offset, from the chunks' offsets and the samples a chunk."""
    sizes, chunks, runs = own.get("sizes"), own.get("chunks"), own.get("runs")
    if sizes is None or chunks is None or runs is None:
        raise Fault("a track has no sample table")
    firsts = np.append(runs[:, 0] - 1, len(chunks))
    if len(runs) and (firsts[0] != 0 or (np.diff(firsts) < 0).any()):
        raise Fault("the samples a chunk are out of order")
    each = np.repeat(runs[:, 1], np.diff(firsts)) if len(runs) else np.zeros(0, dtype=np.int64)
    ends = np.cumsum(each)
    if (ends[-1] if len(ends) else 0) < len(sizes) or len(each) < len(chunks):
        raise Fault("the chunks hold fewer samples than there are sizes")
    chunk = np.searchsorted(ends, np.arange(len(sizes)), side="right")
    before = np.cumsum(sizes) - sizes
    track.sizes = sizes
    track.offsets = chunks[chunk] + before - before[(ends - each)[chunk]] if len(sizes) else sizes
    if (track.offsets < 0).any():
        track.sizes = track.offsets = track.offsets[:0]
        raise Fault("samples lie beyond the end")
    if track.sync is not None and len(track.sync) and (track.sync[0] < 0 or track.sync[-1] >= len(sizes) or (np.diff(track.sync) <= 0).any()):
        raise Fault("sync samples are out of order or range")
    deltas = own.get("deltas")
    if deltas is not None:
        if deltas[:, 0].sum() > len(sizes):
            raise Fault("there are more times than samples")
        steps = np.repeat(deltas[:, 1], deltas[:, 0])
        track.times = np.cumsum(steps) - steps


class Runs:
    """The track runs of movie fragments, by track number."""

    def __init__(self):
        self.found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.ends: dict[int, int] = {}  # decode time after the runs so far
        self.moof = self.number = self.base = self.next = 0
        self.defaults = (0, 0, 0)  # duration, size, flags

    def read(self, view: memoryview, kind: bytes, at: int, stop: int, extra: dict[int, tuple[int, int, int]]) -> None:
        if kind == b"moof":
            wide = at >= 16 and struct.unpack_from(">I4s", view, at - 16) == (1, b"moof")
            self.moof = at - (16 if wide else 8)
            return
        flags = struct.unpack_from(">I", view, at)[0] & 0xFFFFFF
        place = at + 4

        def number(form: str = ">I") -> int:
            nonlocal place
            if place + struct.calcsize(form) > stop:
                raise Fault("a fragment's header is cut off")
            place += struct.calcsize(form)
            return struct.unpack_from(form, view, place - struct.calcsize(form))[0]

        if kind == b"tfhd":
            self.number = number()
            self.base = number(">Q") if flags & 1 else self.moof
            if flags & 2:
                number()
            given = [number() if flags & bit else None for bit in (8, 0x10, 0x20)]
            known = extra.get(self.number, (0, 0, 0))
            self.defaults = tuple(k if g is None else g for g, k in zip(given, known, strict=True))
            self.next = self.base
        elif kind == b"tfdt":
            self.ends[self.number] = number(">Q" if view[at] == 1 else ">I")
        else:
            count = number()
            start = self.base + number(">i") if flags & 1 else self.next
            first = number() if flags & 4 else None
            columns = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
            if place + 4 * len(columns) * count > stop or not flags & 0x200 and count * max(1, self.defaults[1]) > len(view):
                raise Fault("a track run is longer than its bytes")
            table = np.frombuffer(view, dtype=">u4", count=len(columns) * count, offset=place).astype(np.int64).reshape(count, len(columns))
            column = lambda bit, other: table[:, columns.index(bit)] if bit in columns else np.full(count, other, dtype=np.int64)
            durations, sizes, signs = (column(bit, other) for bit, other in zip((0x100, 0x200, 0x400), self.defaults, strict=True))
            if first is not None and count:
                signs = np.concatenate([[first], signs[1:]])
            offsets = start + np.cumsum(sizes) - sizes
            begin = self.ends.get(self.number, 0)
            if count and start < 0:
                raise Fault("samples lie beyond the end")
            self.found.setdefault(self.number, []).append((offsets, sizes, begin + np.cumsum(durations) - durations, signs & 0x10000 == 0))
            self.ends[self.number] = begin + int(durations.sum())
            self.next = start + int(sizes.sum())

    def append(self, track: Track) -> None:
        """The runs' samples after those of the track's own tables."""
        offsets, sizes, times, sync = (np.concatenate(x) for x in zip(*self.found[track.number], strict=True))
        old = np.arange(len(track.sizes)) if track.sync is None else track.sync
        track.sync = np.concatenate([old, np.flatnonzero(sync) + len(track.sizes)])
        track.offsets, track.sizes, track.times = (np.concatenate(x) for x in ((track.offsets, offsets), (track.sizes, sizes), (track.times, times)))
        track.duration = track.duration or self.ends[track.number]


def payload(data: bytes, track: Track) -> bytes:
    """The track's bytes, sample by sample; runs of neighbours are read at once."""
    if not len(track.offsets):
        return b""
    ends = track.offsets + track.sizes
    breaks = np.flatnonzero(track.offsets[1:] != ends[:-1]) + 1
    starts = track.offsets[np.concatenate([[0], breaks])]
    stops = ends[np.concatenate([breaks - 1, [len(ends) - 1]])]
    return b"".join(data[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True))


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 >= 1 << 32:
        return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def padded(data: bytes | None, unit: int = UNIT) -> bytes:
    """The bytes with zeros up to a positive multiple of ``unit``."""
    data = data or b""
    return data + bytes(max(unit, -(-len(data) // unit) * unit) - len(data))


def wrap(data: bytes, unit: int = UNIT, rate: int = RATE, group: int = GROUP) -> bytes:
    """A file with one sound track of 8-bit mono samples that are the bytes of
    ``data`` (a multiple of ``unit``): ``unit`` of them a table entry, in chunks
    that begin with a sync sample and hold ``group`` entries."""
    count = len(data) // unit
    chunks = -(-count // group)
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    length = len(data)

    def moov(first: int) -> bytes:
        wide = first + length >= 1 << 32
        offsets = first + np.arange(chunks, dtype=np.int64) * unit * group
        runs = [(1, group, 1)] if count % group == 0 or chunks > 1 else []
        if count % group:
            runs.append((chunks, count % group, 1))
        entry = _box(CODEC, bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, rate << 16))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, count, unit)),
            _full(b"stss", struct.pack(">I", chunks), (1 + np.arange(chunks) * group).astype(">u4").tobytes()),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            _full(b"stsz", struct.pack(">II", unit, count)),
            _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), offsets.astype(">u8" if wide else ">u4").tobytes()),
        )
        dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
        minf = _box(b"minf", _full(b"smhd", bytes(4)), dinf, stbl)
        mdhd = _full(b"mdhd", struct.pack(">QQIQHH", 0, 0, rate, length, 0x55C4, 0), version=1)
        hdlr = _full(b"hdlr", bytes(4), b"soun", bytes(12), b"bytes\0")
        tkhd = _full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, length), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), matrix, bytes(8), version=1, flags=3)
        mvhd = _full(b"mvhd", struct.pack(">QQIQ", 0, 0, rate, length), struct.pack(">IH", 0x10000, 0x100), bytes(10), matrix, bytes(24), struct.pack(">I", 2), version=1)
        return _box(b"moov", mvhd, _box(b"trak", tkhd, _box(b"mdia", mdhd, hdlr, minf)))

    head = 8 if length + 8 < 1 << 32 else 16
    # The offsets' width does not depend on their values below 4 GB.
    first = len(ftyp) + len(moov(0 if length < 1 << 31 else 1 << 32)) + head
    return ftyp + moov(first) + _box(b"mdat", data)


def feature(track: Track) -> str:
    """A track in one line: codec, kind, duration and its keyframes' ranges."""
    seconds = track.duration / track.timescale if track.timescale else 0.0
    ranges = ",".join(f"{a}+{n}" for a, n in track.keyframes().tolist())
    return f"codec={track.codec.strip()};kind={track.kind};seconds={seconds:.6f};samples={len(track.sizes)};keyframes={ranges}"


def wrapped(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """``df`` with each whole text's padded UTF-8 bytes as an ISO media column."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, text):
            files = pa.array([wrap(padded(None if x is None else x.encode("utf-8", "surrogatepass"))) for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, files], [*part.schema.names, media])

    if media in df.columns:
        raise ValueError(f"there is a column {media} already")
    kept = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)
    return df.mapInArrow(store, f"{kept}, `{media}` binary")


TRACKS = "array<struct<kind:string,codec:string,timescale:bigint,duration:bigint,seconds:double,n_samples:bigint,keyframes:array<struct<offset:bigint,length:bigint>>>>"


def probed(df: DataFrame, media: str = "media", into: str = "tracks") -> DataFrame:
    """``df`` with the tracks of a media column, of which no payload is read."""

    @F.arrow_udf(TRACKS)
    def look(values: pa.Array) -> pa.Array:
        out = []
        for data in values.to_pylist():
            if data is None:
                out.append(None)
                continue
            rows = []
            for t in probe(data)[0]:
                frames = [{"offset": a, "length": n} for a, n in t.keyframes().tolist()]
                rows.append({"kind": t.kind, "codec": t.codec, "timescale": t.timescale, "duration": t.duration, "seconds": t.duration / t.timescale if t.timescale else 0.0, "n_samples": len(t.sizes), "keyframes": frames})
            out.append(rows)
        frame = pa.struct([("offset", pa.int64()), ("length", pa.int64())])
        track = pa.struct([("kind", pa.string()), ("codec", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("seconds", pa.float64()), ("n_samples", pa.int64()), ("keyframes", pa.list_(frame))])
        return pa.array(out, pa.list_(track))

    return df.withColumn(into, look(F.col(media)))


def digests(df: DataFrame, media: str = "media", keep: tuple[str, ...] = ("doc_id", "n_bytes")) -> DataFrame:
    """``keep`` and the digests of each file and of the payload that its sample table leads to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keep, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for part, files in text_batches(batches, media, 4 << 20):
            rows = []
            for data in files:
                tracks, error = probe(data)
                if error or not tracks:
                    raise Fault(error or "no track")
                body = payload(data, tracks[0])
                rows.append((len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), feature(tracks[0])))
            kept = [part.column(x) for x in keep]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names)

    schema = df.select(*keep).schema
    kept = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in schema)
    return df.select(*keep, media).mapInArrow(read, f"{kept}, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
