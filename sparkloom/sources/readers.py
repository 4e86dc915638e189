"""Readers of dumps, archives, golden sets and mappings.

Each gives url, html, text, metadata (map) and domain where it reads a dump.
Unreadable lines and archives are skipped; a missing path raises.
"""

from __future__ import annotations

import io
import lzma
import tarfile
import time
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S
from sparkloom.schemas import DUMP

Reader = Callable[[SparkSession, str], DataFrame]


def _dump(df: DataFrame, **columns: Column) -> DataFrame:
    """The dump columns; those that are not given are null."""
    kinds = {c.split(" ")[0]: c.split(" ", 1)[1] for c in DUMP.replace("map<string,string>", "map<string;string>").split(", ")}
    return df.select(*((columns[k] if k in columns else F.lit(None).cast(t.replace(";", ","))).alias(k) for k, t in kinds.items()))


def _first(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object a line, .gz too; url, URL or link; html or content; lines without a URL are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    schema = "url string, URL_ string, link string, html string, content string, metadata map<string,string>, domain string"
    # Field names differ only in case, so the second is renamed before the schema is applied.
    fixed = F.regexp_replace("value", r'"URL"\s*:', '"URL_":')
    r = lines.select(F.from_json(fixed, schema, {"mode": "PERMISSIVE"}).alias("r"))
    out = _dump(r, url=_first(F.col("r.url"), F.col("r.URL_"), F.col("r.link")), html=_first(F.col("r.html"), F.col("r.content")), metadata=F.col("r.metadata"), domain=F.col("r.domain"))
    return out.where("url is not null")


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """A URL a line, up to the first comma; blank lines, # comments and others are skipped."""
    value = F.trim(F.substring_index(F.trim("value"), ",", 1))
    rows = spark.read.text(path).where(~F.trim("value").startswith("#"))
    return _dump(rows, url=value).where(F.col("url").startswith("http"))


def curlie(spark: SparkSession, path: str) -> DataFrame:
    """External links of a directory page, each once, or the links of a directory's RDF dump."""
    pages = spark.read.text(path, wholetext=True)
    is_page = F.lower("value").contains("<html") | F.lower("value").contains("<a ")
    hrefs = F.regexp_extract_all("value", F.lit(r"""href=["'](https?://[^"']+)["']"""), F.lit(1))
    about = F.regexp_extract_all("value", F.lit(r"""<(?:link[^>]*resource|ExternalPage about)=["']([^"']+)["']"""), F.lit(1))
    found = F.when(is_page, F.filter(F.array_distinct(hrefs), lambda u: ~u.contains("curlie.org"))).otherwise(about)
    return _distinct(pages.select(F.explode(found).alias("url")).where(F.col("url").startswith("http")))


def _distinct(df: DataFrame) -> DataFrame:
    """Each URL once; the other columns are null."""
    return _dump(df.select("url").distinct(), url=F.col("url"))


def c4(spark: SparkSession, path: str) -> DataFrame:
    """*.json.gz files below a folder: url, extracted text, time stamp and file name."""
    r = spark.read.schema("url string, text string, timestamp string").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json.gz").json(path)
    meta = F.map_from_arrays(F.array(F.lit("timestamp"), F.lit("source_file")), F.array("timestamp", F.col("_metadata.file_name")))
    return _dump(r.where("url is not null"), url=F.col("url"), text=F.col("text"), metadata=meta)


# -- column archives ----------------------------------------------------------


def varints(data: bytes) -> np.ndarray:
    """Little-endian base-128 numbers, seven bits a byte."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    last = raw < 128
    starts = np.concatenate([[0], np.flatnonzero(last[:-1]) + 1])
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


def strings(data: bytes, lengths: np.ndarray) -> list[str]:
    """The texts of the given byte lengths, as far as the data goes."""
    ends = np.cumsum(lengths)
    ends = ends[: int(np.searchsorted(ends, len(data), side="right"))]
    starts = ends - lengths[: len(ends)]
    return [data[a:b].decode("utf-8", "ignore") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def unzstd(data: bytes) -> bytes:
    """Zstandard frames, also those that do not tell their size."""
    with pa.CompressedInputStream(pa.BufferReader(data), "zstd") as stream:
        return stream.read()


def slop_rows(archive: bytes, name: str) -> Iterator[tuple[str, str | None, str | None, str]]:
    """(url, html, domain, archive) rows of one zipped column archive; nothing where it is broken."""
    try:
        with zipfile.ZipFile(io.BytesIO(archive)) as z:
            names = z.namelist()

            def column(kind: str) -> list[str] | None:
                data = next((n for n in names if kind in n and n.endswith(".zstd")), None)
                sizes = next((n for n in names if kind in n and "len" in n and n.endswith(".bin")), None)
                return strings(unzstd(z.read(data)), varints(z.read(sizes))) if data and sizes else None

            urls = column("url")
            if urls is None:
                return
            try:
                bodies = column("body") or []
            except (OSError, pa.ArrowException):
                bodies = []
            words = next((n for n in names if "domain" in n and "dic" in n and n.endswith(".bin")), None)
            domain = z.read(words).decode("utf-8", "ignore").strip("\x00") if words else None
    except (zipfile.BadZipFile, OSError, pa.ArrowException):
        return
    for i, url in enumerate(urls):
        if url.startswith("http"):
            yield url, bodies[i] if i < len(bodies) else None, domain, name


def tar_members(path: str, suffix: str = "") -> Iterator[tuple[str, bytes]]:
    """(name, content) of the files of a tar, as far as it can be read: a broken or
    cut-off tar gives the files before the fault."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(path)
    with system.open_input_stream(base, compression=None) as raw:
        try:
            with tarfile.open(fileobj=raw, mode="r|*") as tar:
                for m in tar:
                    if m.isfile() and m.name.endswith(suffix):
                        yield m.name, tar.extractfile(m).read()
        except (tarfile.TarError, EOFError, zlib.error, lzma.LZMAError, OSError):
            return


def _some(rows: Iterator[tuple], most: int = 4 << 20) -> list[tuple]:
    """The next rows, of about ``most`` characters together."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(x) for x in row if x)
        if size > most:
            break
    return out


def slop(spark: SparkSession, path: str) -> DataFrame:
    """Column archives (*.slop.zip) in tar files, a task a file and an archive at a
    time; broken tars and archives give what stands before the fault."""
    files = spark.read.format("binaryFile").load(path).select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for name, data in tar_members(path, ".slop.zip"):
                    rows = slop_rows(data, name)
                    while part := _some(rows):
                        columns = [pa.array([r[i] for r in part], pa.string()) for i in range(4)]
                        yield pa.RecordBatch.from_arrays(columns, ["url", "html", "domain", "archive"])

    rows = files.repartition(max(1, files.count())).mapInArrow(read, "url string, html string, domain string, archive string")
    return _dump(rows, url=F.col("url"), html=F.col("html"), domain=F.col("domain"), metadata=F.create_map(F.lit("source_archive"), F.col("archive")))


# -- the rest -------------------------------------------------------------------


def adapter(path: str, is_directory: bool = False) -> Reader:
    """The first reader that takes a path: C4 folder, column archive, JSONL, URL list, Curlie."""
    p = path.lower()
    if is_directory:
        return c4
    if p.endswith((".tar", ".tar.gz", ".tgz")):
        return slop
    if p.endswith((".jsonl", ".jsonl.gz", ".ndjson", ".json", ".json.gz")):
        return jsonl
    if p.endswith((".txt", ".csv", ".urls")):
        return url_list
    if "curlie" in p or p.endswith((".html", ".htm", ".rdf", ".xml")):
        return curlie
    raise TypeError(f"no reader for {path}")


def with_retry(get: Callable[[str], tuple[int, str | None]], attempts: int = 2, fallback: Callable[[str], str | None] | None = None, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str | None]:
    """A fetch for fetched() from ``get``, which gives (status, body).

    Status 200 gives the body. After 429 and 503 it waits 2^n seconds, after a
    time-out or connection error not; before each further attempt it waits
    2^n / 2. Other statuses and errors end it. Where no body came, ``fallback`` is
    asked.
    """

    def fetch(url: str) -> str | None:
        body = None
        for n in range(attempts):
            try:
                status, found = get(url)
                if status == 200:
                    body = found
                    break
                if status not in (429, 503):
                    break
                sleep(2.0**n)
            except (TimeoutError, ConnectionError):
                pass
            except Exception:
                break
            if n < attempts - 1:
                sleep(0.5 * 2**n)
        return body or (fallback(url) if fallback else None)

    return fetch


def fetched(urls: DataFrame, fetch: Callable[[str], str | None] | None = None, at_once: int = 16) -> DataFrame:
    """The dump with html where neither it nor text is there: from ``fetch``, called
    in the tasks ``at_once`` at a time, or passed through where no fetch is given.
    A fetch that fails leaves html null."""
    if fetch is None:
        return urls

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        def one(r: dict) -> str | None:
            try:
                return fetch(r["url"]) if r["html"] is None and r["text"] is None else r["html"]
            except Exception:
                return None

        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                for start in range(0, len(batch), 256):
                    part = batch.slice(start, 256)
                    html = pa.array(list(pool.map(one, part.to_pylist())), pa.string())
                    yield part.set_column(part.schema.get_field_index("html"), "html", html)

    return urls.mapInArrow(run, urls.schema)


def first_of_dump(dump: DataFrame, per_dump: int | None = None, total: int | None = None, source: str = "source", order: str = "position") -> DataFrame:
    """At most ``per_dump`` rows of each source, and ``total`` of all, in their order."""
    if per_dump is not None:
        rank = F.row_number().over(Window.partitionBy(source).orderBy(order))
        dump = dump.withColumn("_rank", rank).where(F.col("_rank") <= per_dump).drop("_rank")
    return dump if total is None else dump.orderBy(source, order).limit(total)


def canonical_urls(docs: DataFrame, column: str = "canonical_url") -> DataFrame:
    """The canonical URLs of stored documents that have one, for anti joins on resume."""
    return docs.select(column).where(F.col(column).isNotNull() & (F.col(column) != ""))


def archive(spark: SparkSession, path: str, schema: str = "id string, url string, text string, position bigint") -> DataFrame:
    """Archived texts (.jsonl, .gz, .zst by date); broken lines are skipped."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("mode", "DROPMALFORMED").json(path)


def golden_csv(spark: SparkSession, path: str) -> DataFrame:
    """url, label (1 to 5), content_type and notes; rows without a valid label are skipped."""
    rows = spark.read.option("header", True).csv(path)
    if missing := {"url", "label"} - set(rows.columns):
        raise ValueError(f"the golden set lacks {', '.join(sorted(missing))}")
    optional = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    out = rows.select(F.trim("url").alias("url"), S.golden_label(F.col("label")).alias("label"), F.coalesce(F.nullif(F.trim(optional("content_type")), F.lit("")), F.lit("default")).alias("content_type"), F.coalesce(F.trim(optional("notes")), F.lit("")).alias("notes"))
    return out.where("url is not null and url <> '' and label is not null")


def mapping(spark: SparkSession, folder: str, mapping_id: str | None = None) -> DataFrame:
    """The latest mapping by the manifest, or the named one. Without a table: the
    JSON lines that write_mapping() makes, or one JSON file with a list "mappings"."""
    from sparkloom.sources import sinks

    known = sinks.manifest(spark, folder)
    if known and (mapping_id is None or any(m["id"] == mapping_id for m in known)):
        name = mapping_id or known[-1]["id"]
        return spark.read.parquet(f"{folder}/{name}")
    name = mapping_id or "latest"
    if sinks.exists(spark, f"{folder}/{name}-json"):
        return spark.read.json(f"{folder}/{name}-json")
    return spark.read.option("multiLine", True).json(f"{folder}/{name.removesuffix('.json')}.json").selectExpr("inline(mappings)")


def mapping_list(spark: SparkSession, folder: str) -> list[dict]:
    """id, name and created_at of the manifest's mappings in their order, then of the
    JSON files that it does not name, the newest first."""
    from sparkloom.sources import sinks

    known = [{"id": m["id"], "name": m["id"].removesuffix(".parquet"), "created_at": m.get("created_at", "")} for m in sinks.manifest(spark, folder)]
    files = [e for e in sinks.exports(spark, folder) if e["name"].endswith(".json") and e["name"] != "manifest.json"]
    ids = {m["id"] for m in known}
    return known + [{"id": e["name"], "name": e["name"].removesuffix(".json"), "created_at": e["modified"]} for e in sorted(files, key=lambda e: e["modified"], reverse=True) if e["name"] not in ids]


def sample_tar(source: str, target: str, n: int, seed: int = 42) -> list[str]:
    """Write ``n`` random files of a tar on this machine to a new one; their names.
    More than there are raises. Names are read first, contents only of the chosen."""
    import random

    with tarfile.open(source, "r:*") as tar:
        members = [m for m in tar.getmembers() if m.isfile()]
        if n > len(members):
            raise ValueError(f"{n} files of {len(members)}")
        chosen = random.Random(seed).sample(members, n)
        with tarfile.open(target, "w:gz" if target.endswith((".gz", ".tgz")) else "w") as out:
            for m in chosen:
                out.addfile(m, tar.extractfile(m))
    return [m.name for m in chosen]


def sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` random rows; more than there are raises."""
    if n > (have := df.count()):
        raise ValueError(f"{n} rows of {have}")
    return df.orderBy(F.rand(seed)).limit(n)
