"""Shared plumbing of the training-data operators: the shared work folder,
written intermediate tables and byte-balanced batches for Arrow functions."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none and all runs in this process (tests), a
    temporary folder is set as checkpoint folder and used. On a cluster, whose
    machines would not share it, that raises.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="loom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_made: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    _made.append(f"{shared_dir(spark)}/loom/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def count() -> int:
    """How many intermediate tables and archives of this process are there."""
    return len(_made)


def clear(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Delete the intermediate tables and archives that this process has written,
    from number ``since`` on and but for ``keep``; to be called when their results
    are no longer read. What is left is deleted when the process ends. Their number."""
    gone = [x for x in _made[since:] if x not in keep]
    _made[since:] = [x for x in _made[since:] if x in keep]
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for x in gone:
        path = jvm.org.apache.hadoop.fs.Path(x)
        path.getFileSystem(settings).delete(path, True)
    return len(gone)


@atexit.register
def _at_exit() -> None:
    jvm, spark = SparkContext._jvm, SparkSession.getActiveSession()
    if _made and jvm:
        with contextlib.suppress(Exception):  # the JVM may be ending, too
            settings = spark.sparkContext._jsc.hadoopConfiguration() if spark else jvm.org.apache.hadoop.conf.Configuration()
            for x in _made:
                path = jvm.org.apache.hadoop.fs.Path(x)
                path.getFileSystem(settings).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    return written_at(df, new_folder(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    """written() to a given path."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def crc_fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4


def text_batches(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the incoming batches of about ``max_bytes`` of ``column``,
    one row at least, with the column as a Python list."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > max_bytes:
                part = batch.slice(start, i - start)
                yield part, part.column(at).to_pylist()
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, part.column(at).to_pylist()
