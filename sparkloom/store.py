"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where all
    runs in this process and none is named, a temporary one is set; else that raises."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if named or current.isDefined():
        return (named or current.get()).rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="sparkloom-"))
    return context._jsc.sc().getCheckpointDir().get()


_made: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is deleted when this process ends."""
    _made.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def clear(spark: SparkSession) -> int:
    """Delete what new_folder() named; to be called when it is no longer read."""
    jvm, settings, gone = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), len(_made)
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(settings).delete(path, True)
    return gone


@atexit.register
def _at_exit() -> None:
    jvm, spark = SparkContext._jvm, SparkSession.getActiveSession()
    if _made and jvm:
        with contextlib.suppress(Exception):  # the JVM may be ending, too
            settings = spark.sparkContext._jsc.hadoopConfiguration() if spark else jvm.org.apache.hadoop.conf.Configuration()
            for x in _made:
                path = jvm.org.apache.hadoop.fs.Path(x)
                path.getFileSystem(settings).delete(path, True)


def reused(df: DataFrame) -> DataFrame:
    """``df`` for reading more than once: written in the shared folder, so that
    nothing stays in the executors' memory and a lost one costs a re-read."""
    path = new_folder(df.sparkSession, "reused")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
