"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Least time between two collections of garbage, for runs over small tables with disk to spare.
COLLECT_SECONDS = 0.0
_collected = [0.0]


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; a temporary one where none is set, in local runs only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.getConf().get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = "file://" + os.path.join(tempfile.gettempdir(), "millrace-checkpoints")
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again: computed once, lineage cut, safe when an executor goes."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if time.monotonic() - _collected[0] >= COLLECT_SECONDS:
        gc.collect()  # what led to df is no longer needed: let Spark see that, and delete its shuffle files now
        spark._jvm.System.gc()
        _collected[0] = time.monotonic()
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table that settle() has written in this application; results that read them must have been used."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(_folder(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def text_writer(spark: SparkSession, path: str) -> Iterator[Callable[[str], None]]:
    """A function that adds text to a new file, through the file system that Spark itself uses."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        yield lambda text: out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file."""
    with text_writer(spark, path) as write:
        write(text)
