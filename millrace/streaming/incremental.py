"""Incremental processing: the file source with a checkpoint takes the place of lists of finished inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_parquet(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_lines(spark: SparkSession, path: str, pattern: str = "*.zst", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).text(path)


def run_once(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, by: tuple[str, ...] = ()) -> StreamingQuery:
    """Process what has come since the last run, exactly once, and stop. The checkpoint remembers what is done."""
    writer = transform(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(*by) if by else writer).start()
