"""Statistics that a new crawl costs only its own reading: sums by file, stored as they come, and added up when asked for.

The file source gives every file once, whole, in one micro-batch. What a batch's files sum up to is written to a folder of the
batch, which a batch that is tried again writes anew; of a file that several batches have (it was replaced and streamed
under the same name), the last one counts. So a store can be added to, cut off and gone on with, and always gives what one
pass over all its files gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Column that tells a partial sum's file.
FILE = "file"


def with_file(stream: DataFrame) -> DataFrame:
    """A stream from files with their names."""
    return stream.withColumn(FILE, F.col("_metadata.file_name"))


def update(stream: DataFrame, summarise: Callable[[DataFrame], DataFrame], store: str, checkpoint: str) -> StreamingQuery:
    """Sums up what has come since the last run, then stops. summarise: rows with FILE -> sums, a row (or some) for each file
    and key; what it sums must not depend on other files."""

    def add(rows: DataFrame, batch: int) -> None:
        summarise(rows).write.mode("overwrite").parquet(f"{store.rstrip('/')}/batch={batch}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def partials(spark: SparkSession, store: str) -> DataFrame:
    """The sums that count: of each file those of the last batch that had it."""
    rows = spark.read.option("basePath", store).parquet(f"{store.rstrip('/')}/batch=*")
    last = rows.groupBy(FILE).agg(F.max("batch").alias("batch"))
    # as many rows as files; the engine picks broadcast or sort-merge by its size
    return rows.join(last, [FILE, "batch"], "left_semi").drop("batch")


def added_up(sums: DataFrame, keys: list[str]) -> DataFrame:
    """All whole numbers of partial sums, added up by key."""
    numbers = [c for c, kind in sums.dtypes if kind in ("bigint", "int") and c not in (*keys, FILE)]
    return sums.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(*(F.sum(F.col(f"`{c}`")).alias(c) for c in numbers))


def compact(spark: SparkSession, store: str, target: str) -> None:
    """The sums that count, as one batch of a new store, so that many runs don't leave many small files. The new store takes
    the old one's place with its checkpoint: later batches have larger numbers."""
    partials(spark, store).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch=-1")
