"""Quality scores: ranges, bins, and the release order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import wds_bin


def with_score(df: DataFrame, scores: str = "doc_scores", name: str = "wds") -> DataFrame:
    """Rows that have a first score, as a column."""
    return df.withColumn(name, F.get(F.col(scores), F.lit(0))).where(F.col(name).isNotNull())


def score_range(df: DataFrame, least: float | None = None, below: float | None = None, name: str = "wds") -> DataFrame:
    """least <= score < below; either may be open. Reaches the scan of a Parquet table as a pushed filter."""
    if least is not None:
        df = df.where(F.col(name) >= least)
    return df if below is None else df.where(F.col(name) < below)


def single_bin(df: DataFrame, bin_: int, name: str = "wds", scale: int = 10) -> DataFrame:
    """Rows of one bin; a null or unreadable score is in bin -1."""
    return df.where(F.coalesce(wds_bin(F.col(name).cast("double"), scale), F.lit(-1)) == bin_)


def release_order(df: DataFrame, tie: str = "id", name: str = "wds", partitions: int | None = None) -> DataFrame:
    """Globally sorted, best first, ties by `tie` descending: range partitions, each sorted (spilling) by itself."""
    keys = [F.col(name).desc(), F.col(tie).desc()]
    dealt = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def bin_counts(df: DataFrame, name: str = "wds", scale: int = 10) -> DataFrame:
    return df.groupBy(wds_bin(F.col(name), scale).alias("wds_bin")).agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters"))
