"""Session defaults for the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(app: str = "millrace", **conf: str) -> SparkSession:
    """A session with DEFAULTS and what is given; an existing one is reused."""
    builder = SparkSession.builder.appName(app)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """df, straight from files, in at least as many partitions as the cluster has cores: a file of one row group is one split,
    and what follows would else run in one task. Rows move only where there are fewer splits, so tables of any size don't."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
