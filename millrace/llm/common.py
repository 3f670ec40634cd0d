"""What the operators of this subpackage share: tables, shared storage, Arrow maps, row numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from millrace.session import spread
from millrace.sources.shared import settle

#: Most rows that one numbering bucket is meant to hold.
BUCKET_ROWS = 20_000
#: Keys that may be called hot at most, which bounds what is broadcast, and rows that no key needs help below.
HOT_GROUPS, HOT_ROWS = 10_000, 200
#: Bounds of the number of buckets; their count, not the rows', bounds what is broadcast.
LEAST_BUCKETS, MOST_BUCKETS = 256, 65_536
#: Rows and bytes of a batch that goes to Python.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2048, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def table(spark: SparkSession, sf_dir: str, name: str, deal: bool = True) -> DataFrame:
    """A table's rows; deal: in no fewer partitions than the cluster has cores, so that Python work uses all of them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if deal else df


def bounded_batches(spark: SparkSession) -> None:
    """Batches between Spark and Python of few rows and bytes: what a worker holds doesn't depend on how long texts are."""
    for name, most in BATCH.items():
        now = spark.conf.get(name, None)
        if now is None or not now.isdigit() or int(now) > most:
            spark.conf.set(name, str(most))


def unused(name: str, columns: list[str]) -> str:
    """`name`, with as many underscores before it as make it differ from all the columns."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """mapInArrow by columns: make() runs once per task and returns a function from a batch's lists to the new lists.

    The `keep` columns, whatever their types, go before the new ones as they are; the function doesn't see them, and must
    give as many rows as it gets."""
    bounded_batches(df.sparkSession)
    made = T._parse_datatype_string(schema)
    full = T.StructType([*(df.schema[c] for c in keep), *made.fields])
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                work = work or make()
                names = part.schema.names
                out = work({n: part.column(i).to_pylist() for i, n in enumerate(names) if n not in keep})
                kept = [part.column(names.index(c)).cast(arrow.field(c).type) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(out[f.name], f.type) for f in arrow if f.name not in keep)], schema=arrow)

    return df.mapInArrow(run, full)


def with_rows(docs: DataFrame, name: str = "__row") -> DataFrame:
    """docs with a number for each row, stored, so that a row can be told from others with the same id and text."""
    return settle(docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))


def number_rows(df: DataFrame, key: Column, order: list[str], out: str, within: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """Add `out`: numbers from 0 without gaps, over all rows or apart for each value of `within`.

    Rows are dealt by a hash of `key` into buckets; a row's number is its place in its bucket plus the rows of earlier
    buckets. The numbers depend on the data and the bucket count alone, not on how it is partitioned, and a hot value
    of `within` is spread over all buckets. The table of bucket sizes has at most buckets x values of `within` rows;
    it is broadcast only without `within`, where the bucket count bounds it.
    """
    within = within or []
    n = buckets_for(df.count() if rows is None else rows)
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    sizes = dealt.groupBy(*within, "__bucket").agg(F.count(F.lit(1)).alias("__size"))
    if within:
        before = Window.partitionBy(*within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size")
    else:
        rows_of, done = sorted((r["__bucket"], r["__size"]) for r in sizes.collect()), 0
        table_rows = []
        for bucket, size in rows_of:
            table_rows.append((bucket, done))
            done += size
        offsets = F.broadcast(df.sparkSession.createDataFrame(table_rows, "__bucket int, __before long"))
    place = Window.partitionBy(*within, "__bucket").orderBy(*order)
    placed = dealt.withColumn("__place", F.row_number().over(place) - 1)
    return placed.join(offsets, [*within, "__bucket"]).withColumn(out, F.col("__place") + F.col("__before")).drop("__bucket", "__place", "__before")


def hot_keys(sizes: DataFrame, keys: list[str], total: int) -> DataFrame | None:
    """Keys (with `parts`) of more than total / HOT_GROUPS of `total` rows, stored; None without any. sizes: keys and n, the
    rows of each. They are HOT_GROUPS at most, or total / HOT_ROWS in small tables."""
    most = max(HOT_ROWS, -(-total // HOT_GROUPS))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    hot = sizes.where(known & (F.col("n") > most)).select(*keys, F.ceil(F.col("n") / most).alias("__parts"))
    return None if hot.isEmpty() else settle(hot, "hot-keys")


def counted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def salted_join(rows: DataFrame, groups: DataFrame, keys: list[str], by: list[str], hot: DataFrame | None, how: str = "left") -> DataFrame:
    """rows joined (inner or left) with groups, one row for each value of `keys`, so that no key is one task's work.

    hot: of hot_keys(); it is broadcast. Rows of a hot key are dealt by a hash of `by` into its parts, and its group is
    there once for each part. Rows of null keys meet no group, and are dealt out too."""
    known, mixed, part = F.lit(True), F.xxhash64(*by), F.lit(0).cast("long")
    for key in keys:
        known = known & F.col(key).isNotNull()
    if hot is not None:
        rows = rows.join(F.broadcast(hot), keys, "left")
        groups = groups.join(F.broadcast(hot), keys, "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__parts", F.lit(1).cast("long")) - 1))).drop("__parts")
        part = F.coalesce(F.pmod(mixed, F.col("__parts")), part)
    else:
        groups = groups.withColumn("__part", part)
    rows = rows.withColumn("__part", F.when(known, part).otherwise(-1 - F.pmod(mixed, F.lit(1 << 20)))).drop("__parts")
    return rows.join(groups, [*keys, "__part"], how).drop("__part")


#: Ids that may be sent to every task; more are joined by shuffle.
SENT_IDS = 1_000_000


def without_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of df whose key is not in ids (one column); null keys stay. Few ids, by count, are broadcast, so that the rows
    of df do not move; beyond SENT_IDS both are shuffled."""
    ids = settle(ids.where(F.col(key).isNotNull()).distinct(), "dropped-ids")
    return df.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, key, "left_anti").select(*df.columns)
