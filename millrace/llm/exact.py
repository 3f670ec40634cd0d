"""Exact dedup with an extendible-hash index on shared files, in DataFrame operations only.

The index has a directory of 2**depth entries, by the leading bits of a text's hash, that point to buckets. It starts with
one bucket; an overfull one splits, and where it already has the directory's depth, the directory doubles first. Entries
are different texts, so a text with many copies fills no bucket. Each bucket is a key range owned by one task, which
orders the entries of one hash into a chain and tells them apart by their bytes.

Only texts whose hash comes more than once have to move; they are summed up before they do. A row finds its entry from
its hash alone: by the directory its bucket, and there the first link of its chain; only rows of a hash that several texts
share look up which link is theirs.
"""

from __future__ import annotations

import json
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hot_keys, salted_join, settle

#: Least and greatest depth that a directory may reach, by the table's size: it is sent to every task, 2 MB at most; entries
#: that a bucket holds before it splits.
SHALLOW, DEEP, CAPACITY = 4, 18, 16
#: Hashes that may be sent to every task, so that other texts don't move; beyond, both sides are shuffled.
SENT_HASHES = 2_000_000


def normalised(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null is empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def depth_for(entries: int, capacity: int) -> int:
    """Bits of a directory in which buckets of `capacity` have room for all entries, and some to spare where they lie uneven."""
    return max(SHALLOW, min(DEEP, (max(1, entries) // max(1, capacity)).bit_length() + 3))


def split(counts: dict[int, int], capacity: int, bits: int) -> list[tuple[int, int]]:
    """(first prefix, own depth) of each bucket, in order, for counts of entries by prefix of `bits` bits."""
    sums = [0]
    for prefix in range(2**bits):
        sums.append(sums[-1] + counts.get(prefix, 0))
    done, full = [], [(0, 0)]
    while full:
        prefix, own = full.pop()
        width = bits - own
        if sums[(prefix + 1) << width] - sums[prefix << width] <= capacity or own == bits:
            done.append((prefix << width, own))
        else:
            full += [(2 * prefix, own + 1), (2 * prefix + 1, own + 1)]
    return sorted(done)


def directory(buckets: list[tuple[int, int]], bits: int) -> tuple[int, list[int]]:
    """(depth, bucket number of each entry): the directory is as deep as its deepest bucket, and a bucket of less depth
    has several entries."""
    depth = max(own for _, own in buckets)
    return depth, [number for number, (_, own) in enumerate(buckets) for _ in range(2 ** (depth - own))]


class Index:
    """The directory, and the stored entries: bucket, hash, chain, digest, keep_id, group_size."""

    def __init__(self, keyed: DataFrame, keys: DataFrame, capacity: int = CAPACITY):
        """keyed: id, hash, text (normalised); keys: id, hash, digest of the same rows, stored."""
        self.spark = keyed.sparkSession
        hashes = settle(keys.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep_id"), F.min("digest").alias("digest")), "exact-hashes")
        bits = depth_for(hashes.count(), capacity)
        prefix = F.shiftrightunsigned("hash", 64 - bits).cast("int").alias("prefix")
        counts = {r["prefix"]: r["n"] for r in hashes.groupBy(prefix).agg(F.count(F.lit(1)).alias("n")).collect()}
        self.depth, self.buckets = directory(split(counts, capacity, bits), bits)
        # a hash that comes once has one text
        single = hashes.where("n = 1").select("hash", F.lit(1).alias("chain"), "digest", "keep_id", F.col("n").alias("group_size"))
        met = hashes.where("n > 1").select("hash")
        if met.count() <= SENT_HASHES:
            met = F.broadcast(met)
        # equal rows are summed up where they lie, so that a hot text is no one's work; what is left goes to the owners
        texts = keyed.join(met, "hash", "left_semi").groupBy("hash", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        owned = self.located(texts).repartitionByRange("bucket")
        # the owner of a range of buckets puts the texts of one hash, compared by their bytes, into a chain
        link = F.dense_rank().over(Window.partitionBy("bucket", "hash").orderBy("text"))
        chained = owned.withColumn("chain", link).select("bucket", "hash", "chain", F.sha2("text", 256).alias("digest"), "keep_id", "group_size")
        both = self.located(single).select(chained.columns).union(chained)
        self.entries = settle(both.repartitionByRange("bucket").sortWithinPartitions("bucket", "hash", "chain"), "exact-index")
        self.longer = settle(self.entries.where("chain > 1").select("hash", "digest", "chain"), "exact-chains")

    def located(self, df: DataFrame) -> DataFrame:
        """df with the bucket that the directory gives for its hash."""
        entries = self.spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(self.buckets)), "array<int>")).alias("entry", "bucket"))
        entry = F.shiftrightunsigned("hash", 64 - self.depth).cast("int") if self.depth else F.lit(0)
        return df.withColumn("entry", entry).join(F.broadcast(entries), "entry").drop("entry")

    def look_up(self, keys: DataFrame, rows: int) -> DataFrame:
        """keys (hash, digest and others) with chain, keep_id and group_size: by directory, bucket and chain."""
        found = ["bucket", "hash", "chain"]
        links = self.longer
        if not links.isEmpty():
            # texts beside another of the same 64 bits: few at any size, and the engine picks the join
            keys = keys.join(links, ["hash", "digest"], "left").withColumn("chain", F.coalesce("chain", F.lit(1)))
        else:
            keys = keys.withColumn("chain", F.lit(1))
        hot = hot_keys(self.entries.select(*found, F.col("group_size").alias("n")), found, rows)
        return salted_join(self.located(keys), self.entries.select(*found, "keep_id", "group_size"), found, ["id"], hot, "inner")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each row of df: id, keep_id (largest id of its group), group_size, kept, text_sha256.

    Ids may be of any type that has an order. Null and empty texts are one group. Rows that repeat an id and text are each
    returned and counted; rows whose whole group has null ids have keep_id null and are kept. Extra columns are not looked
    at; an empty table stays empty."""
    rows = df.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    keyed = rows.withColumn("hash", F.xxhash64("text"))
    keys = settle(keyed.select("id", "hash", F.sha2("text", 256).alias("digest")), "exact-keys")
    joined = Index(keyed, keys, capacity).look_up(keys, keys.count())
    kept = F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull())
    return joined.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))
