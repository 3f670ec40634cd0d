"""Reproducible shuffle into shards: a Feistel permutation, with cycle walking, of global row numbers.

Row r of n rows goes to place p = permutation(r); its shard is p mod shards and its slot p div shards, so shard counts
differ by one at most (law `rows`), and both can be computed, or turned back into the row, without a table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, number_rows

ROUNDS = 6


def _mix(half: np.ndarray, key: int) -> np.ndarray:
    """A round function: multiply and shift until every bit depends on every other."""
    x = half.astype(np.uint64) + np.uint64(key)
    for factor, shift in ((0xFF51AFD7ED558CCD, 33), (0xC4CEB9FE1A85EC53, 29)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, ROUNDS)]


def permute(numbers: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """The permutation of 0..n-1, or its inverse. Values outside are walked on along their cycle until they fall inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, keys = np.uint64(2**half - 1), _keys(seed)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> np.uint64(half), out[todo] & mask
            for key in reversed(keys) if back else keys:
                if back:
                    left, right = right ^ (_mix(left, key) & mask), left
                else:
                    left, right = right, left ^ (_mix(right, key) & mask)
            out[todo] = (left << np.uint64(half)) | right
            todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def locate(rows: np.ndarray, n: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of global row numbers."""
    place = permute(rows, n, seed)
    return place % shards, place // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int) -> np.ndarray:
    """Global row number of what lies in a slot of a shard."""
    return permute(slot * shards + shard, n, seed, back=True)


def shard_rows(df: DataFrame, key: str, shards: int, seed: int = 20, order: list[str] | None = None) -> DataFrame:
    """df with row, shard and slot. Rows are numbered by a hash of `key`, ties by `order`; rows equal in all of these may
    change places with each other. An empty table stays empty, null keys are numbered like others."""
    n = df.count()
    numbered = number_rows(df, F.struct(key, *(order or [])), [key, *(order or [])], "row", rows=n)

    def make():
        def work(b):
            shard, slot = locate(np.array(b["__row"], "i8"), n, shards, seed)
            return {"shard": shard, "slot": slot}

        return work

    return map_rows(numbered.withColumn("__row", F.col("row")), make, "shard int, slot long", keep=tuple(numbered.columns))


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 20) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document; a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard_rows(rows, "doc_id", shards, seed, ["text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
