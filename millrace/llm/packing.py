"""Best-fit packing of token pieces by large-item matching.

Every length is at most the capacity, so a histogram of lengths (at most `capacity` rows) holds all that a packing
depends on. It is packed on the driver by counts, never piece by piece: pieces above a third of the capacity go at most
two to a sequence, each with the largest partner that fits; the rest go, longest first, to the smallest gap that holds
them. The plan is a table of runs, bounded by the capacity; each piece finds its place in it from its length and its
number among the pieces of its length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from functools import lru_cache

import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks
from .common import map_rows, number_rows, settle

CAPACITY = 1024
#: Id that ends each document, and the special token of the vocabulary, which the library finds in texts too.
END, SPECIAL = 2, (("<|endoftext|>", 50256),)


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(sequences, [(length, copies), ...]) for each kind of sequence."""
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []

    def put(number: int, items: list[tuple[int, int]]) -> None:
        if number:
            gap = capacity - sum(n * c for n, c in items)
            if gap not in open_:
                open_[gap] = []
                insort(gaps, gap)
            open_[gap].append((number, items))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        k = bisect_right(large, capacity - n) - 1
        if k >= 0 and large[k] == n and left[n] < 2:
            k -= 1
        if k < 0:
            put(left[n], [(n, 1)])
            left[n] = 0
        elif large[k] == n:
            put(left[n] // 2, [(n, 2)])
            left[n] %= 2
        else:
            pairs, partner = min(left[n], left[large[k]]), large[k]
            put(pairs, [(n, 1), (partner, 1)])
            left[n] -= pairs
            left[partner] -= pairs
        large = [n for n in large if left[n]]
    for n in sorted((n for n in left if left[n]), reverse=True):
        while left[n]:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                put(-(-left[n] // (capacity // n)), [])
                continue
            gap = gaps[at]
            number, items = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(at)
            each = gap // n
            full = min(number, left[n] // each)
            rest = left[n] - full * each if full < number else 0
            put(full, [*items, (n, each)])
            if rest:
                put(1, [*items, (n, rest)])
            put(number - full - bool(rest), items)
            left[n] -= full * each + rest
    return [kind for gap in gaps for kind in open_[gap]]


def runs_of(plan: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, copies, sequence, offset): where the pieces of a length numbered first..last lie."""
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for number, items in plan:
        offset = 0
        for n, copies in items:
            first = used.get(n, 0)
            used[n] = first + number * copies
            runs.append((n, first, used[n] - 1, copies, sequence, offset))
            offset += n * copies
        sequence += number
    return runs


@lru_cache(2)
def tokenizer(path: str) -> tiktoken.Encoding:
    """One for each Python worker. The rank file holds the vocabulary of byte_bpe_50k.json, and this library encodes by it
    several times as fast as the one that reads that file, with the same ids (tests compare them)."""
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens=dict(SPECIAL))


def token_pieces(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32-bit, as binary). A null or empty text is its end id alone.
    Only documents longer than the capacity are cut; what is over goes to the first piece."""

    def make():
        encode = tokenizer(path).encode_to_numpy

        def work(b):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids")}
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = encode(text or "", allowed_special="all").astype("<u4").tobytes() + END.to_bytes(4, "little")
                n = len(ids) // 4
                starts = [0] if n <= capacity else list(range(n % capacity, n, capacity))
                starts = starts if starts[0] == 0 else [0, *starts]
                for k, (start, stop) in enumerate(zip(starts, [*starts[1:], n])):
                    for name, value in zip(out, (doc, k, start, stop - start, ids[4 * start : 4 * stop])):
                        out[name].append(value)
            return out

        return work

    return map_rows(df.select("doc_id", "text"), make, "doc_id long, piece int, start long, length long, ids binary")


def pack(pieces: DataFrame, capacity: int = CAPACITY, keys: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """pieces with sequence_id and offset. `pieces` has a length and the key columns and is read three times: pass a stored
    table. An empty table stays empty; rows that repeat their keys each get a place of their own."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = runs_of(plan_sequences(counts, capacity))
    # bounded by the capacity: each length opens or splits at most three kinds of sequence
    plan = pieces.sparkSession.createDataFrame(runs or [(0, 0, -1, 1, 0, 0)], "length long, __first long, __last long, __copies long, __sequence long, __offset long")
    numbered = number_rows(pieces, F.struct(*keys), list(keys), "__n", within=["length"], rows=sum(counts.values()))
    placed = numbered.join(F.broadcast(plan), "length").where("__n between __first and __last")
    at = F.col("__n") - F.col("__first")
    return placed.select(
        *(F.col(c) for c in pieces.columns),
        (F.col("__sequence") + F.floor(at / F.col("__copies"))).alias("sequence_id"),
        (F.col("__offset") + at % F.col("__copies") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A null or empty text is its end id alone; rows that repeat an id each have pieces and places of their own; pieces of
    one length are interchangeable. An empty table stays empty; extra columns are not looked at."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    made = token_pieces(docs, path, capacity)
    crc = made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(settle(crc, "pieces"), capacity)

