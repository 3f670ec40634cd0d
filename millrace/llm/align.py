"""Alignment of two tokenizers over the same bytes, by elementary intervals.

The ends of both tokenizers' tokens, together and without repeats, cut a text into elementary intervals. Each has one owner
on either side, found by binary search, so each is one overlap of two tokens. An end that both share closes a group; every
token of a group on one side is linked with every one on the other. Of a document only the distinct linked pairs of ids go
on, each with its number of links. Pairs are counted within tasks before they are shuffled, and a document's sums are taken
against the commonest pairs, a bounded number of which is sent to every task; the rarer ones, none of which can then be hot,
meet their counts in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks
from .common import bounded_batches, map_rows, settle, unused

#: Pairs of ids whose counts are sent to every task at most: 32 MB.
SENT_PAIRS = 2_000_000
#: Distinct pairs that a task holds before it passes its counts on, and links that are expanded at a time.
HELD, EXPANDED = 2_000_000, 1 << 20


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, owner in a, owner in b) of each elementary interval of two rising arrays of ends with the same last one."""
    ends = np.union1d(ends_a, ends_b)
    return ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


@dataclass
class Alignment:
    """Ids of both sides, and the group of each token."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    #: Tokens of each group, on either side.
    many_a: np.ndarray
    many_b: np.ndarray

    def links(self) -> int:
        return int((self.many_a * self.many_b).sum())


def align(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> Alignment:
    ends, owner_a, owner_b = overlaps(ends_a, ends_b)
    closes = (ends_a[owner_a] == ends) & (ends_b[owner_b] == ends)
    group = np.cumsum(closes) - closes
    # a token lies in the group of the interval that ends with it
    group_a, group_b = group[np.searchsorted(ends, ends_a)], group[np.searchsorted(ends, ends_b)]
    n = int(closes.sum())
    return Alignment(a, b, group_a, group_b, np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n))


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sum of `times` of each."""
    if not len(codes):
        return codes, times
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(times, first)


def linked_pairs(x: Alignment, base: int, most: int = EXPANDED) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs of ids as a * base + b, in order, and the number of links of each. No more than about `most`
    links are expanded at a time; of a group with more, only its distinct ids."""
    start_a, start_b = np.cumsum(x.many_a) - x.many_a, np.cumsum(x.many_b) - x.many_b
    each = x.many_a * x.many_b
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for g in np.flatnonzero(each > most):
        ids_a, times_a = np.unique(x.a[start_a[g] : start_a[g] + x.many_a[g]], return_counts=True)
        ids_b, times_b = np.unique(x.b[start_b[g] : start_b[g] + x.many_b[g]], return_counts=True)
        step = max(1, most // len(ids_b))
        for i in range(0, len(ids_a), step):
            found.append(((ids_a[i : i + step, None] * base + ids_b).ravel(), (times_a[i : i + step, None] * times_b).ravel()))
    usual = np.flatnonzero(each <= most)
    part = np.cumsum(each[usual]) // most
    for groups in np.split(usual, np.flatnonzero(part[1:] != part[:-1]) + 1) if len(usual) else ():
        n = each[groups]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(x.many_b[groups], n)
        codes = x.a[np.repeat(start_a[groups], n) + place // width] * base + x.b[np.repeat(start_b[groups], n) + place % width]
        found.append(_summed(codes, np.ones(len(codes), np.int64)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return found[0] if len(found) == 1 else _summed(*(np.concatenate(v) for v in zip(*found)))


class Tokenizers:
    """Side a: a byte-level vocabulary of ranks, over space + text. Side b: a sentence-piece model, which adds the space."""

    def __init__(self, ranks: str, model: str):
        by_bytes = read_ranks(ranks)
        self._a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=by_bytes, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self._b.get_piece_size()
        self.base = n
        bytes_a = [b""] * (max(by_bytes.values()) + 1)
        for data, rank in by_bytes.items():
            bytes_a[rank] = data
        bytes_b = [bytes([int(p[3:-1], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self._b.id_to_piece(i)) for i in range(n))]
        self._sides = [self._side(bytes_a), self._side(bytes_b)]

    @staticmethod
    def _side(of: list[bytes]):
        """Bytes of each id, their number, and the id as text with each mark that may follow it."""
        marked = {mark: np.array([f"{i}{mark}" for i in range(len(of))], object) for mark in ",|;"}
        return of, np.array([len(x) for x in of], np.int64), marked

    def encode(self, texts: list[str]) -> list[Alignment | None]:
        """None where a text is empty, or the tokens' bytes aren't those of space + text."""
        some = [t for t in texts if t]
        both = iter(zip(some, map(self._a.encode_ordinary, (" " + t for t in some)), self._b.encode(some, num_threads=1) if some else []))
        return [self._aligned(*next(both)) if t else None for t in texts]

    def _aligned(self, text: str, *ids: list[int]) -> Alignment | None:
        data, ends = (" " + text).encode(), []
        for side, found in zip(self._sides, ids):
            if b"".join(map(side[0].__getitem__, found)) != data:
                return None
            ends.append(np.cumsum(side[1][found]))
        a, b = (np.array(i, np.int64) for i in ids)
        return align(a, ends[0], b, ends[1])

    def spelled(self, x: Alignment) -> str:
        """`a1,a2|b1;a3|b2,b3`: the ids of every group, a's before b's."""
        parts = np.empty(len(x.a) + len(x.b), object)
        before_a, through_b = np.cumsum(x.many_b) - x.many_b, np.cumsum(x.many_a)
        for ids, group, many, shift, last in ((x.a, x.group_a, x.many_a, before_a, "|"), (x.b, x.group_b, x.many_b, through_b, ";")):
            marked = self._sides[0 if last == "|" else 1][2]
            text = marked[","][ids]
            ends = np.cumsum(many) - 1
            text[ends] = marked[last][ids[ends]]
            parts[np.arange(len(ids)) + shift[group]] = text
        return "".join(parts.tolist())[:-1]


@lru_cache(maxsize=2)
def _tokenizers(ranks: str, model: str) -> Tokenizers:
    return Tokenizers(ranks, model)


def count_pairs(stored: DataFrame, codes: str = "codes", held: int = HELD) -> DataFrame:
    """code, n: how many rows hold each code, which no row repeats. Counted within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(of):
            return pa.RecordBatch.from_arrays([pa.array(of[0], pa.int64()), pa.array(of[1], pa.int64())], names=["code", "n"])

        known, waiting, n = (np.empty(0, np.int64), np.empty(0, np.int64)), [], 0
        for batch in batches:
            waiting.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
            n += len(waiting[-1])
            if n >= held:
                new = np.concatenate(waiting)
                known, waiting, n = _summed(np.concatenate([known[0], new]), np.concatenate([known[1], np.ones(len(new), np.int64)])), [], 0
                if len(known[0]) >= held:
                    yield out(known)
                    known = (np.empty(0, np.int64), np.empty(0, np.int64))
        new = np.concatenate([known[0], *waiting])
        yield out(_summed(new, np.concatenate([known[1], np.ones(len(new) - len(known[0]), np.int64)])))

    bounded_batches(stored.sparkSession)
    return stored.select(codes).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def align_documents(docs: DataFrame, ranks: str | None = None, model: str | None = None, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document.

    Null and empty texts, and texts that either side doesn't give back byte for byte (U+2581, which one side reads as a
    space), have no tokens: zeros and ''. Rows are judged each by itself, whatever their doc_id, null ones included, and a
    repeated row is one more document in the counts. An empty table gives none. Other columns are left out. A worker holds
    a batch of texts, or one long text, and the distinct pairs of one document."""
    ranks, model = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), model or public_tokenizers.path("piece_bpe_32k.model")
    base = _tokenizers(ranks, model).base
    spark = docs.sparkSession

    def make():
        tok = _tokenizers(ranks, model)

        def work(b):
            out = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times")}
            for x in tok.encode(b["__text"]):
                codes, times = linked_pairs(x, base) if x else (np.empty(0, np.int64), np.empty(0, np.int64))
                row = (len(x.a), len(x.b), len(x.many_a), x.links(), hashlib.sha256(tok.spelled(x).encode()).hexdigest()) if x else (0, 0, 0, 0, "")
                for name, value in zip(out, (*row, codes, times)):
                    out[name].append(value)
            return out

        return work

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("__row"), F.col("text").alias("__text"))
    schema = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<long>, times array<long>"
    kept = ("doc_id", "__row")
    stored = settle(map_rows(rows, make, schema, keep=kept).drop("__text"), "aligned")
    counts = settle(count_pairs(stored), "pair-counts")
    # one row for each id of the vocabulary at most
    highest = counts.groupBy(F.expr(f"code div {base}").cast("long").alias("a")).agg(F.max("n").alias("most"))
    rest = counts.count() > sent_pairs
    commonest = counts.orderBy(F.desc("n"), "code").limit(sent_pairs) if rest else counts
    known = settle(commonest.withColumn("a", F.expr(f"code div {base}").cast("long")).join(F.broadcast(highest), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pairs-sent")
    at_hand = known.orderBy("code").toArrow()
    sent = spark.sparkContext.broadcast(tuple(at_hand.column(c).to_numpy() for c in ("code", "n", "best")))

    def find(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the codes among those sent, and whether they are there."""
        all_ = sent.value[0]
        place = np.minimum(np.searchsorted(all_, codes), max(0, len(all_) - 1))
        return place, all_[place] == codes if len(all_) else np.zeros(len(codes), bool)

    def flat(batch: pa.RecordBatch):
        codes, times = (batch.column(batch.schema.names.index(c)) for c in ("codes", "times"))
        return codes.value_lengths().to_numpy(zero_copy_only=False), codes.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, codes, times = flat(batch)
            place, there = find(codes)
            last = np.cumsum(lengths)
            sums = []
            for v in (sent.value[2].astype(np.int64), sent.value[1]) if len(codes) else ():
                run = np.concatenate([[0], np.cumsum(np.where(there, v[place] * times, 0) if len(v) else np.zeros(len(codes), np.int64))])
                sums.append(pa.array(run[last] - run[last - lengths], pa.int64()))
            sums = sums or [pa.array(np.zeros(batch.num_rows, np.int64))] * 2
            names = [n for n in batch.schema.names if n not in ("codes", "times")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in names), *sums], names=[*names, "n_best", "count_sum"])

    plain = stored.drop("codes", "times")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    result = stored.mapInArrow(add, f"{fields}, n_best long, count_sum long")
    if rest:

        def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths, codes, times = flat(batch)
                rows = np.repeat(batch.column(batch.schema.names.index("__row")).to_numpy(), lengths)
                left = ~find(codes)[1]
                yield pa.RecordBatch.from_arrays([pa.array(v[left]) for v in (rows, codes, times)], names=["__row", "code", "times"])

        rare = counts.join(known, "code", "left_anti").withColumn("a", F.expr(f"code div {base}").cast("long")).join(F.broadcast(highest), "a")
        pairs = stored.select("__row", "codes", "times").mapInArrow(others, "__row long, code long, times long").join(rare, "code")
        sums = pairs.groupBy("__row").agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
        result = result.join(sums, "__row", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return result.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align_tokens(docs: DataFrame, ranks: str | None = None, model: str | None = None, text_col: str = "text") -> DataFrame:
    """docs with `overlaps`, array<struct<a, b, start, end, group>>: every elementary interval of space + text in bytes, with
    the places of its two tokens and its group; empty where align_documents() has zeros."""
    ranks, model = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), model or public_tokenizers.path("piece_bpe_32k.model")
    out, text = unused("overlaps", docs.columns), unused("__text", docs.columns)

    def make():
        tok = _tokenizers(ranks, model)

        def work(b):
            rows = []
            for x in tok.encode(b[text]):
                if x is None:
                    rows.append([])
                    continue
                lengths = [tok._sides[0][1][x.a], tok._sides[1][1][x.b]]
                ends, a, b_ = overlaps(*(np.cumsum(n) for n in lengths))
                starts = np.concatenate([[0], ends[:-1]])
                rows.append([dict(zip(("a", "b", "start", "end", "group"), r)) for r in zip(*(v.tolist() for v in (a, b_, starts, ends, x.group_a[a])))])
            return {out: rows}

        return work

    kept = tuple(docs.columns)
    made = map_rows(docs.withColumn(text, F.col(f"`{text_col}`")), make, f"`{out}` array<struct<a:long,b:long,start:long,end:long,group:long>>", keep=kept)
    return made.select(*(f"`{c}`" for c in kept), out)
