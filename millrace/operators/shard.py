"""Size-bounded shards, batches and tasks.

Greedy sharding is a running sum that starts anew at each roll, so that what a shard has over is forgotten: no window sum
expresses it. Rows are sorted by group and order in parallel and numbered; a block is at most 2^BLOCK rows of that order. What
a block does depends on one thing of all before it, the bytes in the open shard: that decides at which row the block's first
shard begins, found by binary search over prefix sums, and all else follows. So a block is a step function from bytes held to
(shards begun, bytes held), and such functions can be composed: those of a group that spans blocks are composed FAN at a time,
level by level, and then evaluated downward, so that a group of any size takes a number of rounds that is a logarithm of its
blocks. Then every block is folded on its own, over sizes alone, and gives the rows at which shards begin, in which rows look
themselves up by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.operators.stats import listed
from millrace.sources.shared import settle

#: Rows that are folded by one task without composing; bits of the rows of a block; functions composed at a time; shards whose
#: first rows may be sent to every task, 64 MB, beyond which rows are joined with their shard.
FOLD_ROWS, BLOCK, FAN, SENT_SHARDS = 500_000, 20, 16, 4_000_000


def _next(sums: np.ndarray, size: int, before: bool) -> np.ndarray:
    """For each row, as the first of a shard, the first row of the next one; the number of rows if there is none."""
    rows = np.arange(len(sums) - 1)
    if before:
        # a first row that is too long still has a shard to itself
        return np.maximum(np.searchsorted(sums[1:], sums[:-1] + size, "right"), rows + 1)
    return np.minimum(np.maximum(np.searchsorted(sums, sums[:-1] + size, "left"), rows + 1), len(rows))


def _first(sums: np.ndarray, size: int, held: int, before: bool) -> int:
    """The first row that begins a shard, after rows of `held` bytes in the open one."""
    return int(np.searchsorted(sums[1:], size - held, "right") if before else np.searchsorted(sums[:-1], size - held, "left"))


def roll(sizes: np.ndarray, size: int, state: tuple[int, int, bool], before: bool) -> tuple[np.ndarray, tuple[int, int, bool]]:
    """Shard numbers of rows in order, and the state (shard, bytes in it, whether it has rows) after them.

    before=False: a shard is closed once it has reached `size` (seen at the next row); True: before it would pass it. A row
    without bytes is a row: what comes after it may have to begin a new shard."""
    shard, held, some = state
    if not len(sizes):
        return np.empty(0, np.int64), state
    sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    begins = np.zeros(len(sizes), np.int64)
    after = _next(sums, size, before)
    # an open shard without rows goes on as one that begins with the first row
    at = _first(sums, size, held, before) if some else int(after[0])
    last = None
    while at < len(sizes):
        begins[at], last = 1, at
        at = int(after[at])
    shards = shard + np.cumsum(begins)
    return shards, (int(shards[-1]), int(sums[-1] - sums[last]) if last is not None else held + int(sums[-1]), True)


class Step:
    """What a run of rows makes of the bytes held in an open shard that has rows: (shards begun, bytes held).

    least[i], falling: from so many bytes on, begun[i] and held[i] hold; below all, none begins, and `total` is added."""

    def __init__(self, least: np.ndarray, begun: np.ndarray, held: np.ndarray, total: int):
        # of no use: what only bytes below zero would reach, and what does the same as the one that holds from fewer bytes on
        stop = int(np.searchsorted(-least, 0, "left")) + 1
        least, begun, held = least[:stop], begun[:stop], held[:stop]
        own = np.ones(len(least), bool)
        own[:-1] = (begun[1:] != begun[:-1]) | (held[1:] != held[:-1])
        self.least, self.begun, self.held, self.total = least[own], begun[own], held[own], int(total)

    @classmethod
    def of(cls, sizes: np.ndarray, size: int, before: bool) -> Step:
        sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        n = len(sizes)
        pointer, begun, last = _next(sums, size, before), np.ones(n, np.int64), np.arange(n)
        while len(open_ := np.flatnonzero(pointer < n)):
            to = pointer[open_]
            begun[open_], last[open_], pointer[open_] = begun[open_] + begun[to], last[to], pointer[to]
        least = size - sums[1:] + 1 if before else size - sums[:-1]
        # of rows that begin a shard from the same bytes on, the first does
        first = np.concatenate([[True], least[1:] != least[:-1]])
        return cls(least[first], begun[first], (sums[-1] - sums[last])[first], sums[-1])

    def __call__(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.least):
            return np.zeros(len(held), np.int64), held + self.total
        # the first whose `least` is reached; `least` falls
        i = np.searchsorted(-self.least, -held, "left")
        there, j = i < len(self.least), np.minimum(i, len(self.least) - 1)
        return np.where(there, self.begun[j], 0), np.where(there, self.held[j], held + self.total)

    def then(self, after: Step) -> Step:
        begun, held = after(self.held)
        least = after.least - self.total
        late = least < (self.least[-1] if len(self.least) else np.iinfo(np.int64).max)
        return Step(np.concatenate([self.least, least[late]]), np.concatenate([self.begun + begun, after.begun[late]]), np.concatenate([held, after.held[late]]), self.total + after.total)


_STEP = "least array<long>, begun array<long>, held array<long>, total long"


def _steps(rows: pd.DataFrame) -> list[Step]:
    return [Step(*(np.asarray(v, np.int64) for v in r[:3]), r[3]) for r in zip(rows["least"], rows["begun"], rows["held"], rows["total"])]


def _states(rows: DataFrame, size: int, before: bool, settled) -> DataFrame | None:
    """piece, __shard, __held at the beginning of every piece but the first of a group that spans blocks; None without such.

    rows: __group (a text), __block, __at, __size. A piece is what a block has of a group."""
    spans = settled(rows.groupBy("__group").agg(F.min("__block").alias("__from"), F.max("__block").alias("__to")).where("__from < __to"), "shard-spans")
    if spans.isEmpty():
        return None

    def made(piece: pd.DataFrame) -> pd.DataFrame:
        piece = piece.sort_values("__at")
        sizes = piece["__size"].to_numpy(np.int64)
        if piece["__block"].iloc[0] == piece["__from"].iloc[0]:
            # what comes before the group's first row is known: one step, whatever is held
            _, (shard, held, _) = roll(sizes, size, (1, 0, False), before)
            step = Step(np.array([0]), np.array([shard - 1]), np.array([held]), 0)
        else:
            step = Step.of(sizes, size, before)
        return pd.DataFrame({"__group": piece["__group"].iloc[:1], "__block": piece["__block"].iloc[:1], "least": [step.least], "begun": [step.begun], "held": [step.held], "total": [step.total]})

    pieces = rows.join(spans, "__group").groupBy("__group", "__block").applyInPandas(made, f"__group string, __block long, {_STEP}")
    place = F.row_number().over(Window.partitionBy("__group").orderBy("__block")) - 1
    levels = [settled(pieces.withColumn("__n", place.cast("long")), "shard-steps")]
    most = levels[0].agg(F.max("__n")).first()[0] + 1

    def composed(key: tuple, several: pd.DataFrame) -> pd.DataFrame:
        steps = _steps(several.sort_values("__n"))
        step = steps[0]
        for after in steps[1:]:
            step = step.then(after)
        return pd.DataFrame({"__group": [key[0]], "__n": [key[1]], "least": [step.least], "begun": [step.begun], "held": [step.held], "total": [step.total]})

    above = F.floor(F.col("__n") / FAN).cast("long").alias("__n")
    while most > FAN:
        levels.append(settled(levels[-1].groupBy("__group", above).applyInPandas(composed, f"__group string, __n long, {_STEP}"), "shard-steps"))
        most = -(-most // FAN)

    def opened(key: tuple, several: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        several = several.sort_values("__n")
        shard, held = (int(above["__shard"].iloc[0]), int(above["__held"].iloc[0])) if len(above) else (1, 0)
        states = []
        for step in _steps(several):
            states.append((shard, held))
            begun, now = step(np.array([held], np.int64))
            shard, held = shard + int(begun[0]), int(now[0])
        return pd.DataFrame({"__group": several["__group"], "__n": several["__n"], "__shard": [x for x, _ in states], "__held": [x for _, x in states]})

    known = rows.sparkSession.createDataFrame([], "__group string, __n long, __shard long, __held long")
    for level in reversed(levels):
        known = level.groupBy("__group", above).cogroup(known.groupBy("__group", "__n")).applyInPandas(opened, "__group string, __n long, __shard long, __held long")
    return settled(levels[0].where("__n > 0").join(known, ["__group", "__n"]).select("__group", "__block", "__shard", "__held"), "shard-states")


def _fold(rows: DataFrame, size: int, before: bool, whole: bool, every: bool) -> DataFrame:
    """__at, __shard of each row that begins a shard or what a block has of a group; every: of each row.

    rows: __group, __block, __at, __size, and __shard, __held where a piece goes on with its group's shard."""
    dealt = (rows.coalesce(1) if whole else rows.repartition("__block")).sortWithinPartitions("__at")
    names = ["__at", "__shard"]

    def folded(parts: list[tuple[np.ndarray, np.ndarray]], state: tuple[int, int, bool]) -> tuple[np.ndarray, np.ndarray, tuple[int, int, bool]]:
        at, sizes = (np.concatenate(x) for x in zip(*parts))
        shards, after = roll(sizes, size, state, before)
        new = np.concatenate([[True], shards[1:] != shards[:-1]]) | every
        return at[new], shards[new], after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, state, done = None, [], (1, 0, False), []

        def close() -> None:
            if parts:
                done.append(folded(parts, state)[:2])

        for batch in batches:
            group, block = (batch.column(i) for i in range(2))
            at, sizes, shard, held = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6))
            # equal groups lie together: where they, or blocks, change
            codes = group.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            blocks = np.zeros(len(at), np.int64) if whole else block.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(at)]):
                if start < stop:
                    now = (group[int(start)].as_py(), int(blocks[start]))
                    if now != key:
                        close()
                        key, parts = now, []
                        state = (1, 0, False) if np.isnan(shard[start]) else (int(shard[start]), int(held[start]), True)
                    parts.append((at[start:stop], sizes[start:stop]))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*done)], names=names)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*done)], names=names)

    return dealt.mapInArrow(run, "__at long, __shard long")


def greedy_shards(
    df: DataFrame, group: list[str], order: list[tuple[str, bool]], keep: list[str], size_col: str, size: int, name: str = "shard", before: bool = False, fold_rows: int = FOLD_ROWS, block: int = BLOCK, sent: int = SENT_SHARDS
) -> DataFrame:
    """group and keep columns with the shard number (from 1) of each row, in order of (column, ascending) in each group.

    before=False: a shard is closed once it has reached `size`, True: before it would pass it. Null sizes are 0. Rows that
    tie in the order come in any order. The result is stored order, so `keep` may be all columns: they move once."""
    if size < 1:
        raise ValueError("a shard needs room")
    spark = df.sparkSession
    columns = [*dict.fromkeys([*group, *keep, *(c for c, _ in order)])]
    keys = [*(F.col(c).asc() for c in group), *(F.col(c).asc() if up else F.col(c).desc() for c, up in order)] or [F.lit(0)]
    sized = df.select(*columns, F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("__size"))
    # the number of a row: its partition, then its place there
    stored = settle(sized.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()), "shard-order")
    # one text for each group, nulls told from texts
    as_text = F.to_json(F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(group)))) if group else F.lit("")
    narrow = stored.select(as_text.alias("__group"), F.shiftright("__at", block).alias("__block"), "__at", "__size")
    whole = narrow.count() <= fold_rows
    states = None if whole else _states(narrow, size, before, settle)
    if states is None:
        known = narrow.withColumns({c: F.lit(None).cast("double") for c in ("__shard", "__held")})
    else:
        known = narrow.join(states.withColumns({c: F.col(c).cast("double") for c in ("__shard", "__held")}), ["__group", "__block"], "left").select(*narrow.columns, "__shard", "__held")
    begins = _fold(known, size, before, whole, False)
    if not whole:
        begins = settle(begins, "shard-begins")
    out = [*dict.fromkeys([*group, *keep])]
    if whole or begins.count() <= sent:
        found = begins.toArrow().sort_by("__at")
        sent_ = spark.sparkContext.broadcast((found.column("__at").to_numpy(), found.column("__shard").to_numpy()))

        @F.pandas_udf(T.LongType())
        def looked_up(at: pd.Series) -> pd.Series:
            places, shards = sent_.value
            return pd.Series(shards[np.searchsorted(places, at.to_numpy(), "right") - 1])

        return stored.select(*out, looked_up("__at").alias(name))
    return stored.join(_fold(known, size, before, whole, True), "__at").select(*out, F.col("__shard").alias(name))


def shard_totals(shards: DataFrame, group: list[str], size_col: str, size: int | None = None, name: str = "shard") -> DataFrame:
    """group, shard, documents, bytes of each shard. size: with the empty shard that a writer which opens the next file at
    once is left with, where the last one of a group is full."""
    totals = shards.groupBy(*group, name).agg(F.count(F.lit(1)).alias("documents"), F.sum(size_col).alias("bytes"))
    if size is None:
        return totals
    last = totals.groupBy(*group).agg(F.max_by("bytes", name).alias("bytes"), F.max(name).alias(name)).where(F.col("bytes") >= size)
    return totals.unionByName(last.select(*group, (F.col(name) + 1).alias(name), F.lit(0).cast("long").alias("documents"), F.lit(0).cast("long").alias("bytes")))


def round_robin(df: DataFrame, order: list[Column], batch: int, nodes: int) -> DataFrame:
    """df with batch and node of each row: batches of `batch` rows in order, dealt to nodes in turn. A plan for a list of
    files, ordered in one task; a longer list than stats.LISTED is an error."""
    n = F.row_number().over(Window.orderBy(*order)) - 1
    return listed(df).withColumn("batch", F.floor(n / batch).cast("long")).withColumn("node", F.col("batch") % nodes)


def first_fit_decreasing(sizes: list[tuple[str, float]], capacity: float) -> list[list[str]]:
    """Names in batches of at most `capacity`, largest first into the first batch with room; larger items are alone."""
    batches: list[tuple[float, list[str]]] = []
    for name, size in sorted(sizes, key=lambda s: (-s[1], s[0])):
        for i, (used, names) in enumerate(batches):
            if used + size <= capacity:
                batches[i] = (used + size, [*names, name])
                break
        else:
            batches.append((size, [name]))
    return [names for _, names in batches]


def ffd_batches(df: DataFrame, name: str, size: str, capacity: float) -> DataFrame:
    """batch, name, size by first-fit decreasing: a plan for a list of files, made in one task; a longer list than
    stats.LISTED is an error."""
    schema = df.select(F.lit(0).cast("long").alias("batch"), F.col(name), F.col(size).cast("double").alias(size)).schema

    def plan(frame):
        sizes = dict(zip(frame[name], frame[size].astype(float)))
        rows = [(b, n, sizes[n]) for b, names in enumerate(first_fit_decreasing(list(sizes.items()), capacity)) for n in names]
        return type(frame)(rows, columns=["batch", name, size])

    return listed(df.select(name, size)).groupBy().applyInPandas(plan, schema)


def renumber(existing: dict[str, int], incoming: DataFrame, folder: str, file: str) -> DataFrame:
    """incoming with `number`: files that would collide get numbers from the present count of their folder upward."""
    start = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in existing.items() for x in kv)), F.col(folder)), F.lit(0)) if existing else F.lit(0)
    return incoming.withColumn("number", F.row_number().over(Window.partitionBy(folder).orderBy(file)) + start)
