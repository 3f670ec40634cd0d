"""Merge of sorted runs: files of JSON Lines, each sorted by a number, best first, into one order, without sorting.

The first number of each range of frames is a sparse index of a run. Bounds drawn from the index cut the whole order, numbers
falling, then runs from the last to the first, then lines, into ranges of about as many frames. A task has some ranges that
follow each other: it reads of each run the frames that may hold their lines and merges them line by line through a heap, in
one pass. It may read a range of frames of every run for little; so tasks are no more than 4 for as many ranges of frames as
there are runs, or than cores, which bounds what all read, however small the ranges of the order. Equal numbers of one run stay
together in their order, and those of the run that is named last come first; bounds may lie within them, so that a number that
very many lines share is the work of many tasks, too.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from millrace.sources.frames import BATCH, _dealt, _open, frame_splits, listed, split_lines
from millrace.sources.shared import settle

#: Compressed bytes of an indexed range of frames, and of a merged range, about; bounds that the driver draws at most.
ENTRY, RANGE, BOUNDS = 1 << 20, 64 << 20, 10_000
#: Compressed bytes that a task merges, about, where ranges are smaller; indexed ranges that a task looks into, at least, where
#: there are more; bytes of lines that a task holds of all runs, about.
TASK, HEADS, HELD = 8 << 20, 64, 32 << 20


def number_of(field: str) -> Callable[[bytes], float]:
    """The number of a field (its first one, of a list) of a JSON line."""

    def read(line: bytes) -> float:
        value = json.loads(line)[field]
        return float(value[0] if isinstance(value, list) else value)

    return read


def _qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark's readers tell it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def run_index(spark: SparkSession, runs: list[str], key: Callable[[bytes], float], entry: int = ENTRY) -> DataFrame:
    """path, run, start, end, first: the number of the first line that begins in each range of frames; ranges in which none
    begins are left out."""
    paths = {_qualified(spark, p): i for i, p in enumerate(runs)}
    files = [(r["path"], r["length"], paths.get(r["path"])) for r in listed(spark, runs, None).collect()]
    # empty files aren't listed
    if strange := [p for p, _, i in files if i is None]:
        raise ValueError(f"no run was named so: {strange[:10]}")
    numbered = spark.createDataFrame(files, "path string, length long, run int")
    ranges = settle(frame_splits(numbered.select("path", "length"), entry), "run-ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for path, start, end in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with _open(path) as file:
                    line = next((x for lines in split_lines(file, start, end, 1) for x in lines), None)
                if line is not None:
                    found.append((path, start, end, key(line)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["path", "start", "end", "first"])

    heads = _dealt(ranges, F.count(F.lit(1)) / HEADS).mapInArrow(run, "path string, start long, end long, first double")
    return heads.join(F.broadcast(numbered.select("path", "run")), "path")


def _bounds(index: DataFrame, wanted: int) -> list[tuple[float, int, int]]:
    """(number, run, start) of entries, in order, that cut the whole order into about `wanted` parts. What is drawn only
    decides where parts end, never what they hold."""
    n = index.count()
    some = index if n <= BOUNDS else index.where(F.pmod(F.xxhash64("path", "start"), F.lit(n)) < BOUNDS)
    places = sorted(((r["first"], r["run"], r["start"]) for r in some.select("first", "run", "start").collect()), key=lambda b: (-b[0], -b[1], b[2]))
    wanted = max(1, min(wanted, len(places)))
    return sorted({places[i * len(places) // wanted] for i in range(1, wanted)}, key=lambda b: (-b[0], -b[1], b[2]))


def merged(spark: SparkSession, runs: list[str], key: Callable[[bytes], float], least: float | None = None, most: float | None = None, entry: int = ENTRY, part: int = RANGE) -> DataFrame:
    """part, place, number, run, value: the lines of all runs in one order, parts in order of partitions, places in each part.

    least, most: only lines with least <= number <= most, as the merge of a range of scores asks. A run that isn't sorted is
    an error where it is noticed."""
    index = settle(run_index(spark, runs, key, entry), "run-index")
    sums = index.agg(F.sum(F.col("end") - F.col("start")).alias("total"), F.count(F.lit(1)).alias("n")).first()
    bounds = _bounds(index, -(-(sums["total"] or 0) // part))
    parts = len(bounds) + 1
    wanted = max(1, min(parts, max(spark.sparkContext.defaultParallelism, min((sums["total"] or 0) // TASK, 4 * sums["n"] // max(1, len(runs))))))
    # the first part of each task
    firsts = [i * parts // wanted for i in range(wanted)] + [parts]
    edges = [(-n, -r, place) for n, r, place in (bounds[f - 1] for f in firsts[1:-1])]

    @F.pandas_udf(T.IntegerType())
    def task_of(first: pd.Series, run: pd.Series, start: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(edges, (-n, -r, at)) for n, r, at in zip(first, run, start)], dtype="int32")

    # an entry's lines begin in the task of its first one, and end no later than in that of the next entry's first one
    placed = index.withColumn("task", task_of("first", "run", "start"))
    following = F.lead("task").over(Window.partitionBy("path").orderBy("start"))
    spans = placed.withColumn("to", F.coalesce(following, F.lit(wanted - 1))).select("run", "path", "start", "end", F.explode(F.sequence("task", F.greatest("to", "task"))).alias("task"))
    slices = spans.groupBy("task", "run", "path").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    tasks = slices.groupBy("task").agg(F.sort_array(F.collect_list(F.struct("run", "path", "start", "end"))).alias("slices"))
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("number", T.DoubleType()), T.StructField("run", T.IntegerType()), T.StructField("value", T.StringType())])
    arrow = to_arrow_schema(schema)

    def lines_of(s: dict, since: int, until: int, batch: int) -> Iterator[tuple]:
        """(order, part, number, run, line) of a slice's lines that lie in the parts from `since` on and before `until`."""
        low, high = bounds[since - 1] if since else None, bounds[until - 1] if until < parts else None
        if low and high and low[0] == high[0] and not high[1] <= s["run"] <= low[1]:
            return
        before, n, at = None, 0, since
        # in its own run, a bound is a place in the file
        start = max(s["start"], low[2]) if low and low[1] == s["run"] else s["start"]
        end = min(s["end"], high[2]) if high and high[1] == s["run"] else s["end"]
        if start >= end:
            return
        cuts = [b[2] for b in bounds[since : until - 1] if b[1] == s["run"] and start < b[2] < end]
        with _open(s["path"]) as file:
            for begin, stop in zip([start, *cuts], [*cuts, end]):
                for lines in split_lines(file, begin, stop, batch):
                    for line in lines:
                        number = key(line)
                        if before is not None and number > before:
                            raise ValueError(f"{s['path']} is not sorted: {number} after {before}")
                        before = number
                        if low and low[1] != s["run"] and not (number < low[0] or number == low[0] and s["run"] < low[1]):
                            continue
                        if high and high[1] != s["run"] and (number < high[0] or number == high[0] and s["run"] < high[1]):
                            return
                        if (most is None or number <= most) and (least is None or number >= least):
                            while at < until - 1 and (begin >= bounds[at][2] if bounds[at][1] == s["run"] else number < bounds[at][0] or number == bounds[at][0] and s["run"] < bounds[at][1]):
                                at += 1
                            n += 1
                            yield (-number, -s["run"], n), at, number, s["run"], line

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task, several in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, size, at, place = [], 0, -1, 0

                def out(held: list) -> pa.RecordBatch:
                    columns = zip(*((p, i, n, r, v.decode("utf-8", "replace")) for p, i, n, r, v in held))
                    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

                each = max(1, min(BATCH, HELD // len(several)))
                for _, p, number, r, line in heapq.merge(*(lines_of(s, firsts[task], firsts[task + 1], each) for s in several)):
                    at, place = p, place + 1 if p == at else 0
                    held.append((p, place, number, r, line))
                    size += len(line)
                    if size >= 4 << 20 or len(held) >= 10_000:
                        yield out(held)
                        held, size = [], 0
                if held:
                    yield out(held)

    # tasks are few rows; each goes to the partition of its number
    dealt = tasks.repartitionByRange(wanted, "task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, schema)
