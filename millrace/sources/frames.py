"""Zstandard files of several frames, read by ranges of frames, so that a large file is many tasks' work.

Where frames begin is told by a seek table at the file's end (the seekable format: a skippable frame of sizes with a footer,
which sinks.py writes), or else found by walking from block header to block header, without decompressing. Frames are put
together into splits. A line belongs to the split in which it begins: a split leaves out what comes before its first line
break, and reads on beyond its end to the next one, so that any cut gives the same lines. Numbers of lines come from a count of
breaks by split, so that no row has to be joined with where its split begins.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.sources.shared import settle

#: Compressed bytes of a split, about; bytes read, decompressed, and given out as lines, at a time; compressed bytes of a task,
#: about, where splits are smaller.
SPLIT, PIECE, FED, BATCH, TASK = 32 << 20, 1 << 20, 32 << 10, 4 << 20, 8 << 20
# Fixed values of the format: first bytes of a frame, of skippable ones, and of a seek table's footer.
FRAME_MAGIC, SKIPPABLE, SEEKABLE = 0xFD2FB528, 0x184D2A50, 0x8F92EAB1
TABLE_MAGIC = SKIPPABLE | 0xE


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that tells (compressed, decompressed) bytes of each frame before it."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer


class _Window:
    """Bytes of an open file by place; small reads that follow each other cost one read of the file."""

    def __init__(self, file, size: int, piece: int = 1 << 16):
        self.file, self.size, self.piece, self.at, self.held = file, size, piece, 0, b""

    def __call__(self, at: int, n: int) -> bytes:
        if not self.at <= at <= at + n <= self.at + len(self.held):
            self.file.seek(at)
            self.at, self.held = at, self.file.read(max(n, self.piece))
        found = self.held[at - self.at : at - self.at + n]
        if len(found) < n:
            raise ValueError(f"file ends within a frame, at {self.size}")
        return found


def frame_sizes(read: _Window) -> list[tuple[int, int]] | None:
    """(compressed, decompressed) bytes of each frame, by the file's seek table; None without one."""
    if read.size < 17:
        return None
    n, flags, magic = struct.unpack("<IBI", read(read.size - 9, 9))
    if magic != SEEKABLE:
        return None
    width = 12 if flags & 0x80 else 8
    begins = read.size - 9 - n * width
    if begins < 8 or struct.unpack("<I", read(begins - 8, 4))[0] != TABLE_MAGIC:
        return None
    table = read(begins, n * width) if n else b""
    found = [struct.unpack_from("<II", table, i * width) for i in range(n)]
    # other skippable frames before or between would not be in the table: then the file has to be walked
    return found if sum(size for size, _ in found) == begins - 8 else None


def from_table(read: _Window) -> list[int] | None:
    """Where frames begin, and where the last one ends, by the file's seek table; None without one."""
    found = frame_sizes(read)
    return None if found is None else [0, *accumulate(size for size, _ in found)]


def walked(read: _Window) -> Iterator[int]:
    """Where frames begin, and where the last one ends, by the headers of frames and blocks."""
    at = 0
    while at < read.size:
        magic = struct.unpack("<I", read(at, 4))[0]
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            at += 8 + struct.unpack("<I", read(at + 4, 4))[0]
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame at {at}")
        yield at
        kind = read(at + 4, 1)[0]
        single = kind >> 5 & 1
        at += 5 + (not single) + (0, 1, 2, 4)[kind & 3] + (single, 2, 4, 8)[kind >> 6]
        last = 0
        while not last:
            header = int.from_bytes(read(at, 3), "little")
            last, form, n = header & 1, header >> 1 & 3, header >> 3
            at += 3 + (1 if form == 1 else n)
        at += 4 * (kind >> 2 & 1)
    yield at


def splits(read: _Window, target: int) -> list[tuple[int, int]]:
    """Ranges of whole frames of about `target` compressed bytes."""
    if not read.size:
        return []
    found, begin, end = [], 0, 0
    for end in from_table(read) or walked(read):
        if end - begin >= target:
            found.append((begin, end))
            begin = end
    return found if end == begin and found else [*found, (begin, end)]


def _open(path: str):
    from millrace.sources.sinks import file_system

    fs, place = file_system(path)
    return fs.open_input_file(place)


def _pieces(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(where its frame begins, piece) of all that follows `start`, skippable frames left out; what lies from `end` on, of which
    little is wanted, is read in smaller pieces."""
    file.seek(start)
    held, at = b"", start

    def more() -> bool:
        nonlocal held
        data = file.read(max(FED, min(PIECE, end - at - len(held))))
        held += data
        return bool(data)

    while True:
        while len(held) < 8 and more():
            pass
        if not held:
            return
        magic, n = struct.unpack("<II", held[:8].ljust(8, b"\0"))
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            at += 8 + n
            file.seek(at)
            held = b""
            continue
        begin, out = at, zstandard.ZstdDecompressor().decompressobj()
        while not out.eof:
            if not held and not more():
                raise ValueError(f"file ends within the frame at {begin}")
            fed, held = held[:FED], held[FED:]
            made = out.decompress(fed)
            at += len(fed) - len(out.unused_data)
            if made:
                yield begin, made
        held = out.unused_data + held


def split_lines(file, start: int, end: int, batch: int = BATCH) -> Iterator[list[bytes]]:
    """Lines that begin in the frames of [start, end), without their breaks, about `batch` bytes at a time."""
    waiting, first, size, over = [], start > 0, 0, False
    for begin, data in _pieces(file, start, end):
        over = begin >= end
        if first:
            if over:
                return
            cut = data.find(b"\n")
            if cut < 0:
                continue
            data, first = data[cut + 1 :], False
        if over:
            cut = data.find(b"\n")
            if cut >= 0:
                waiting.append(data[:cut])
                yield b"".join(waiting).split(b"\n")
                return
        waiting.append(data)
        size += len(data)
        if size >= batch and not over and b"\n" in data:
            held = b"".join(waiting)
            *lines, rest = held.split(b"\n")
            if lines:
                yield lines
            waiting, size = [rest], 0
    # the file ends here: what follows the last break is a line only if there is something
    if not first:
        *lines, rest = b"".join(waiting).split(b"\n")
        yield [*lines, rest] if rest else lines


def listed(spark: SparkSession, paths: str | list[str], pattern: str | None = "*.zst") -> DataFrame:
    """path, length of the files; they aren't read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths).select("path", "length")


def frame_splits(files: DataFrame, target: int = SPLIT) -> DataFrame:
    """path, start, end of the splits of files (path, length): one task reads the seek table, or walks the headers, of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(*(batch.column(i).to_pylist() for i in range(2))):
                with _open(path) as file:
                    found = splits(_Window(file, length), target)
                if found:
                    starts, ends = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(found)), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["path", "start", "end"])

    return _dealt(files).mapInArrow(run, "path string, start long, end long")


def _dealt(df: DataFrame, worth: Column | None = None) -> DataFrame:
    """Rows that each stand for much work, dealt out evenly: no fewer partitions than cores, no more than rows need. worth: how
    many partitions the rows need (an aggregate), where that isn't one each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    needed = df.agg(F.count(F.lit(1)) if worth is None else worth).first()[0] or 0
    return df.repartition(max(cores, min(10_000, int(needed))))


def _tasks() -> Column:
    """Partitions that ranges of files need: one each, or, where they are smaller than TASK, one for so many bytes."""
    return F.least(F.count(F.lit(1)), F.sum(F.col("end") - F.col("start")) / TASK)


def numbered(splits_: DataFrame) -> DataFrame:
    """splits with first: the number of the first line of each in its file. Breaks are counted, lines aren't made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for path, start, end in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = 0
                with _open(path) as file:
                    for begin, data in _pieces(file, start, end):
                        if begin >= end:
                            break
                        n += data.count(b"\n")
                counts.append(n)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(counts, pa.int64())], names=["path", "start", "end", "breaks"])

    counted = _dealt(splits_, _tasks()).mapInArrow(run, "path string, start long, end long, breaks long")
    # a split's first line is the one after its first break: breaks before it, and that one, but for the file's first split
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("breaks").over(before), F.lit(0)) + F.when(F.col("start") > 0, 1).otherwise(0)
    return counted.select("path", "start", "end", first.cast("long").alias("first"))


def zstd_lines(spark: SparkSession, paths: str | list[str], pattern: str | None = "*.zst", numbers: bool = True, target: int = SPLIT) -> DataFrame:
    """path, file, line (from 0; without `numbers`, null), value of zstd files, each in as many tasks as it has splits of
    `target` compressed bytes; of splits smaller than TASK, a task has several. A line ends with \\n; one \\r before it is left
    out, too, as Spark's own reader does.

    A file of one frame, or one that can't be cut because it has no later frame, is one split, read piece by piece. Empty
    files have no lines, skippable frames are passed over, and a file that ends within a frame is an error. Bytes that
    are no UTF-8 are passed on as they are."""
    # stored, as they are counted before they are dealt out: files are walked, and breaks counted, once
    ranges = settle(frame_splits(listed(spark, paths, pattern), target), "frame-splits")
    ranges = settle(numbered(ranges), "frame-lines") if numbers else ranges.withColumn("first", F.lit(None).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                with _open(path) as file:
                    for found in split_lines(file, start, end):
                        found = [x[:-1] if x.endswith(b"\r") else x for x in found]
                        lines = pa.nulls(len(found), pa.int64()) if n is None else pa.array(range(n, n + len(found)), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(found), pa.string()), lines, pa.array(found, pa.binary())], names=["path", "line", "data"])
                        n = None if n is None else n + len(found)

    rows = _dealt(ranges, _tasks()).mapInArrow(run, "path string, line long, data binary")
    return rows.select("path", F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "line", F.col("data").cast("string").alias("value"))
