"""Sinks: partitioned tables, JSON Lines in zstd frames, markers, and checks of what was written."""

from __future__ import annotations

import json
import os
import posixpath
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from millrace.operators.mux import Spec, fanned
from millrace.operators.shard import greedy_shards, shard_totals
from millrace.sources.frames import PIECE, _Window, frame_sizes, seek_table
from millrace.sources.lines import numbered_lines
from millrace.sources.shared import settle, text_writer, write_text

#: Uncompressed bytes of a frame, so that readers can start inside a file.
FRAME = 512 * 1024


def write_partitioned(df: DataFrame, path: str, by: list[str], order: list[str] | None = None, mode: str = "error") -> None:
    """Parquet folders by the given columns; rows of a folder are brought together first, so that files stay few. Folders
    without rows do not come into being."""
    dealt = df.repartition(*by)
    (dealt.sortWithinPartitions(*by, *order) if order else dealt).write.mode(mode).partitionBy(*by).parquet(path)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path there of a local path or a URI (file, s3 and s3a, gs, hdfs, abfs ...)."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:(//)?", "", path)
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


@dataclass
class Written(WriterCommitMessage):
    #: Folder of the attempt that has succeeded, or None if it has written nothing.
    attempt: str | None


class ZstdLines(DataSource):
    """format("zstdlines"): lines to zstd files below a folder of any file system, in frames of FRAME bytes and with a seek
    table, so that readers can start inside a file.

    With one string column, to `<prefix>_<task>.jsonl.zst`. With two, the first one names the file, and a file's rows
    must come one after another in a task; what several tasks have of a file are its pieces, in the order of the tasks. Or,
    with the option `fan`, the first one names a folder, each task writes one file to each, and rows may come in any order: a
    task holds as many files open as there are folders. A null name is an error. Options: path, job, prefix, level, frame, fan.

    Each attempt of a task writes below `.attempts/<job>/`, and at last the list of its files. The job is committed by one
    small file, `.manifest/<job>`, which names the attempts that count. publish() then puts pieces together and gives files
    their names."""

    @classmethod
    def name(cls) -> str:
        return "zstdlines"

    def writer(self, schema: StructType, overwrite: bool):
        return ZstdWriter(dict(self.options))


class _Sink:
    """A file of frames that is being written."""

    def __init__(self, stream, level: int, frame: int):
        self.stream, self.squeeze, self.most = stream, zstandard.ZstdCompressor(level=level), frame
        self.held: list[bytes] = []
        self.size, self.frames = 0, []

    def add(self, line: str | None) -> None:
        data = (line or "").encode() + b"\n"
        self.held.append(data)
        self.size += len(data)
        if self.size >= self.most:
            self.flush()

    def flush(self) -> None:
        if self.held:
            packed = self.squeeze.compress(b"".join(self.held))
            self.stream.write(packed)
            self.frames.append((len(packed), self.size))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.stream.write(seek_table(self.frames))
        self.stream.close()


ATTEMPTS, MANIFEST, FILES = ".attempts", ".manifest", ".files"


class ZstdWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder, self.job = options["path"].rstrip("/"), options.get("job") or uuid.uuid4().hex
        self.prefix, self.level, self.frame = options.get("prefix", "part"), int(options.get("level", 3)), int(options.get("frame", FRAME))
        self.fan = options.get("fan", "false").lower() == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        return self.attempt(iterator, task.partitionId(), task.taskAttemptId())

    def attempt(self, iterator: Iterator[pa.RecordBatch], part: int, number: int) -> Written:
        where, root = file_system(self.folder)
        own = posixpath.join(root, ATTEMPTS, self.job, f"{part}-{number}")
        default, names, written, sinks = f"{self.prefix}_{part}.jsonl.zst", [], set(), {}

        def sink(file: str | None) -> _Sink:
            if file is None:
                raise ValueError("a row has no file to go to")
            if file not in sinks:
                if not self.fan:
                    for name in list(sinks):
                        sinks.pop(name).close()
                name = posixpath.join(file, default) if self.fan else file
                if name in written:
                    raise ValueError(f"rows of a file have to come one after another: {name!r}")
                place = posixpath.normpath(posixpath.join(own, name))
                if not place.startswith(own + "/"):
                    raise ValueError(f"no name of a file: {name!r}")
                where.create_dir(posixpath.dirname(place), recursive=True)
                sinks[file] = _Sink(where.open_output_stream(place, compression=None), self.level, self.frame)
                names.append(name)
                written.add(name)
            return sinks[file]

        for batch in iterator:
            lines = batch.column(batch.num_columns - 1).to_pylist()
            files = batch.column(0).to_pylist() if batch.num_columns > 1 else [default] * len(lines)
            for file, line in zip(files, lines):
                sink(file).add(line)
        for s in sinks.values():
            s.close()
        if not names:
            return Written(None)
        with where.open_output_stream(posixpath.join(own, FILES), compression=None) as out:
            out.write(json.dumps(names).encode())
        return Written(posixpath.basename(own))

    def commit(self, messages) -> None:
        """One small file, which appears at once or not at all, makes the attempts count."""
        where, root = file_system(self.folder)
        counted = sorted(m.attempt for m in messages if m and m.attempt)
        if counted:
            draft, final = (posixpath.join(root, MANIFEST, name) for name in (f".{self.job}.draft", self.job))
            where.create_dir(posixpath.dirname(final), recursive=True)
            with where.open_output_stream(draft, compression=None) as out:
                out.write(json.dumps(counted).encode())
            where.move(draft, final)

    def abort(self, messages) -> None:
        where, root = file_system(self.folder)
        _delete(where, posixpath.join(root, ATTEMPTS, self.job))


def _there(where: pafs.FileSystem, path: str) -> bool:
    return where.get_file_info(path).type != pafs.FileType.NotFound


def _delete(where: pafs.FileSystem, folder: str) -> None:
    if _there(where, folder):
        where.delete_dir(folder)


def _names(where: pafs.FileSystem, folder: str) -> list[str]:
    return sorted(i.base_name for i in where.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if not i.base_name.endswith(".draft"))


def _load(where: pafs.FileSystem, path: str) -> list[str]:
    with where.open_input_stream(path, compression=None) as f:
        return json.loads(f.read())


def pending(folder: str) -> list[tuple[str, str]]:
    """(job, attempt) of what has been committed below a folder and not yet published."""
    where, root = file_system(folder.rstrip("/"))
    jobs = _names(where, posixpath.join(root, MANIFEST))
    return [(job, a) for job in jobs for a in _load(where, posixpath.join(root, MANIFEST, job))]


def _part(attempt: str) -> int:
    return int(attempt.split("-")[0])


def committed_files(folder: str) -> list[tuple[str, str]]:
    """(name, where it lies now) of the files that are committed and not yet published: what a reader that can't wait for
    publish(), or runs where moving is dear, reads beside those that have their names. A file in pieces comes once for each,
    in their order, and once when it has been put together."""
    where, root = file_system(folder.rstrip("/"))
    pieces: dict[tuple[str, str], list[str]] = {}
    for job, attempt in sorted(pending(folder), key=lambda a: (a[0], _part(a[1]))):
        own = posixpath.join(root, ATTEMPTS, job, attempt)
        if _there(where, posixpath.join(own, FILES)):
            for name in _load(where, posixpath.join(own, FILES)):
                pieces.setdefault((name, job), []).append(posixpath.join(own, name))
    # without its first piece, a file has its name
    return [(name, place) for (name, _), places in sorted(pieces.items()) for place in (places if _there(where, places[0]) else [posixpath.join(root, name)])]


def _sizes(where: pafs.FileSystem, place: str) -> list[tuple[int, int]]:
    """Frames of a piece, as its seek table tells them."""
    with where.open_input_file(place) as file:
        return frame_sizes(_Window(file, file.size()))


def _copied(source, target, size: int) -> None:
    """The first `size` bytes, some at a time."""
    while size:
        data = source.read(min(size, PIECE))
        if not data:
            raise ValueError("a piece is shorter than its seek table tells")
        target.write(data)
        size -= len(data)


def publish(spark: SparkSession, folder: str) -> None:
    """Gives every committed file its name. What has been moved is passed over, so that a run which was cut off, by the loss
    of a task or of the driver, is finished by the next one. What attempts that don't count have left is deleted with the
    job's folder.

    Pieces of a file are put together without being decompressed: on a file system that is a folder here, each piece is
    copied to its place by a task of its own; elsewhere, where files can only be written from start to end, one task
    streams a file's pieces. A file's first piece goes last, so that until then it can be put together anew."""
    folder = folder.rstrip("/")
    todo = pending(folder)

    def draft(root: str, job: str, name: str) -> str:
        return posixpath.join(root, ATTEMPTS, job, ".whole", name)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = file_system(folder)
        for batch in batches:
            for job, attempt in zip(*(batch.column(i).to_pylist() for i in range(2))):
                own = posixpath.join(root, ATTEMPTS, job, attempt)
                # without its list, an attempt has been published, and its folder deleted
                for name in _load(where, posixpath.join(own, FILES)) if _there(where, posixpath.join(own, FILES)) else ():
                    place = posixpath.join(own, name)
                    size = sum(n for n, _ in _sizes(where, place)) if _there(where, place) else -1
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (job, name, _part(attempt), attempt, size)], names=["job", "name", "part", "attempt", "size"])

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = file_system(folder)
        for batch in batches:
            for job, name, attempt, size, at in zip(*(batch.column(i).to_pylist() for i in range(5))):
                target = draft(root, job, name)
                where.create_dir(posixpath.dirname(target), recursive=True)
                with open(posixpath.join(root, ATTEMPTS, job, attempt, name), "rb") as source, open(os.open(target, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as out:
                    out.seek(at)
                    _copied(source, out, size)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["copied"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = file_system(folder)
        for batch in batches:
            for job, name, pieces in zip(*(batch.column(i).to_pylist() for i in range(3))):
                final, whole = posixpath.join(root, name), draft(root, job, name)
                places = [posixpath.join(root, ATTEMPTS, job, p["attempt"], name) for p in pieces]
                if not _there(where, places[0]):
                    if not _there(where, final):
                        raise ValueError(f"committed, but nowhere to be found: {name}")
                    continue
                where.create_dir(posixpath.dirname(final), recursive=True)
                if len(pieces) == 1:
                    where.move(places[0], final)
                    continue
                table, end = seek_table([f for p in places for f in _sizes(where, p)]), sum(p["size"] for p in pieces)
                if isinstance(where, pafs.LocalFileSystem):
                    # moved by an attempt that was lost before it told so
                    if _there(where, whole):
                        with open(whole, "r+b") as out:
                            out.truncate(end)
                            out.seek(end)
                            out.write(table)
                        where.move(whole, final)
                else:
                    where.create_dir(posixpath.dirname(whole), recursive=True)
                    with where.open_output_stream(whole, compression=None) as out:
                        for place, p in zip(places, pieces):
                            with where.open_input_stream(place, compression=None) as source:
                                _copied(source, out, p["size"])
                        out.write(table)
                    where.move(whole, final)
                where.delete_file(places[0])
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["named"])

    if todo:
        found = spark.createDataFrame(todo, "job string, attempt string").repartition(min(len(todo), 10_000)).mapInArrow(listed, "job string, name string, part long, attempt string, size long")
        piece = F.struct("part", "attempt", "size")
        files = found.groupBy("job", "name").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
        if len(todo) > len({job for job, _ in todo}):
            files = settle(files, "published")
            where, _ = file_system(folder)
            # begun ones are those whose first piece is still there
            several = files.where((F.size("pieces") > 1) & (F.col("pieces")[0]["size"] >= 0))
            if isinstance(where, pafs.LocalFileSystem) and (n := several.agg(F.sum(F.size("pieces"))).first()[0]):
                before = F.aggregate(F.slice("pieces", 1, F.col("i")), F.lit(0).cast("long"), lambda a, p: a + p["size"])
                each = several.select("job", "name", "pieces", F.posexplode("pieces").alias("i", "p")).select("job", "name", "p.attempt", "p.size", before.alias("at"))
                each.repartition(min(n, 10_000)).mapInArrow(copied, "copied long").agg(F.sum("copied")).collect()
            files = files.repartition(min(len(todo), 10_000))
        files.mapInArrow(named, "named long").agg(F.sum("named")).collect()
    where, root = file_system(folder)
    for job in dict.fromkeys(job for job, _ in todo):
        # first the manifest: what is cut off after it leaves a folder to be swept, and never pieces that look like a file
        where.delete_file(posixpath.join(root, MANIFEST, job))
        _delete(where, posixpath.join(root, ATTEMPTS, job))
    for name in (ATTEMPTS, MANIFEST):
        if _there(where, posixpath.join(root, name)) and not where.get_file_info(pafs.FileSelector(posixpath.join(root, name))):
            where.delete_dir(posixpath.join(root, name))


def sweep(folder: str, older: float = 86_400.0) -> int:
    """Deletes what jobs without a manifest, whose driver was lost, have left below a folder, if it is `older` seconds old;
    the number of those jobs. A job that is still running must not be swept."""
    where, root = file_system(folder.rstrip("/"))
    known, gone = {job for job, _ in pending(folder)}, 0
    for info in where.get_file_info(pafs.FileSelector(posixpath.join(root, ATTEMPTS), allow_not_found=True)):
        newest = max((i.mtime_ns or 0 for i in [info, *where.get_file_info(pafs.FileSelector(info.path, recursive=True))]), default=0)
        if info.base_name not in known and newest / 1e9 <= time.time() - older:
            where.delete_dir(info.path)
            gone += 1
    return gone


def _save(lines: DataFrame, path: str, **options) -> None:
    spark = lines.sparkSession
    spark.dataSource.register(ZstdLines)
    lines.write.format("zstdlines").options(path=path, job=uuid.uuid4().hex, **{k: str(v) for k, v in options.items()}).mode("append").save()
    publish(spark, path)


def as_json(df: DataFrame, leave: tuple[str, ...] = ()) -> Column:
    """Rows as JSON, null fields left out."""
    return F.to_json(F.struct(*(f"`{c}`" for c in df.columns if c not in leave)))


def write_jsonl(df: DataFrame, path: str, prefix: str = "part", level: int = 3) -> None:
    """Rows as JSON Lines, null fields left out, in zstd files of several frames, one for each task."""
    _save(df.select(as_json(df).alias("value")), path, prefix=prefix, level=level)


def write_files(df: DataFrame, path: str, file: str, value: str, order: list[Column], level: int = 3, frame: int = FRAME) -> None:
    """Lines (`value`) to the files that each row names, in order; lines alike in it by a hash. Tasks have ranges of files and
    order, so that a file of any size is the work of many, each of which writes a piece."""
    keys = [F.col(file), *order, F.xxhash64(value)]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    _save(dealt.select(F.col(file), F.col(value)), path, level=level, frame=frame)


def write_single(df: DataFrame, path: str, name: str, order: list[Column], level: int = 3) -> None:
    """Rows as JSON Lines in one file `name`, in order."""
    lines = df.withColumns({"__file": F.lit(name), "__value": as_json(df)})
    write_files(lines, path, "__file", "__value", order, level)


#: Folder of rows whose folder column is null or empty, as Spark's own partitioned writers name it.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_name(value: Column) -> Column:
    """A column's values as names of folders: null and empty ones as NO_VALUE, what would leave the folder escaped."""
    text = F.replace(F.replace(value.cast("string"), F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))
    return F.when(F.coalesce(text, F.lit("")) == "", NO_VALUE).when(text.rlike(r"^\.+$"), F.replace(text, F.lit("."), F.lit("%2E"))).otherwise(text)


def write_shards(df: DataFrame, path: str, folder: list[str], bin_: str | None, order: list[tuple[str, bool]], size: int, infix: str | None = None, lines: bool = False, start: int = 1, level: int = 3) -> None:
    """Rows as JSON Lines to `<folder columns>/[<bin>_]<n>[.<infix>].jsonl.zst`, each file closed once it has `size` bytes (or
    lines), n from `start`, in order within each. What names a file isn't written into it; folders without rows do not come
    into being. Rows whose folder is null or empty go to NO_VALUE; a null bin or infix is left out of the name."""
    record = df.withColumn("__value", as_json(df, tuple(folder))).withColumns({f"__f{i}": folder_name(F.col(f"`{c}`")) for i, c in enumerate(folder)})
    for name, c in (("__bin", bin_), ("__infix", infix)):
        record = record.withColumn(name, F.replace(F.col(f"`{c}`").cast("string"), F.lit("/"), F.lit("%2F")) if c else F.lit(None).cast("string"))
    group = [*(f"__f{i}" for i in range(len(folder))), *(["__bin"] if bin_ else []), *(["__infix"] if infix else [])]
    sized = record.withColumn("__size", F.lit(1) if lines else F.octet_length("__value") + 1).withColumns({f"__o{i}": F.col(f"`{c}`") for i, (c, _) in enumerate(order)})
    by = [f"__o{i}" for i in range(len(order))]
    placed = greedy_shards(sized.select("__value", "__size", *group, *by), group, list(zip(by, (up for _, up in order))), [*by, "__value"], "__size", size, "__shard")
    number = (F.col("__shard") + (start - 1)).cast("string")
    base = F.concat_ws("_", *([F.col("__bin")] if bin_ else []), number)
    name = F.concat(*(x for i in range(len(folder)) for x in (F.col(f"__f{i}"), F.lit("/"))), base, *([F.coalesce(F.concat(F.lit("."), F.col("__infix")), F.lit(""))] if infix else []), F.lit(".jsonl.zst"))
    keys = [F.col(f"__o{i}").asc() if up else F.col(f"__o{i}").desc() for i, (_, up) in enumerate(order)]
    write_files(placed.withColumn("__file", name), path, "__file", "__value", keys, level)


def write_fan_out(records: DataFrame, path: str, specs: list[tuple[str, Spec]], together: bool = False, prefix: str = "part", level: int = 3) -> None:
    """Records (a column `rec`) to the folders `<path>/<output>/` of all specifications, read and parsed once: each task has a
    file in each. Of an output that is named twice the later specification counts; together: it gets the records of both."""
    _save(fanned(records, specs, together), path, prefix=prefix, level=level, fan=True)


def reshard(spark: SparkSession, source: str, target: str, bins: range = range(11), size: int = 128 << 30, suffix: str = ".jsonl.l.zst", level: int = 10) -> None:
    """Existing files `<bin>_*<suffix>` of a folder anew as `<bin>_<n>.jsonl.zst`, lines in the order of files, each file
    closed once it has `size` characters; where the last one of a bin is, an empty one follows, as a writer that opens the next
    file at once leaves it. The only file of a bin keeps its name and its lines, whatever its size."""
    where, root = file_system(source)
    names = sorted(i.base_name for i in where.get_file_info(pafs.FileSelector(root)) if i.is_file and i.base_name.endswith(suffix))
    of = {b: [n for n in names if n.startswith(f"{b}_")] for b in bins}
    found = [f"{source.rstrip('/')}/{n}" for several in of.values() for n in several]
    if not found:
        return
    rows = numbered_lines(spark, found).withColumn("__bin", F.regexp_extract("file", r"^([0-9]+)_", 1).cast("int"))
    alone = {n for several in of.values() if len(several) == 1 for n in several}
    placed = greedy_shards(rows.withColumn("__n", F.when(F.col("file").isin(sorted(alone)), 0).otherwise(F.length("value") + 1)), ["__bin"], [("file", True), ("line", True)], ["file", "line", "value"], "__n", size)
    own = F.concat(F.regexp_replace("file", re.escape(suffix) + "$", ""), F.lit(".jsonl.zst"))
    new = F.concat(F.col("__bin").cast("string"), F.lit("_"), F.col("shard").cast("string"), F.lit(".jsonl.zst"))
    named = placed.withColumn("__file", F.when(F.col("file").isin(sorted(alone)), own).otherwise(new))
    write_files(named, target, "__file", "value", [F.col("file"), F.col("line")], level)
    several = placed.where(~F.col("file").isin(sorted(alone))).withColumn("__n", (F.length("value") + 1).cast("long"))
    out, at = file_system(target)
    # at most one for each bin
    for r in shard_totals(several, ["__bin"], "__n", size).where("documents = 0").collect():
        with out.open_output_stream(posixpath.join(at, f"{r['__bin']}_{r['shard']}.jsonl.zst"), compression=None) as f:
            f.write(zstandard.ZstdCompressor(level=level).compress(b"") + seek_table([]))


def shard_names(bin_col: str = "wds_bin", shard_col: str = "shard", infix: str | None = None):
    """`{bin}_{n}[.{infix}].jsonl.zst` as a column."""
    middle = F.concat(F.lit("."), F.col(infix)) if infix else F.lit("")
    return F.concat(F.col(bin_col).cast("string"), F.lit("_"), F.col(shard_col).cast("string"), F.coalesce(middle, F.lit("")), F.lit(".jsonl.zst"))


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """file, lines of every file below a folder, read to its end: a file that can't be read is an error."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path)
    return rows.select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))


def mark_done(spark: SparkSession, folder: str, counts: dict[str, int]) -> bool:
    """Write `.done` with the counts if all are equal; whether it was written. A folder with files that are committed and not
    yet published isn't done: publish() first."""
    manifests = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + MANIFEST)
    if len(set(counts.values())) > 1 or manifests.getFileSystem(spark._jsc.hadoopConfiguration()).exists(manifests):
        return False
    write_text(spark, folder.rstrip("/") + "/.done", "".join(f"{n}\t{c}\n" for n, c in sorted(counts.items())))
    return True


def write_filter_json(spark: SparkSession, folder: str, statistics: DataFrame, by: str = "file") -> None:
    """`.<file>.filter.json` of each input, known suffixes of a file's name left out, and `.filter.json` of all (null), which
    also has an object for each file under its whole name. Rows stream through the driver one by one into the files."""
    root = folder.rstrip("/")
    total = next(iter(statistics.where(F.col(by).isNull()).select("statistics").collect()), None)
    with text_writer(spark, f"{root}/.filter.json") as write:
        head = (total["statistics"] if total else "{}").rstrip()[:-1]
        write(head)
        comma = "," if len(head) > 1 else ""
        for r in statistics.where(F.col(by).isNotNull()).select(by, "statistics").toLocalIterator():
            name = re.sub(r"(\.jsonl)?(\.zstd?)?$", "", r[by], count=1)
            write_text(spark, f"{root}/.{name}.filter.json", r["statistics"])
            write(f"{comma}{json.dumps(r[by], ensure_ascii=False)}:{r['statistics']}")
            comma = ","
        write("}")


def write_statistics(df: DataFrame, path: str) -> None:
    """Statistics as one tab-separated file with a header."""
    df.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
