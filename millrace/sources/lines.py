"""Line sources: JSON Lines, compressed or not, with or without line numbers; readers by release; resuming."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from fnmatch import fnmatch
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions.text import decoded_base64
from millrace.sources.frames import SPLIT, listed, zstd_lines


def read_lines(spark: SparkSession, paths: str | list[str], pattern: str | None = None, exclude: tuple[str, ...] = (), trace: bool = False) -> DataFrame:
    """value, file of text files in any compression that the Hadoop readers know (zstd of several frames, gzip ...). Where all
    are zstd and one is larger than a split, they are read by ranges of frames, else file by file.

    pattern: a glob on file names. exclude: names that contain one of these are dropped. Files that begin with a dot or an
    underscore are only read by hidden_lines(). trace: also the path."""
    reader = spark.read.option("recursiveFileLookup", "false")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if _worth_cutting(spark, paths, pattern):
        out = zstd_lines(spark, paths, pattern, numbers=False).select("value", "file", *(["path"] if trace else []))
    else:
        df = reader.text(paths if isinstance(paths, list) else [paths])
        out = df.select("value", F.col("_metadata.file_name").alias("file"), *([F.col("_metadata.file_path").alias("path")] if trace else []))
    for name in exclude:
        out = out.where(~F.contains("file", F.lit(name)))
    return out


def _worth_cutting(spark: SparkSession, paths: str | list[str], pattern: str | None) -> bool:
    """Whether the files are zstd, and one is too large for one task. They are listed, not read."""
    if pattern and not pattern.endswith(("zst", "zstd", "*")):
        return False
    found = listed(spark, paths, pattern).agg(F.max("length").alias("largest"), F.count_if(~F.col("path").rlike("[.]zstd?$")).alias("others")).first()
    return found["others"] == 0 and (found["largest"] or 0) > SPLIT


def hidden_lines(spark: SparkSession, folder: str, pattern: str = ".*.ids.zst") -> DataFrame:
    """value, file of zstd or plain files whose names may begin with a dot, which Spark's own readers pass over. Names are
    listed by the driver, and each file is read by one task, piece by piece."""
    from millrace.sources.sinks import file_system

    where, root = file_system(folder)
    found = sorted(i.path for i in where.get_file_info(pafs.FileSelector(root)) if i.is_file and fnmatch(i.base_name, pattern))
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("file", T.StringType())])
    if not found:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(path, compression="zstd" if path.endswith((".zst", ".zstd")) else None) as raw:
                    text = io.TextIOWrapper(raw, encoding="utf-8", newline="\n")
                    while lines := text.readlines(1 << 20):
                        values = [line.removesuffix("\n") for line in lines]
                        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([path.rsplit("/", 1)[-1]] * len(values), pa.string())], names=["value", "file"])

    names = spark.createDataFrame([(p,) for p in found], "path string").repartition(min(len(found), 10_000))
    return names.mapInArrow(read, schema)


#: Blocks of files whose line counts may be broadcast.
SENT_BLOCKS = 1_000_000


def numbered_lines(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """path, file, line (from 0), value. For text, rows of a block of a file follow each other within one partition, so a
    line's number is its place there plus the lines of the file's earlier blocks; compressed files are one block. The table
    of blocks is broadcast up to SENT_BLOCKS of them, so that the lines of a large file aren't one join key. Large zstd
    files are read by ranges of frames, as in read_lines()."""
    if _worth_cutting(spark, paths, pattern):
        return zstd_lines(spark, paths, pattern)
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    rows = reader.text(paths if isinstance(paths, list) else [paths]).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    )
    blocks = rows.groupBy("path", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # a file has one block, or one for each split of it
    splits = rows.rdd.getNumPartitions() + len(rows.inputFiles())
    return rows.join(F.broadcast(blocks) if splits <= SENT_BLOCKS else blocks, ["path", "block"]).select("path", "file", (F.col("at") - F.col("first") + F.col("before")).alias("line"), "value")


def checked_objects(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Lines whose very first character begins a JSON object. strict: another line ends the query with an error; else it is
    left out."""
    is_object = F.startswith("value", F.lit("{"))
    if not strict:
        return lines.where(is_object)
    return lines.where(F.when(is_object, True).otherwise(F.raise_error(F.concat(F.lit("no JSON object: "), F.substring("value", 1, 80))).cast("boolean")))


def parsed(lines: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """The lines' other columns with the record's fields; a line that can't be parsed has nulls and `_corrupt` set."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*kind.fields, T.StructField("_corrupt", T.StringType())])
    record = F.from_json(F.col(value), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.withColumn("__r", record).select(*(c for c in lines.columns if c != value), "__r.*")


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, pattern: str | None = "*.zst") -> DataFrame:
    """Parsed JSON Lines; keys with a dash are found under underscores too."""
    df = parsed(read_lines(spark, paths, pattern), schema)
    return df.toDF(*(c.replace("-", "_") for c in df.columns))


def variants(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines with a variant column `rec`, null where the line is no JSON."""
    return lines.withColumn("rec", F.try_parse_json(F.col(value)))


@F.pandas_udf(T.StringType())
def _without_bad_bytes(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else bytes(b).decode(errors="ignore"))


def lenient_utf8(df: DataFrame, data: str, strict: bool = False) -> DataFrame:
    """df with text and error in place of the bytes in `data`: bytes as UTF-8; where they are none, the text without the bad
    bytes, and a message. strict: such rows are left out. Only rows with bad bytes go to Python."""
    good = F.is_valid_utf8(F.col(data).cast("string"))
    if strict:
        df = df.where(good | F.col(data).isNull())
    text = F.when(good, F.col(data).cast("string")).otherwise(_without_bad_bytes(F.when(~good, F.col(data))))
    return df.withColumns({"text": text, "error": F.when(~good, "invalid UTF-8")}).drop(data)


def optional_source(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The source if it exists."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return read_jsonl(spark, path, schema, None) if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where) else None


def base64_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """First release: one input of base64 texts, a line each."""
    if isinstance(paths, list):
        if len(paths) != 1:
            raise ValueError("this release has exactly one input")
        paths = paths[0]
    return numbered_lines(spark, paths).select("file", "line", decoded_base64(F.split_part("value", F.lit("\t"), F.lit(-1))).alias("text"))


def column_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Second release: line-parallel JSON files, joined by line; unequal numbers of lines are an error. line, text (null
    where the field is null or missing), collection, rec."""
    from millrace.operators.joins import merge_by_position, records

    sources = [records(numbered_lines(spark, p).withColumn("batch", F.lit(0)), keys=("batch", "line")) for p in paths]
    # one pass over all: as many lines with all inputs as any input has
    present = reduce(lambda a, b: a.unionAll(b), (s.select("line", F.lit(i).alias("i")) for i, s in enumerate(sources)))
    counts = {r["i"]: r["n"] for r in present.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(set(counts.values())) > 1 or 0 < len(counts) < len(paths):
        raise ValueError(f"inputs differ in length: {[counts.get(i, 0) for i in range(len(paths))]}")
    rec = merge_by_position(sources)
    get = lambda *names: F.coalesce(*(F.variant_get(F.element_at("rec", F.lit(n)), "$", "string") for n in names))
    return rec.select("line", get("text", "t").alias("text"), get("collection", "crawl_id").alias("collection"), "rec")


#: Readers by data release.
READERS: dict[str, Callable[[SparkSession, list[str]], DataFrame]] = {"1": base64_rows, "2": column_files}


def read_release(spark: SparkSession, version: str, paths: list[str]) -> DataFrame:
    if version not in READERS:
        raise ValueError(f"unknown data version {version!r}")
    return READERS[version](spark, paths)


def output_folder(path: Column, root: str) -> Column:
    """`.../<crawl>/html/<n>/text.zst` -> `<root>/<crawl>/pool/<n>`."""
    return F.regexp_replace(path, r"^.*/([^/]+)/html/([^/]+)/[^/]*$", root.rstrip("/") + "/$1/pool/$2")


def not_done(inputs: DataFrame, done: DataFrame, key: str = "folder") -> DataFrame:
    """Inputs whose output folder has no marker yet."""
    return inputs.join(done.select(key), key, "left_anti")


def path_list(lines: DataFrame, seed: int = 0) -> DataFrame:
    """Paths without .gz, in a reproducible random order."""
    bare = F.regexp_replace("value", r"\.gz$", "").alias("path")
    return lines.select(bare).orderBy(F.xxhash64(F.lit(seed), "path"), "path")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
