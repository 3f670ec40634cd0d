"""Corpus statistics: extraction errors, value frequencies, sizes, line counts, pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import length_class, line_count

#: Files that a plan over a list of files takes at most.
LISTED = 1_000_000
ERROR_KEYS = ("collection", "lang", "traferr", "lenclass")


def listed(df: DataFrame, most: int = LISTED) -> DataFrame:
    """df, if it is short enough to be planned in one task; else a ValueError."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"a plan over a list of files takes at most {most} of them")
    return df


def error_map(df: DataFrame) -> DataFrame:
    """Sums by collection, first language or `null`, error or `OK`, and length class."""
    error = F.when(F.size(F.coalesce("traferr", F.array().cast("array<string>"))) == 0, "OK").otherwise(F.array_join("traferr", ";"))
    keys = [F.col("collection"), F.coalesce(F.get(F.col("lang"), F.lit(0)), F.lit("null")).alias("lang"), error.alias("traferr"), length_class(F.col("text")).alias("lenclass")]
    text = F.col("text")
    return df.groupBy(*keys).agg(F.sum(line_count(text)).alias("text_newlines"), F.sum(F.coalesce(F.length(text), F.lit(0))).cast("long").alias("text_chars"), F.count(F.lit(1)).alias("docs"))


def error_rollup(mapped: DataFrame) -> DataFrame:
    """The sums of error_map for all keys, and with collection, then language, then everything left out (null)."""
    sets = [[*ERROR_KEYS], [*ERROR_KEYS[1:]], [*ERROR_KEYS[2:]], []]
    sums = [F.sum(c).alias(c) for c in ("text_newlines", "text_chars", "docs")]
    return mapped.groupingSets(sets, *ERROR_KEYS).agg(*sums, F.grouping_id(*ERROR_KEYS).cast("int").alias("level"))


def value_frequencies(df: DataFrame, value: Column) -> DataFrame:
    """value, n of each value, most frequent first, ties by value descending."""
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("value"))


def total_gigabytes(df: DataFrame, size: str = "size") -> DataFrame:
    return df.agg((F.sum(size) / 2**30).alias("gigabytes"))


def space_estimate(df: DataFrame, size: str = "size", tie: str = "path", factor: int = 7) -> DataFrame:
    """Files by size, largest first, with rank and running need of scratch space in TiB. A plan for a list of files: it is
    ordered in one task, and a longer list than LISTED is an error."""
    order = Window.orderBy(F.desc(size), tie)
    return listed(df).withColumn("n", F.row_number().over(order)).withColumn("tib", factor * F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) / 2**40)


def uneven_counts(df: DataFrame, group: str = "dir", file: str = "file", lines: str = "lines") -> DataFrame:
    """Folders whose line-parallel files differ in their numbers of lines: group, fewest, most."""
    counts = df.groupBy(group).agg(F.min(lines).alias("fewest"), F.max(lines).alias("most"), F.count(F.lit(1)).alias("files"))
    return counts.where("fewest <> most")


def conversion_success(df: DataFrame, md: str = "md") -> DataFrame:
    """ok of total conversions: an empty text is no success."""
    return df.agg(F.count_if(F.coalesce(F.length(md) > 0, F.lit(False))).alias("ok"), F.count(F.lit(1)).alias("total"))


def pool_statistics(df: DataFrame, keys: tuple[str, ...] = ("crawl", "batch")) -> DataFrame:
    """Lines, characters and nulls of each batch. df: keys, lang (first language or null), text, xml, md."""
    n = lambda c: F.sum(F.coalesce(F.length(c), F.lit(0))).cast("long")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        n("text").alias("chars"),
        F.count_if(F.col("text").isNull()).alias("null_text"),
        F.count_if(F.col("lang").isNull()).alias("null_lang"),
        n("xml").alias("xml_chars"),
        n("md").alias("md_chars"),
        F.count_if(F.col("xml").isNull()).alias("null_xml"),
        F.count_if(F.col("md").isNull()).alias("null_md"),
    )


def pool_sizes(spark: SparkSession, path: str, names: tuple[str, ...] = ("text", "metadata", "markup")) -> DataFrame:
    """folder, <name>_size: bytes on disk of the files named after each output (`text.zst` ...) in the folders below path.
    Files are listed, not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    name = F.regexp_extract("path", r"([^/.]*)[^/]*$", 1)
    folder = F.regexp_replace("path", r"/[^/]*$", "").alias("folder")
    return found.groupBy(folder).agg(*(F.coalesce(F.sum(F.when(name == n, F.col("length"))), F.lit(0)).alias(f"{n}_size") for n in names))


def pool_languages(df: DataFrame, keys: tuple[str, ...] = ("crawl", "batch")) -> DataFrame:
    """Documents and characters by language (`null` for none) of each batch, one row each."""
    lang = F.coalesce("lang", F.lit("null")).alias("lang")
    return df.groupBy(*keys, lang).agg(F.count(F.lit(1)).alias("lang_docs"), F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("long").alias("lang_chars"))


def language_maps(languages: DataFrame, keys: tuple[str, ...] = ("crawl", "batch")) -> DataFrame:
    """pool_languages as two maps for each batch: lang_docs and lang_chars."""
    pairs = lambda v: F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", v))))
    return languages.groupBy(*keys).agg(pairs("lang_docs").alias("lang_docs"), pairs("lang_chars").alias("lang_chars"))


def merged_pool_statistics(stats: DataFrame, by: str = "crawl") -> DataFrame:
    """Sums of pool_statistics over the batches of each crawl (the name up to its first dot), and over all (`total`)."""
    sums = [c for c, kind in stats.dtypes if kind == "bigint"]
    rows = stats.withColumn(by, F.split_part(by, F.lit("."), F.lit(1)))
    return rows.groupingSets([[by], []], by).agg(*(F.sum(c).alias(c) for c in sums)).withColumn(by, F.coalesce(by, F.lit("total")))


def merged_maps(stats: DataFrame, column: str, by: str = "crawl") -> DataFrame:
    """Maps name -> number added up key by key, for each crawl."""
    parts = stats.select(by, F.explode(column).alias("k", "v")).groupBy(by, "k").agg(F.sum("v").alias("v"))
    return parts.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(column))
