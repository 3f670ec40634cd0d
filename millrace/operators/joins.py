"""Positional merges, keyed annotation joins and id filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Annotation types by their key in side tables, in the order in which they are looked for, and the fields they fill.
ANNOTATIONS = {"bsc-edu-1.0": "bsc-edu", "finepdfs-edu": "finepdfs-edu", "fw2hq": "fineweb2-hq", "jql": "jql", "propella-4b": "propella-4b"}


def records(df: DataFrame, value: str = "value", keys: tuple[str, ...] = ("batch", "line")) -> DataFrame:
    """JSON lines as (keys, rec map<string, variant>), where absent and null differ; other JSON than objects is an empty map."""
    return df.select(*keys, F.coalesce(F.from_json(F.col(value), "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>")).alias("rec"))


def updated(rec: Column, by: Column) -> Column:
    """Map `rec` with the entries of `by`, which win: null entries too."""
    names = F.map_keys(by)
    return F.map_concat(F.map_filter(rec, lambda k, v: ~F.array_contains(names, k)), by)


def merge_by_position(sources: list[DataFrame], keys: tuple[str, ...] = ("batch", "line"), strict: bool = False) -> DataFrame:
    """(keys, rec) of line-parallel record sources; of fields in several, the last source's counts, null or not.

    Rows are matched by their key, never by physical order. Inner: as far as the shortest source goes. strict: led by the
    first source, and a missing line in another is an error (what they have beyond it is not looked at)."""
    named = [s.select(*keys, F.col("rec").alias(f"__r{i}")) for i, s in enumerate(sources)]
    joined = reduce(lambda a, b: a.join(b, list(keys), "left" if strict else "inner"), named)
    if strict and len(sources) > 1:
        there = reduce(lambda a, b: a & b, (F.col(f"__r{i}").isNotNull() for i in range(1, len(sources))))
        joined = joined.where(F.when(there, True).otherwise(F.raise_error(F.lit("premature end of file")).cast("boolean")))
    merged = reduce(updated, (F.col(f"__r{i}") for i in range(len(sources))))
    return joined.select(*keys, merged.alias("rec"))


def spliced(lines: list[Column]) -> Column:
    """Line-parallel JSON objects as one, put together as text: nothing is parsed, keys that several have are all kept, in
    order, and empty objects leave no comma. Null where one of them is; a line that is no object is an error."""

    def inner(line: Column) -> Column:
        text = F.rtrim(line, F.lit(" \t\r\n"))
        is_object = F.startswith(line, F.lit("{")) & F.endswith(text, F.lit("}"))
        checked = F.when(line.isNull() | is_object, text).otherwise(F.raise_error(F.concat(F.lit("no JSON object: "), F.left(line, F.lit(80)))).cast("string"))
        bare = F.substring(checked, F.lit(2), F.length(checked) - 2)
        return F.when(line.isNotNull(), F.nullif(bare, F.lit("")))

    all_there = reduce(lambda a, b: a & b, (line.isNotNull() for line in lines))
    return F.when(all_there, F.concat(F.lit("{"), F.concat_ws(",", *map(inner, lines)), F.lit("}")))


def last_annotation(table: DataFrame, key: str = "id", value: str = "value", order: str = "line") -> DataFrame:
    """One row for each key: the value of the last line; keys whose last value is null are left out."""
    return table.groupBy(key).agg(F.max_by(F.col(value), F.col(order)).alias(value)).where(F.col(value).isNotNull())


def annotate(docs: DataFrame, tables: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """docs with a column for each annotation (null where there is none). The engine picks broadcast or sort-merge."""
    for name, table in tables.items():
        docs = docs.join(last_annotation(table, key).select(key, F.col("value").alias(name)), key, "left")
    return docs


def annotation_statistics(docs: DataFrame, names: list[str]) -> DataFrame:
    """annotation, present, missing for each annotation column."""
    counts = docs.agg(*(F.count(F.col(f"`{n}`")).alias(f"p{i}") for i, n in enumerate(names)), F.count(F.lit(1)).alias("all"))
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("annotation"), F.col(f"p{i}").alias("present"), (F.col("all") - F.col(f"p{i}")).alias("missing")) for i, n in enumerate(names))))
    return counts.select(pairs.alias("r")).select("r.*")


def annotation_type(columns: list[str]) -> tuple[str, str]:
    """(key in the side table, field it fills) of an annotation table by its columns."""
    for key, name in ANNOTATIONS.items():
        if key in columns:
            return key, name
    raise ValueError(f"no known annotation among {columns}")


def duplicate_ids(df: DataFrame, key: str | Column = "id") -> DataFrame:
    """id, copies of every id with two or more occurrences."""
    key = F.col(key) if isinstance(key, str) else key
    return df.groupBy(key.alias("id")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_totals(df: DataFrame, key: str | Column = "id") -> DataFrame:
    """n documents, ids of which there are several, and d documents beyond the first of each."""
    key = F.col(key) if isinstance(key, str) else key
    counts = df.groupBy(key.alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("ids"), F.sum(F.col("n") - 1).alias("d"))


def skip_ids(docs: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """docs without any copy of the ids."""
    return docs.join(ids.select(key), key, "left_anti")


def robots_allowed(present: Column, allowed: Column) -> Column:
    """A row stays if its mask is missing or true; null and false drop it."""
    return ~present | F.coalesce(allowed, F.lit(False))


def mask_says_true(value: Column) -> Column:
    """A mask line as text keeps its row only if it holds `true`."""
    return F.coalesce(F.contains(value, F.lit("true")), F.lit(False))


def mask_lacks_false(value: Column) -> Column:
    """The lenient reading: only a line that holds `false` drops its row."""
    return ~F.coalesce(F.contains(value, F.lit("false")), F.lit(False))
