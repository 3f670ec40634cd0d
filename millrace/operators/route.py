"""Routing of scored documents into blocked, noisy and clean, and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import crawl_infix, wds_bin

# Filter reasons that name the noise, and the fields that a document must have.
REASONS = ("adult_ut1", "adult_text", "length", "word_avg", "char_avg", "lang_ratio")
REQUIRED = ("filter", "doc_scores", "openlid_v3", "glotlid_v3")
LEAST_SCORE, LEAST_PROB = 0.5, 0.5


def compatible(openlid: Column, glotlid: Column) -> Column:
    """Same language and script, or same language where one says Hans or Hant and the other Hani. Null is incompatible."""
    part = lambda c, i: F.split_part(c, F.lit("_"), F.lit(i))
    han = (part(openlid, 1) == part(glotlid, 1)) & part(openlid, 2).isin("Hans", "Hant") & (part(glotlid, 2) == "Hani")
    return F.coalesce((openlid == glotlid) | han, F.lit(False))


def complete(df: DataFrame) -> Column:
    """Whether a row has all required fields. A field counts as there unless its column is missing or it is null: tables
    don't tell an absent field from a null one, and no rule could read either."""
    there = F.lit(True)
    for name in REQUIRED:
        there = there & (F.col(name).isNotNull() if name in df.columns else F.lit(False))
    return there


def judged(df: DataFrame, scale: int = 1) -> DataFrame:
    """df with route, noise, wds_bin and, if there is a crawl_id, infix. The first rule counts. Rows that lack a required
    field have a null route. Without a score, language or probability (empty arrays) no rule on it can hold but that of
    languages: what is unknown is incompatible."""
    if not set(REQUIRED) <= set(df.columns):
        return df.withColumns({"route": F.lit(None).cast("string"), "noise": F.lit(None).cast("string"), "wds_bin": F.lit(None).cast("int")})
    first = lambda c: F.get(c, F.lit(0))
    score, openlid, glotlid, reason = first(F.col("doc_scores")), F.col("openlid_v3"), F.col("glotlid_v3"), F.col("filter")
    rules: list[tuple[Column, str, Column]] = [
        (reason == "optout", "blocked", F.lit(None).cast("string")),
        (score < LEAST_SCORE, "noisy", F.lit("wds")),
        (~compatible(first(openlid["lang"]), first(glotlid["lang"])), "noisy", F.lit("lid")),
        (first(openlid["prob"]) < LEAST_PROB, "noisy", F.lit("prob")),
        *((F.startswith(reason, F.lit(r)), "noisy", F.lit(r)) for r in REASONS),
        (reason != "keep", "noisy", reason),
    ]
    route, noise = F.lit("clean"), F.lit(None).cast("string")
    for when, name, why in reversed(rules):
        route, noise = F.when(when, name).otherwise(route), F.when(when, why).otherwise(noise)
    ok = complete(df)
    out = df.withColumns({"route": F.when(ok, route), "noise": F.when(ok, noise), "wds_bin": wds_bin(score, scale)})
    return out.withColumn("infix", crawl_infix(F.col("crawl_id"))) if "crawl_id" in df.columns else out


def routed(df: DataFrame, scale: int = 1) -> DataFrame:
    """The rows of judged() that have all required fields; filter_statistics() counts the others as `invalid`."""
    return judged(df, scale).where(F.col("route").isNotNull())


def counted_as(noise: Column) -> Column:
    """The name under which a noisy document is counted: its reason, or `filter` for one that is not among them."""
    return F.when(noise.isin("wds", "lid", "prob", *REASONS), noise).when(noise.isNotNull(), "filter")


def route_statistics(df: DataFrame, by: str = "file") -> DataFrame:
    """Documents and characters by route and noise, for each value of `by` and in total (null)."""
    rows = df.select(by, "route", counted_as(F.col("noise")).alias("noise"), F.length("text").alias("n"))
    sets = [[by, "route", "noise"], ["route", "noise"]]
    return rows.groupingSets(sets, by, "route", "noise").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("characters"))


PARTS = ("skipped", "blocked", "noisy", "clean")
NOISE = ("wds", "lid", "prob", *REASONS, "filter")


def filter_statistics(df: DataFrame, annotations: tuple[str, ...] = (), by: str = "file", skipped: str = "skipped") -> DataFrame:
    """One row for each value of `by` and one of sums (null), which also has the number of files.

    df: rows of judged() with a boolean `skipped`, and the annotation columns. Columns: files, documents, characters,
    annotations (those found), invalid (rows without a required field, which count nowhere else), <part>_documents and
    <part>_characters for skipped, blocked, noisy, clean and noisy_<reason>, missing_<annotation>. Skipped rows are
    counted as such alone, and their annotations are not looked at. A null text has no characters."""
    part = F.when(F.col(skipped), "skipped").otherwise(F.col("route"))
    noise = F.when(part == "noisy", counted_as(F.col("noise")))
    rows = df.select(by, part.alias("__part"), noise.alias("__noise"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("__n"), (~F.col(skipped)).alias("__read"), *(F.col(f"`{a}`").isNotNull().alias(a) for a in annotations))
    both = lambda name, cond: [F.count_if(cond).alias(f"{name}_documents"), F.coalesce(F.sum(F.when(cond, F.col("__n"))), F.lit(0)).alias(f"{name}_characters")]
    known = F.col("__part").isNotNull()
    sums = [
        F.count_if(known).alias("documents"),
        F.coalesce(F.sum(F.when(known, F.col("__n"))), F.lit(0)).alias("characters"),
        F.count_if(~known).alias("invalid"),
        sum((F.count_if(F.col("__read") & F.col(f"`{a}`")) for a in annotations), F.lit(0).cast("long")).alias("annotations"),
        *(c for p in PARTS for c in both(p, F.col("__part") == p)),
        *(c for r in NOISE for c in both(f"noisy_{r}", F.col("__noise") == r)),
        *(F.count_if(F.col("__read") & ~F.col(f"`{a}`")).alias(f"missing_{a}") for a in annotations),
    ]
    files = rows.groupBy(by).agg(*sums)
    total = files.agg(F.lit(None).cast(df.schema[by].dataType).alias(by), *(F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in files.columns[1:]), F.count(F.lit(1)).alias("files"))
    return files.withColumn("files", F.lit(None).cast("long")).unionByName(total)


def filter_json(stats: DataFrame, annotations: tuple[str, ...] = (), by: str = "file") -> DataFrame:
    """by, statistics: filter_statistics() as one JSON object for each file and for the total (null)."""
    two = lambda name: [F.col(f"{name}_documents").alias("documents"), F.col(f"{name}_characters").alias("characters")]
    noisy = F.struct(*two("noisy"), *(F.struct(*two(f"noisy_{r}")).alias(r) for r in NOISE)).alias("noisy")
    missing = [F.struct(*(F.col(f"`missing_{a}`").alias(a) for a in annotations)).alias("missing")] if annotations else []
    fields = ["documents", "characters", "annotations", "files", *(noisy if p == "noisy" else F.struct(*two(p)).alias(p) for p in PARTS), *missing]
    return stats.select(by, F.to_json(F.struct(*fields)).alias("statistics"))


def statistics_json(stats: DataFrame, by: str = "file") -> DataFrame:
    """One JSON object for each value of `by`, total first: {route[.noise]: {documents, characters}}."""
    name = F.concat_ws(".", "route", "noise")
    entry = F.struct(name.alias("key"), F.struct("documents", "characters").alias("value"))
    return stats.groupBy(by).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("statistics")).orderBy(F.col(by).asc_nulls_first())
