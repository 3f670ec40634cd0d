"""The chains of operators that make a corpus: pages to text and language, augmented records, release."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.html import html_records
from millrace.functions.ids import add_ids
from millrace.functions.lid import LanguageModel, with_language
from millrace.functions.xml2md import xml_to_markdown
from millrace.operators.joins import annotate, duplicate_ids, skip_ids
from millrace.operators.quality import with_score
from millrace.operators.route import routed
from millrace.operators.shard import greedy_shards


def pages_to_text(pages: DataFrame, model: Callable[[], LanguageModel], html: str = "h", limit: float | None = 10.0) -> DataFrame:
    """Stage 2: pages without `html`, with t, x, htmllang, metalang, tagfilter, traferr, lang and prob."""
    out = pages.withColumn("__page", html_records(limit=limit)(F.col(html))).select(*(c for c in pages.columns if c != html), "__page.*")
    return with_language(out, model, text="t")


def augment(text: DataFrame, models: dict[str, Callable[[], LanguageModel]], allowed: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Stage 3: records that robots allow, with id, text, xml, md, and a column for each language identifier.

    text: f, u, ts, t, x, and whatever else is to stay. allowed: id and mask of some of them."""
    out = add_ids(text)
    if allowed is not None:
        masks = allowed.select(key, F.lit(True).alias("__there"), F.col("allowed").alias("__allowed"))
        out = out.join(masks, key, "left").where(F.col("__there").isNull() | F.coalesce("__allowed", F.lit(False))).drop("__there", "__allowed")
    out = out.withColumnsRenamed({"t": "text", "x": "xml"}).withColumn("md", xml_to_markdown("xml")["md"])
    for identity, model in models.items():
        out = with_language(out, model, identity)
    return out


def release(docs: DataFrame, size: int, key: str = "id", annotations: dict[str, DataFrame] | None = None) -> DataFrame:
    """Release: no copy of ids that occur twice, annotated, routed, and dealt to shards by route and bin, best first.

    Whole rows move once, into the order in which they are written; shard numbers are folded over sizes alone. Rows with a
    null id stay: they are no copies of each other."""
    kept = with_score(skip_ids(docs, duplicate_ids(docs, key), key))
    if annotations:
        kept = annotate(kept, annotations, key)
    out = routed(kept).withColumn("__n", F.octet_length("text"))
    columns = [c for c in out.columns if c != "__n"]
    return greedy_shards(out, ["route", "wds_bin"], [("wds", False), (key, False)], columns, "__n", size).select(*columns, "shard")
