"""URL and domain filters, and what is published of a corpus."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import language_of


def url_blocklist(url: Column, domains: list[str]) -> Column:
    """Whether a URL is on one of the domains, as crawl-time filters ask: optional scheme and slashes, then the domain."""
    names = "|".join(re.escape(d) + "/" for d in domains)
    return F.coalesce(url.rlike(rf"^(https?:)?(//)?({names})"), F.lit(False))


def drop_domains(df: DataFrame, lang: str, blocked: dict[str, list[str]], url: str = "u") -> DataFrame:
    """Documents of one language without those whose URL contains a blocked domain; ValueError for another language."""
    if lang not in blocked:
        raise ValueError(f"no domains are configured for {lang}")
    hit = F.lit(False)
    for domain in blocked[lang]:
        hit = hit | F.contains(F.col(url), F.lit(domain))
    return df.where(~F.coalesce(hit, F.lit(False)))


def shard_maps(files: DataFrame, prefix: str, lang: str = "lang", file: str = "file") -> DataFrame:
    """lang, map: for each language the URLs of its files, one a line, sorted."""
    urls = F.concat(F.lit(prefix), F.col(lang), F.lit("/"), F.col(file))
    return files.groupBy(lang).agg(F.array_join(F.array_sort(F.collect_list(urls)), "\n").alias("map"))


def languages(df: DataFrame, code: str = "name") -> DataFrame:
    """Distinct language parts of codes, sorted."""
    return df.select(language_of(F.col(code)).alias("language")).distinct().orderBy("language")


CARD_SUMS = ("bytes", "documents", "segments", "tokens", "characters")


def card_table(manifest: DataFrame) -> DataFrame:
    """The manifest's rows by language and a last row with their sums, numbers with thousands separators."""
    total = manifest.agg(F.lit("total").alias("name"), *(F.sum(c).cast("long").alias(c) for c in CARD_SUMS)).withColumn("__last", F.lit(1))
    rows = manifest.select("name", *CARD_SUMS).withColumn("__last", F.lit(0)).union(total.select("name", *CARD_SUMS, "__last"))
    return rows.orderBy("__last", "name").select("name", *(F.format_number(c, 0).alias(c) for c in CARD_SUMS))


def dataset_card(manifest: DataFrame, template: str) -> str:
    """The template with {{table}}, {{languages}} and {{maps}} filled in. A manifest has one row for each language."""
    head = "| " + " | ".join(("name", *CARD_SUMS)) + " |\n|" + "---|" * (1 + len(CARD_SUMS))
    body = "\n".join("| " + " | ".join(str(v) for v in row) + " |" for row in card_table(manifest).collect())
    names = "\n".join(f"- {r['language']}" for r in languages(manifest).collect())
    maps = "\n".join(f"- [{r['name']}]({r['map']})" for r in manifest.select("name", "map").orderBy("name").collect())
    return template.replace("{{table}}", f"{head}\n{body}").replace("{{languages}}", names).replace("{{maps}}", maps)
