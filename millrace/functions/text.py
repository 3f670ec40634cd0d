"""Scalar text functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def python_strip(text: Column) -> Column:
    """Strip what Python's str.strip() strips: Unicode white space and U+001C to U+001F."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def lid_normalise(text: Column) -> Column:
    """Text as word-based language identifiers want it: one line, lower case, runs of white space as one space, and
    afterwards no punctuation, symbols or digits (so that two spaces may be left where a number stood)."""
    one_line = F.lower(python_strip(F.replace(text, F.lit("\n"), F.lit(" "))))
    return F.regexp_replace(F.regexp_replace(one_line, r"(?U)\s\s+", " "), r"(?U)[^\w\p{Zs}]|\d", "")


def one_line(text: Column, strip: bool = False) -> Column:
    """Line breaks as spaces and nothing else; the other identifiers' normalisation."""
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    return python_strip(flat) if strip else flat


def has_text(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def bare_label(label: Column, everywhere: bool = False) -> Column:
    """A predicted label without its prefix; `everywhere` takes out all occurrences."""
    return F.regexp_replace(label, "__label__" if everywhere else "^__label__", "")


def rounded_probability(p: Column) -> Column:
    """Four decimals, halves to even."""
    return F.bround(p, 4)


def length_class(text: Column) -> Column:
    n = F.coalesce(F.length(text), F.lit(0))
    return F.when(n == 0, "0").when(n == 1, "1").otherwise(">1")


def line_count(text: Column) -> Column:
    """Line breaks plus one, so an empty or null text has one line."""
    whole = F.coalesce(text, F.lit(""))
    return (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long")


def decoded_base64(text: Column) -> Column:
    return F.decode(F.unbase64(text), "UTF-8")


def language_of(code: Column) -> Column:
    """`eng` of `eng_Latn`."""
    return F.split_part(code, F.lit("_"), F.lit(1))


def crawl_infix(crawl: Column) -> Column:
    """Short name of the crawl family: ab for `archivebot` itself, ia for names that begin with `wide`, cc for others and null."""
    return F.when(crawl == "archivebot", "ab").when(F.startswith(crawl, F.lit("wide")), "ia").otherwise("cc")


def wds_bin(score: Column, scale: int = 1) -> Column:
    """Quality bin 0..10 of a score on a scale of 0..1, or of 0..10 (cut toward zero there)."""
    return F.floor(score * 10).cast("int") if scale == 1 else score.cast("int")


def file_stem(path: Column, suffix: str = ".zst") -> Column:
    """File name without folders and suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), suffix.replace(".", r"\.") + "$", "")
