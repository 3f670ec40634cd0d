"""Projections of open records: specification, selection, fan-out to several outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import updated


@dataclass(frozen=True)
class Spec:
    """Fields to take if present, new names for old ones, and whether to start from all fields."""

    fields: tuple[str, ...]
    rename: tuple[tuple[str, str], ...]
    every: bool


def parse_spec(text: str) -> Spec:
    """`name`, `*` and `new=old`, separated by commas. ValueError for none, or a name that is missing at either side of =."""
    parts = [p.strip() for p in text.split(",") if p.strip()]
    if not parts:
        raise ValueError("no fields")
    fields, rename = [], []
    for part in parts:
        new, sign, old = (x.strip() for x in part.partition("="))
        if sign:
            if not new or not old:
                raise ValueError(f"incomplete renaming: {part!r}")
            rename.append((new, old))
        elif part != "*":
            fields.append(part)
    return Spec(tuple(fields), tuple(dict(rename).items()), "*" in parts)


def project(rec: Column, spec: Spec) -> Column:
    """A record (map<string, variant>) by a specification: absent fields stay absent; a renaming copies, so with `*` the
    old name stays too."""
    wanted = F.map_filter(rec, lambda k, _: k.isin(list(spec.fields)) if spec.fields else F.lit(False))
    out = rec if spec.every else wanted
    for new, old in spec.rename:
        out = updated(out, _renamed(rec, old, new))
    return out


def _renamed(rec: Column, old: str, new: str) -> Column:
    """The one entry of a field, under a new name; empty if it is absent."""
    return F.transform_keys(F.map_filter(rec, lambda k, v: k == old), lambda k, v: F.lit(new))


def typed_projection(columns: list[str], spec: Spec) -> list[Column]:
    """The same over a table's columns, where all are present in every row."""
    taken = [F.col(f"`{c}`") for c in columns if spec.every or c in spec.fields]
    return taken + [F.col(f"`{old}`").alias(new) for new, old in spec.rename if old in columns]


def _outputs(specs: list[tuple[str, Spec]], together: bool) -> list[tuple[str, Spec]]:
    """Of an output that is named twice the later specification counts, unless both do."""
    return specs if together else list(dict(specs).items())


def fan_out(records: DataFrame, specs: list[tuple[str, Spec]], together: bool = False) -> dict[str, DataFrame]:
    """Output name -> JSON lines. Of an output that is named twice the later specification counts; together: it gets the
    records of both. Each output is read by itself; to write all in one pass, see sinks.write_fan_out()."""
    out: dict[str, DataFrame] = {}
    for name, spec in _outputs(specs, together):
        lines = records.select(F.to_json(project(F.col("rec"), spec)).alias("value"))
        out[name] = out[name].union(lines) if name in out else lines
    return out


def fanned(records: DataFrame, specs: list[tuple[str, Spec]], together: bool = False) -> DataFrame:
    """output, value: the JSON lines of all outputs from one pass over the records, those of a record one after another."""
    lines = [F.struct(F.lit(name).alias("output"), F.to_json(project(F.col("rec"), spec)).alias("value")) for name, spec in _outputs(specs, together)]
    return records.select(F.explode(F.array(*lines)).alias("__line")).select("__line.output", "__line.value")


def pool_record(df: DataFrame) -> dict[str, DataFrame]:
    """Stage records normalised and split into text, markup (xml, md) and metadata (the rest).

    A missing xml or md is null. Without an md, xml is converted, but neither a null nor an empty one is."""
    names = {"t": "text", "x": "xml", "htmllang": "html_lang"}
    for old, new in names.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    for name in ("text", "xml"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    if "md" not in df.columns:
        from millrace.functions.xml2md import xml_to_markdown

        df = df.withColumn("md", xml_to_markdown(F.when(F.col("xml") != "", F.col("xml")))["md"])
    if "lang" in df.columns:
        wrapped_ = [c for c in ("lang", "prob") if c in df.columns]
        df = df.withColumn("openlid_v2", F.struct(*wrapped_)).drop(*wrapped_)
    return {"text": df.select("id", "text"), "markup": df.select("id", "xml", "md"), "metadata": df.drop("text", "xml", "md")}


def wrapped(df: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """All columns but `keep` as one struct."""
    return df.select(*keep, F.struct(*(c for c in df.columns if c not in keep)).alias(name))


def field_text(value: Column) -> Column:
    """A field as text: strings as they are, null as `null`, all else as compact JSON."""
    return F.coalesce(value.cast("string"), F.lit("null"))
