"""The corpus pipeline: language ID, exact dedup, near-dedup, PII, packing, each stage over all that the one before kept.

Stages that drop documents decide by row, not by doc_id, so that rows that share an id by mistake are judged each by its
own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact, langid, near, packing, pii
from millrace.llm.common import settle, table, unused, with_rows, without_ids


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters; a missing lang is filled with the prediction. Learnt from the labelled documents.

    Null, empty and letterless texts get `und` and go; repeated rows are judged each. With no labelled document at all
    nothing can be predicted, and every document stays."""
    model = langid.fit(docs)
    if not model.langs:
        return docs
    found, score = unused("found", docs.columns), unused("score", docs.columns)
    judged = langid.predict(docs, model, keep=tuple(docs.columns), out=(found, score))
    lang = F.coalesce("lang", found).alias("lang")
    return judged.where(F.col(found) != langid.UND).select(*(lang if c == "lang" else F.col(f"`{c}`") for c in docs.columns))


def _told_apart(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """docs with a row number, stored; (id, text) of them, where an id orders by doc_id, then row, null ids last; its name."""
    row = unused("__row", docs.columns)
    numbered = with_rows(docs, row)
    missing = F.col("doc_id").isNull()
    key = F.struct(missing.alias("missing"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col(row).alias("row"))
    return numbered, numbered.select(key.alias("doc_id"), "text"), row


def _without(numbered: DataFrame, dropped: DataFrame, row: str) -> DataFrame:
    return without_ids(numbered, dropped.select(F.col("doc_id.row").alias(row)), row).drop(row)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z, the one with the largest doc_id; of several such rows, one.

    Null and empty texts are equal; rows with a null id stay only where no equal text has an id, and then one of them."""
    numbered, rows, row = _told_apart(docs)
    # the operator keeps the largest id: null ids have to come first here
    turned = rows.select(F.struct((~F.col("doc_id.missing")).alias("there"), F.col("doc_id.id").alias("id"), F.col("doc_id.row").alias("row")).alias("doc_id"), "text")
    return _without(numbered, exact.exact_groups(turned).where("not kept"), row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one with the smallest doc_id; of several rows
    with it, one. Null ids count as larger than others. Texts without words are linked with nothing and stay."""
    numbered, rows, row = _told_apart(docs)
    return _without(numbered, near.near_components(rows, size=5, percent=80).where("not kept"), row)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked by its kind, also in disguise; n_chars follows. Null and empty texts stay so."""
    return pii.mask_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all token pieces; a null or empty text is one of one
    id, and rows that share a doc_id each have their own."""
    return packing.pack_documents(docs)


STAGES = [("language ID", language), ("exact dedup", exact_dedup), ("near-dedup", near_dedup), ("PII", personal_data), ("packing", pack)]
#: Language ID, near-dedup, PII and packing can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table; every stage's result is stored, as the next reads it several times."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
