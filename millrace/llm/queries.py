"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import align, ann, bpe, exact, htmltext, langid, mtree, near, packing, pii, sharding, substring, turns
from .common import table


def op1_byte_bpe(spark, sf_dir):
    return bpe.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op2_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents", deal=False))


def op3_substring_dedup(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op4_near_dedup(spark, sf_dir):
    return near.near_components(table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long")), size=3, percent=85)


def op7_html_text(spark, sf_dir):
    return htmltext.extract_pages(table(spark, sf_dir, "pages"))


def op8_ann(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_pii(spark, sf_dir):
    return pii.digest_spans(table(spark, sf_dir, "documents"))


def op10_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents", deal=False))


def op11_alignment(spark, sf_dir):
    return align.align_documents(table(spark, sf_dir, "documents"))


def op12_topk(spark, sf_dir):
    return mtree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_turns(spark, sf_dir):
    return turns.audit_damaged(table(spark, sf_dir, "conversations", deal=False))


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_packing, op3_substring_dedup, op4_near_dedup, op5_langid, op6_exact_dedup, op7_html_text, op8_ann, op9_pii, op10_sharding, op11_alignment, op12_topk, op13_turns)}

ORACLE_SQL = {
    "op6_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n""",
    "op12_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
}
