import random
from collections import Counter

import corpus_pipeline
import duckdb
from helpers import corpus, documents, sentence
from pyspark.sql import functions as F
from test_near import brute as near_groups

from millrace.llm import pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    texts = [sentence(rng, 120) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, texts[0].upper()), (101, texts[1].replace(texts[1].split()[60], "zzz", 1)), (102, None), (103, "12 34"), (104, texts[2] + " mail bob@example.com"), (105, texts[3])]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs, sizes = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns and columns[:5] == COLUMNS
        sizes.append(sorted(r["doc_id"] for r in docs.collect()))
    live = [(i, t) for i, t in rows if i not in (102, 103)]
    assert sizes[0] == [i for i, _ in live]
    # the largest id of equal texts stays, then the smallest of each group of similar ones
    after_exact = [(i, t) for i, t in live if i not in (0, 3)]
    assert sizes[1] == [i for i, _ in after_exact]
    groups = near_groups(after_exact, 5, 80)
    assert sizes[2] == sorted({c for _, c in groups.values()}) and 101 not in sizes[2]
    assert sizes[3] == sizes[2]
    final = {r["doc_id"]: r for r in docs.collect()}
    assert not any(pii.detect(r["text"]) for r in final.values()) and all(r["n_chars"] == len(r["text"]) for r in final.values())
    one = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in one.collect()} == set(final)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda df: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(whole) == key(one)


def test_rows_that_share_ids(spark):
    """What a stage drops is a row, judged by its text, whatever its id; one of repeated rows stays."""
    rng = random.Random(2)
    long, other = sentence(rng, 100), sentence(rng, 100)
    changed = " ".join(["zzz", *long.split()[1:]])
    rows = [(5, "alpha beta"), (9, "ALPHA beta"), (5, "a wholly different text"), (7, "twice"), (7, "twice"), (None, "twice"), (None, "no id"), (None, "NO id"), (3, ""), (4, None)]
    left = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.exact_dedup(spark, documents(spark, rows), "").collect())
    assert left == Counter({(9, "ALPHA beta"): 1, (5, "a wholly different text"): 1, (7, "twice"): 1, (4, None): 1}) + Counter(k for k in left if k[1] and k[1].lower() == "no id")
    assert sum(n for (_, t), n in left.items() if t and t.lower() == "no id") == 1
    rows = [(5, long), (2, changed), (5, other), (2, "short one"), (2, "short one"), (None, changed + " end"), (8, None), (8, ""), (8, None)]
    left = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect())
    assert left == Counter({(2, changed): 1, (5, other): 1, (2, "short one"): 1, (8, None): 2, (8, ""): 1})
    masked = corpus_pipeline.personal_data(spark, documents(spark, [(1, "bob@example.com"), (1, "bob@example.com"), (2, None), (None, "")]), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["lang_pred"], r["score"]) for r in masked) == [(0, "", "p", 8), (1, "[EMAIL]", "p", 8), (1, "[EMAIL]", "p", 8), (2, "", "p", 8)]
    packed = corpus_pipeline.pack(spark, documents(spark, [(1, "one two"), (1, "one two"), (2, None)]), "").collect()
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == 3


def test_exact_dedup_against_sql(spark, tmp_path):
    docs = documents(spark, [*corpus(seed=8, n=60), (None, "short"), (None, "only without an id"), (7, "sHort É"), (8, "short é")])
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    left = corpus_pipeline.exact_dedup(spark, spark.read.parquet(str(tmp_path / "d")), "")
    want = duckdb.sql(
        f"""SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        ORDER BY doc_id DESC NULLS LAST) AS r FROM '{tmp_path}/d/*.parquet') WHERE r = 1"""
    ).fetchall()
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(want)


def test_empty_tables(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_contract(spark, data):
    import __spark_entry__ as entry

    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_without_labels(spark, tmp_path):
    docs = documents(spark, [(1, "some text"), (2, None)], clash=False).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, docs, "").count() == 2
