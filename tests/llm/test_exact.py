import hashlib
from collections import Counter

from helpers import corpus, documents

from millrace.llm import exact

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_operator(spark):
    rows = corpus(seed=3, n=80) + [(7001 + i, "HOT Text É") for i in range(2500)] + [(9901, "hot text é")]
    norm = {i: (t or "").translate(LOWER) for i, t in rows}
    keep, sizes = {}, Counter(norm.values())
    for i, t in norm.items():
        keep[t] = max(i, keep.get(t, -1))
    got = exact.exact_groups(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = norm[r["doc_id"]]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep[t], sizes[t], keep[t] == r["doc_id"], hashlib.sha256(t.encode()).hexdigest())


def test_null_ids_and_repeats(spark):
    got = exact.exact_groups(documents(spark, [(None, "a"), (None, "A"), (1, "b"), (1, "b"), (None, "b")])).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in got) == [(0, 0, 2, True), (0, 0, 2, True), (0, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True)]
    assert exact.exact_groups(documents(spark, [])).count() == 0


def test_plan_has_no_python(spark, data):
    plan = exact.exact_groups(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_directory_doubles_where_it_must():
    buckets = exact.split({0: 50, 1: 50, 12: 10}, 60, bits=4)
    assert buckets == [(0, 4), (1, 4), (2, 3), (4, 2), (8, 1)]
    depth, entries = exact.directory(buckets, 4)
    assert depth == 4 and entries == [0, 1, 2, 2, 3, 3, 3, 3] + [4] * 8
    assert exact.directory(exact.split({}, 5, 3), 3) == (0, [0])
    # what can't be told apart at full depth stays together, however full
    assert exact.directory(exact.split({5: 1000}, 1, 3), 3) == (3, [0, 0, 0, 0, 1, 2, 3, 3])


def test_rows_are_found_through_directory_bucket_and_chain(spark, monkeypatch):
    # a poor hash makes chains of different texts
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: (exact.F.length(c[0]) if c[0] == "text" else exact.F.hash(*c).cast("long")) * (1 << 56) if len(c) == 1 else exact.F.hash(*c).cast("long"))
    rows = [(i, "abcd"[i % 4] * (1 + i % 7)) for i in range(400)]
    got = exact.exact_groups(documents(spark, rows), capacity=2).collect()
    sizes = Counter(t for _, t in rows)
    keep = {t: max(i for i, u in rows if u == t) for t in sizes}
    of = dict(rows)
    assert len(got) == 400 and all((r["keep_id"], r["group_size"]) == (keep[of[r["doc_id"]]], sizes[of[r["doc_id"]]]) for r in got)


def test_depth_follows_the_table():
    depths = [exact.depth_for(n, 16) for n in (0, 100, 10_000, 10**6, 10**9)]
    assert depths == sorted(depths) and depths[0] == exact.SHALLOW and depths[-1] == exact.DEEP and 16 * 2 ** depths[2] >= 10_000


def test_buckets_have_owners_and_bounds(spark):
    rows = documents(spark, [(i, f"text {i}") for i in range(300)] + [(1000 + i, "copy") for i in range(300)])
    keyed = rows.select(exact.F.col("doc_id").alias("id"), exact.normalised(exact.F.col("text")).alias("text")).withColumn("hash", exact.F.xxhash64("text"))
    keys = keyed.select("id", "hash", exact.F.sha2("text", 256).alias("digest"))
    index = exact.Index(keyed, keys, capacity=20)
    full = Counter(r["bucket"] for r in index.entries.collect())
    parts = index.entries.groupBy(exact.F.spark_partition_id().alias("p")).agg(exact.F.min("bucket").alias("a"), exact.F.max("bucket").alias("b")).orderBy("a").collect()
    # owners have ranges of buckets, and so of hashes
    assert all(x["b"] < y["a"] for x, y in zip(parts, parts[1:]))
    assert sum(full.values()) == 301 and max(full.values()) <= 20 and len(full) >= 16 and 2**index.depth == len(index.buckets)
