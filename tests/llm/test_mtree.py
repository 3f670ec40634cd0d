"""Exact top-k search against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mtree, queries


def plain(rows, asks, k):
    """(query_id, rank, vec_id, score) of rows (id, vector), in integers of Python."""
    sound = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v in sound]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n), default=0)
    sound = [r for r in sound if len(r[1]) == d]
    out = []
    for n, (i, q) in enumerate(sound):
        if asks(i):
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), j) for m, (j, v) in enumerate(sound) if m != n)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({c: F.lit(1) for c in ("page", "far", "row", "score", "asks", "v", "least")})


def test_whole_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = queries.op12_topk(spark, data)
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.dtypes[-1][1] == "bigint"
    assert found(df) == plain(rows, lambda i: i % 100 == 0, 10)


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_through_the_tree(spark, spread):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + spread * rng.normal(size=8)).tolist()) for i in range(3000)]
    df = mtree.search(frame(spark, rows), F.col("vec_id") % 50 == 0, page_rows=60)
    assert found(df) == plain([(i, np.float32(v).tolist()) for i, v in rows], lambda i: i % 50 == 0, 10)


def test_bounds_pass_pages_over():
    rng = np.random.default_rng(5)
    centres = 1000 * rng.normal(size=(20, 8))
    x = np.floor(centres[np.arange(4000) % 20] + rng.normal(size=(4000, 8)))
    tree = mtree.grow(x[:800], 40)
    page, far = tree.path(x)
    tree.cover({int(p): (int((page == p).sum()), far[page == p].max()) for p in np.unique(page)})
    assert tree.rows[0] == 4000
    visited = []
    for q in x[:20]:
        score = x @ q
        least = np.sort(score)[-10]
        pages = [p for p, _ in tree.search(q, least)]
        assert set(page[score >= least]) <= set(pages)
        bounds = [b for _, b in tree.search(q)]
        assert bounds == sorted(bounds, reverse=True)
        visited.append(len(pages))
    assert np.mean(visited) < 0.3 * len(np.unique(page))


def test_edges(spark):
    rng = random.Random(1)
    inf, nan = math.inf, math.nan
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(40)]
    # nulls, odd components, other lengths, zero vectors, ids that come twice, ties
    rows += [(100, None), (101, [1.0, None, 0.0]), (102, [inf, 0.0, 0.0]), (103, [nan, 0.0, 0.0]), (104, []), (105, [1.0]), (None, [1.0, 1.0, 1.0]), (110, [0.0] * 3), (10, [0.5, 0.5, 0.5]), (10, [0.5, 0.5, 0.5]), (-10, [1.0, 1.0, 1.0])]
    assert found(mtree.search(frame(spark, rows), F.col("vec_id") % 10 == 0, k=4)) == plain(rows, lambda i: i % 10 == 0, 4)
    assert found(mtree.search(frame(spark, rows[:3]), F.col("vec_id") == 0)) == plain(rows[:3], lambda i: i == 0, 10)
    assert found(mtree.search(frame(spark, []), F.lit(True))) == []
    assert found(mtree.search(frame(spark, rows), F.lit(None).cast("boolean"))) == []


def test_numbers_beyond_doubles(spark):
    rows = [(i, [1e4 + i / 7, -1e6 - i, 3.0]) for i in range(30)] + [(99, [1e30, 1e30, 1.0]), (100, [-1e30, 1e30, 1.0])]
    assert found(mtree.search(frame(spark, rows, "double"), F.col("vec_id") % 10 == 0, k=5)) == plain(rows, lambda i: i % 10 == 0, 5)
