import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        s = np.add.accumulate(x * x[ids == q][0], axis=1)[:, -1]
        s = np.where(ids == q, -np.inf, s)
        order = np.lexsort((ids, -s))[: min(k, (ids != q).sum())]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def frame(spark, ids, vectors):
    return spark.createDataFrame([(i, v) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>").selectExpr("*", "'l' AS leaf", "1 AS q", "'r' AS rank")


@pytest.mark.parametrize("n, spread", [(20_000, 0.4), (3000, 1.0), (900, 0.05), (10, 1.0)])
def test_recall(spark, n, spread, monkeypatch):
    """The largest case has 20 leaves and more, of which queries visit a part; its hot leaf is cut into blocks."""
    visited = []
    calibrate = ann.calibrate
    monkeypatch.setattr(ann, "calibrate", lambda *a: visited.append((len(a[3].leaves), calibrate(*a))) or visited[-1][1])
    monkeypatch.setattr(ann, "BLOCK_ROWS", 500)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 200)
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(9, 16))
    x = (centres[rng.integers(0, 9, n)] + spread * rng.normal(size=(n, 16))).astype(np.float32)
    x[n // 2 : n // 2 + n // 4] = x[0]  # a hot group of equal vectors
    ids = np.arange(n)
    got = {}
    for r in ann.search(frame(spark, ids.tolist(), x.tolist()), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    truth = brute(ids, x.astype(np.float64), ids[ids % 20 == 0], 20)
    assert set(got) == set(truth)
    hits = total = 0
    for q, mine in got.items():
        mine.sort()
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(truth[q])
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len({m[1] for m in mine} & {t[0] for t in truth[q]})
        total += len(truth[q])
        exact = dict(truth[q])
        assert all(exact.get(m[1], m[2]) == m[2] for m in mine)
    assert hits >= 0.9 * total
    assert n < 20_000 or visited[0][0] >= 20 and visited[0][1] < visited[0][0]


def test_odd_vectors(spark):
    good = [[float(i), 1.0, 0.5] for i in range(40)]
    bad = [None, [0.0, 0.0, 0.0], [float("nan"), 1.0, 1.0], [None, 1.0, 1.0], [float("inf"), 1.0, 1.0], [1.0, 2.0], []]
    df = frame(spark, [*range(40), *range(100, 107), None], [*good, *bad, [1.0, 1.0, 1.0]])
    got = ann.search(df, F.col("vec_id") % 20 == 0).collect()
    assert {r["query_id"] for r in got} == {0, 20} and all(r["vec_id"] < 40 for r in got)
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 20), key=lambda r: r["rank"])] == [i for i in range(39, 18, -1) if i != 20]
    assert ann.search(frame(spark, [1], [None]), F.lit(True)).count() == 0
    assert ann.search(frame(spark, [1, 2], [[1.0], [2.0]]), F.lit(False)).count() == 0
    assert ann.search(frame(spark, [1], [[1.0]]), F.lit(True)).count() == 0


def test_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 8))
    tree = ann.fit(x, 20)
    assert 20 <= len(tree.leaves) <= 20 + ann.BRANCH
    assert sorted(tree.visit(x[0])) == list(range(len(tree.leaves)))
    assert len(ann.fit(np.ones((500, 4)), 20).leaves) == 1
