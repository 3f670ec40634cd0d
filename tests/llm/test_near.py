import random

import numpy as np
import pytest
from helpers import corpus, documents, sentence

from millrace.llm import near

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, size):
    out = {}
    for i, t in rows:
        w = [x for x in (t or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if x]
        out[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset()
    return out


def brute(rows, size, percent):
    sets = sets_of(rows, size)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def chain(n=12, start=5000, words=160):
    """Each text differs a little from the one before, and much from those far off; and a hub with copies that differ."""
    rng = random.Random(9)
    now = sentence(rng, words).split()
    rows = []
    for k in range(n):
        rows.append((start + k, " ".join(now)))
        at = 12 * k % (words - 4)
        now = [*now[:at], f"c{k}a", f"c{k}b", *now[at + 2 :]]
    hub = sentence(rng, 300).split()
    rows.append((start + 100, " ".join(hub)))
    for k in range(12):
        copy = list(hub)
        for j in range(6):
            copy[(25 * k + 47 * j) % 300] = f"h{k}-{j}"
        rows.append((start + 101 + k, " ".join(copy)))
    return rows


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_operator(spark, size, percent):
    rows = [*corpus(seed=5, n=80), *chain()]
    expected = brute(rows, size, percent)
    got = near.near_components(documents(spark, [*rows, rows[0], (None, "alone with a null id"), (None, None)]), size, percent).collect()
    assert len(got) == len(rows) + 3
    for r in got:
        if r["doc_id"] is None:
            assert r["kept"] and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]], r["doc_id"]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert len({c for _, c in expected.values()}) < len(rows) - 20


def test_hot_keys_and_small_blocks(spark, monkeypatch):
    """One large group of near copies, in buckets that are salted and cut into many blocks."""
    from millrace.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 2)
    monkeypatch.setattr(near, "SKETCH_BLOCK", 4)
    monkeypatch.setattr(near, "BLOCK", 3)
    rng = random.Random(4)
    hub = sentence(rng, 300).split()
    rows = []
    for k in range(30):
        copy = list(hub)
        for j in range(k % 12):
            copy[(25 * k + 47 * j) % 300] = f"h{k}-{j}"
        rows.append((100 + k, " ".join(copy)))
    rows += [(1000 + k, "the same words once more in every row of these") for k in range(20)] + [(2000 + k, None) for k in range(20)]
    expected = brute(rows, 3, 85)
    got = near.near_components(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_hopeful_finds_every_near_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = []
    for k in range(40):
        s = base.copy() if k % 2 else rng.integers(0, 2**63, 400).astype(np.uint64)
        s[: k % 20] = rng.integers(0, 2**63, k % 20).astype(np.uint64)
        sets.append(np.unique(s))
    sketches = np.array([near.odd_sketch(near.minhash(s, 120)) for s in sets]).view(np.uint64)
    labels, n = np.arange(40) // 3, np.array([len(s) for s in sets])
    near_one = np.array([any(labels[i] != labels[j] and len(np.intersect1d(sets[i], sets[j])) >= 0.85 * len(np.union1d(sets[i], sets[j])) for j in range(40)) for i in range(40)])
    for blocks in (np.zeros(40, int), np.arange(40) % 2):
        found = near.hopeful(labels, blocks, n, sketches, 85, near.most_flips(0.85, 120))
        if not blocks.any():
            assert found[near_one].all() and not found[0::2].any()
        else:
            assert not found[0::2].any()


def test_empty(spark):
    assert near.near_components(documents(spark, [])).count() == 0
    got = near.near_components(documents(spark, [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "b c")])).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in got] == [(0, 1), (0, 2), (1, 3), (1, 3), (1, 5)]


def test_sketch_estimates():
    rng = np.random.default_rng(1)
    limit = near.most_flips(0.85, 120)
    for _ in range(200):
        a = rng.integers(0, 2**63, 600).astype(np.uint64)
        b = a.copy()
        b[:48] = rng.integers(0, 2**63, 48).astype(np.uint64)  # similarity 0.852
        x, y = (near.odd_sketch(near.minhash(np.unique(s), 120)).view(np.uint64) for s in (a, b))
        assert int(np.bitwise_count(x ^ y).sum()) <= limit
    far = rng.integers(0, 2**63, 600).astype(np.uint64)
    assert int(np.bitwise_count(near.odd_sketch(near.minhash(far, 120)).view(np.uint64) ^ x).sum()) > limit


def test_components_follow_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 2000)], "a long, b long")
    got = {r["node"]: r["label"] for r in near.components(links).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[2000] == 1000


def test_every_pair_across_components_meets(spark):
    """Buckets of one block, of many, and with or without a large component: all that may be linked meets."""
    rng = random.Random(6)
    rows = [(k, f"{k}-{i}".encode(), rng.choice(labels)) for k, (n, labels) in enumerate([(5, "ab"), (40, "aaab"), (60, "abcdef"), (30, "a"), (25, "aaaaaaab")]) for i in range(n)]
    members = spark.createDataFrame([(k, d, x.encode()) for k, d, x in rows], "key long, digest binary, label binary")
    groups = {}
    for r in near.met_in_blocks(members, None, 8).collect():
        groups.setdefault((r["key"], r["__i"], r["__j"]), []).append((r["__block"], bytes(r["digest"]), bytes(r["label"])))
    together = {(k, frozenset((a[1], b[1]))) for (k, *_), ms in groups.items() for x, a in enumerate(ms) for b in ms[x + 1 :] if a[0] != b[0] or len({m[0] for m in ms}) == 1}
    for k, a, x in rows:
        for j, b, y in rows:
            if k == j and x != y:
                assert (k, frozenset((a, b))) in together
    assert max(map(len, groups.values())) <= 40


def test_copies_are_in_proportion_to_members(spark):
    """A bucket of 100,000 sets in a large component and some small ones, in blocks of 2,000."""
    members = spark.range(100_000).selectExpr("1L AS key", "CAST(CAST(id AS STRING) AS BINARY) AS digest", "CAST(CASE WHEN id % 100 > 0 THEN 'big' ELSE CAST(id % 700 AS STRING) END AS BINARY) AS label")
    met = near.met_in_blocks(members, None, 2000)
    assert met.count() < 2.5 * 100_000
    assert met.groupBy("key", "__i", "__j").count().agg({"count": "max"}).first()[0] < 4000
