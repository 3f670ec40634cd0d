import zlib
from collections import Counter

import numpy as np
from helpers import corpus, documents
from hypothesis import given
from hypothesis import strategies as st

from millrace.llm import sharding


@given(st.integers(1, 3000), st.integers(0, 50))
def test_permutation(n, seed):
    rows = np.arange(n)
    placed = sharding.permute(rows, n, seed)
    assert sorted(placed.tolist()) == rows.tolist()
    assert (sharding.permute(placed, n, seed, back=True) == rows).all()
    shard, slot = sharding.locate(rows, n, 24, seed)
    assert (sharding.row_at(shard, slot, n, 24, seed) == rows).all()


def test_shuffles():
    placed = sharding.permute(np.arange(10000), 10000, 1)
    assert abs(np.corrcoef(np.arange(10000), placed)[0, 1]) < 0.05


def test_operator(spark):
    rows = corpus(seed=6) + [(i, "same") for i in range(5000, 5300)] + [(None, None), (None, "same")]
    docs = documents(spark, rows)
    got = sharding.shard_documents(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    texts = dict(rows)
    for r in got:
        if r["doc_id"] is not None:
            data = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["law"] == "rows" and r["grown_shard"] is None
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    sizes = [len(slots.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    key = lambda x: sorted((r["doc_id"], r["shard"], r["slot"]) for r in x if r["doc_id"] is not None)
    assert key(got) == key(sharding.shard_documents(docs.repartition(7)).collect())
    assert sharding.shard_documents(documents(spark, [])).count() == 0
