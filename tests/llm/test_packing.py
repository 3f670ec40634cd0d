import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import corpus, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=20))
def test_plan_holds_all(counts):
    plan = packing.plan_sequences(counts, 64)
    held = defaultdict(int)
    for number, items in plan:
        assert sum(n * c for n, c in items) <= 64
        assert sum(c for n, c in items if 3 * n > 64) <= 2
        for n, c in items:
            held[n] += number * c
    assert dict(held) == {n: c for n, c in counts.items() if c}


def test_plan_is_good():
    rng = random.Random(1)
    counts = defaultdict(int)
    for _ in range(5000):
        counts[min(1024, max(1, int(rng.lognormvariate(5.5, 1))))] += 1
    made = sum(n for n, _ in packing.plan_sequences(counts, 1024))
    least = -(-sum(n * c for n, c in counts.items()) // 1024)
    assert made <= 1.01 * least + 1
    assert len(packing.runs_of(packing.plan_sequences(counts, 1024))) < 20_000


def test_operator(spark):
    rows = corpus(seed=4)
    got = packing.pack_documents(documents(spark, [*rows, rows[0], (9999, "a <|endoftext|> b")])).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict([*rows, (9999, "a <|endoftext|> b")])
    pieces, places = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, mine in pieces.items():
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2], "<u4")
        mine = sorted(mine, key=lambda r: (r["piece"], r["offset"], r["sequence_id"]))[:: 2 if doc == rows[0][0] else 1]
        starts = [r["start"] for r in mine]
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert starts[0] == 0 and sum(r["length"] for r in mine) == len(ids)
        assert all(r["length"] == 1024 for r in mine[1:])
        for r in mine:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(documents(spark, [])).count() == 0
