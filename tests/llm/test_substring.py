import hashlib
import re

import numpy as np
from helpers import corpus, documents, sentence

from millrace.llm import substring


def brute(rows):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first, out = {}, {}
    for i in sorted(words):
        w = words[i]
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), i) < i:
                gone[k : k + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept))
    return out


def test_cover():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))
    assert substring.cover_positions(45).tolist() == [1, 5, 11, 24, 25]
    assert len(substring.cover_positions(0)) == 0


def test_operator(spark):
    import random

    rows = corpus(seed=7, n=80)
    # a passage of exactly 50 words, and one of 49, at all relative places
    rng = random.Random(1)
    fifty = sentence(rng, 50).split()
    for shift in range(33):
        rows.append((1000 + shift, " ".join(f"u{shift}-{k}" for k in range(shift)) + " " + " ".join(fifty) + f" end{shift}"))
        rows.append((2000 + shift, " ".join(f"w{shift}-{k}" for k in range(shift)) + " " + " ".join(fifty[:49])))
    expected = brute(rows)
    got = substring.remove_repeats(documents(spark, [*rows, rows[3], (None, rows[0][1]), (None, None)])).collect()
    assert len(got) == len(rows) + 3
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
            continue
        n, removed, digest, kept = expected[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, removed, digest)
        assert r["kept_text"] is None if not removed else r["kept_text"] == kept
    assert sum(e[1] > 0 for e in expected.values()) > 40


def test_empty(spark):
    assert substring.remove_repeats(documents(spark, [])).count() == 0
    only = substring.remove_repeats(documents(spark, [(1, None), (2, "")])).collect()
    assert all((r["n_words"], r["n_removed"], r["kept_sha256"]) == (0, 0, hashlib.sha256(b"").hexdigest()) for r in only)


def test_runs():
    assert np.flatnonzero(substring._runs(np.array([-2, 3]), 4, 6)).tolist() == [0, 1, 3, 4, 5]
