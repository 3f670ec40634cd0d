"""Cross-tokenizer alignment against a walk along both token lists."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import corpus, documents
from tokenizers import Tokenizer

from millrace.llm import align, queries


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def letters():
    """Bytes by the letters that stand for them in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


def groups_of(text, libraries):
    """[(ids of a, ids of b)] of each group."""
    byte_of = letters()
    if not text:
        return []
    a, b = libraries[0].encode(" " + text, add_special_tokens=False), libraries[1].encode(text)
    bytes_a = [bytes(byte_of[c] for c in t) for t in a.tokens]
    bytes_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(libraries[1].id_to_piece, b)]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    out, left, right, i, j, end_a, end_b = [], [], [], 0, 0, 0, 0
    while i < len(bytes_a) or j < len(bytes_b):
        if end_a <= end_b and i < len(bytes_a):
            end_a += len(bytes_a[i])
            left.append(a.ids[i])
            i += 1
        else:
            end_b += len(bytes_b[j])
            right.append(b[j])
            j += 1
        if end_a == end_b:
            out.append((left, right))
            left, right = [], []
    return out


def plain(rows, libraries):
    groups = [groups_of(t, libraries) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    documents_ = Counter(p for link in links for p in link)
    highest = {}
    for (a, _), n in documents_.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for (doc_id, _), g, link in zip(rows, groups, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        best = sum(n for p, n in link.items() if documents_[p] == highest[p[0]])
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(link.values()), best, sum(n * documents_[p] for p, n in link.items()), hashlib.sha256(spelled.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


EDGES = [(None, "null id"), (None, None), (-1, ""), (-2, "x" * 3000), (-3, "<s> <unk> <|endoftext|> </s> hello \n\n\t  世界 é"), (-4, "a\x00b"), (-5, "▁ not a space"), (-6, "  two   spaces "), (-7, "<0x41>"), (-8, "🙂🙃 ﬁ Å"), (-9, " "), (5, "repeated row"), (5, "repeated row")]


@pytest.mark.parametrize("sent", [align.SENT_PAIRS, 40, 0])
def test_against_a_walk(spark, libraries, sent):
    rows = corpus() + EDGES
    assert found(align.align_documents(documents(spark, rows), sent_pairs=sent)) == plain(rows, libraries)


def test_whole_table(spark, data, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    df = queries.op11_alignment(spark, data)
    assert df.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert found(df) == plain(rows, libraries)


def test_empty_table(spark):
    assert align.align_documents(documents(spark, [])).collect() == []


def test_pairs_of_large_groups():
    rng = random.Random(3)
    for most in (1, 7, 50, 1 << 20):
        lengths = [np.array([rng.randrange(1, 5) for _ in range(60)]) for _ in range(2)]
        ends = [np.cumsum(n) for n in lengths]
        last = max(e[-1] for e in ends)
        ends = [np.append(e, last + 1) for e in ends]
        ids = [np.array([rng.randrange(9) for _ in e]) for e in ends]
        x = align.align(ids[0], ends[0], ids[1], ends[1])
        wanted = Counter(int(a) * 100 + int(b) for a, g in zip(x.a, x.group_a) for b, h in zip(x.b, x.group_b) if g == h)
        codes, times = align.linked_pairs(x, 100, most)
        assert dict(zip(codes.tolist(), times.tolist())) == wanted and (np.diff(codes) > 0).all() and x.links() == sum(wanted.values())


def test_overlaps_are_those_of_ranges(spark, libraries):
    rows = [(1, "Unbelievable tokenisation of naïve words"), (2, None), (3, "▁")]
    for r in align.align_tokens(documents(spark, rows)).select("doc_id", "overlaps").collect():
        groups = groups_of(dict(rows)[r["doc_id"]], libraries)
        assert len({o["group"] for o in r["overlaps"]}) == len(groups)
        assert [o["start"] for o in r["overlaps"]][1:] == [o["end"] for o in r["overlaps"]][:-1]
        if groups:
            assert max(o["a"] for o in r["overlaps"]) + 1 == sum(len(a) for a, _ in groups)
            assert max(o["b"] for o in r["overlaps"]) + 1 == sum(len(b) for _, b in groups)
