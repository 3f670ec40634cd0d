import hashlib
import random
from functools import lru_cache

import public_tokenizers
import pytest
import tiktoken
from helpers import corpus, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(1)
def library():
    return tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture
def known():
    return library()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aaabcdeThe  \n\t\r'sltré漢😀́٣ 09!.- ​\x1c\x85"), max_size=80))
def test_encoding_is_that_of_the_library(text):
    ids = bpe.codec(PATH).encode(text).tolist()
    assert ids == library().encode_ordinary(text)
    assert bpe.codec(PATH).decode(ids) == text


def test_long_pieces(known):
    rng = random.Random(2)
    for text in ("a" * 3000, "".join(rng.choice("abcdefgh") for _ in range(4000)), " " * 500 + "x", "é" * 700):
        assert bpe.codec(PATH).encode(text).tolist() == known.encode_ordinary(text)


def test_edits_of_a_prefix_table():
    rng = random.Random(3)
    model = bpe.codec(PATH).bpe
    for _ in range(40):
        data = bytes(rng.choices(b"abcde the ", k=rng.randrange(400)))
        table = bpe.PrefixTable(model, data)
        for _ in range(4):
            i = rng.randrange(len(data) + 1)
            j = min(len(data), i + rng.randrange(6))
            new = bytes(rng.choices(b"abcth", k=rng.randrange(6)))
            data = data[:i] + new + data[j:]
            table.replace(i, j, new)
            more = bytes(rng.choices(b"the ", k=3))
            data += more
            table.append(more)
            assert table.data == data and table.last == model.fill(data, [-1])
        assert b"".join(model.tokens[i] for i in table.ids()) == data


def test_an_edit_is_local():
    table = bpe.PrefixTable(bpe.codec(PATH).bpe, b"the quick brown fox jumps over the lazy dog " * 200)
    assert table.replace(50, 51, b"x") < 2000


def test_operator(spark, known):
    rows = corpus()
    df = documents(spark, [*rows, rows[0]])
    got = bpe.digest_documents(df, PATH).collect()
    texts = dict(rows)
    assert len(got) == len(rows) + 1
    for r in got:
        ids = known.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    coded = bpe.encode_documents(df, PATH)
    assert {r["doc_id"]: r["text"] for r in bpe.decode_documents(coded, PATH).collect()} == {k: v or "" for k, v in texts.items()}
    assert bpe.digest_documents(documents(spark, []), PATH).count() == 0
