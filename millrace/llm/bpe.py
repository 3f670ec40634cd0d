"""Byte-level BPE by prefix dynamic programming.

For a byte string s, let last[i] be the last token of the encoding of s[:i]. It is unique, and the encoding of s[:i]
is that of s[:i - len(last[i])] followed by last[i]; a token t that ends at i is last[i] exactly when it may follow
last[i - len(t)]. So one table of last tokens encodes all prefixes at once: bytes can be appended without looking back
further than the longest token, and after an edit the table is only recomputed until it falls into step again.

Two tokens may stand side by side when encoding their joined bytes gives the two again. That is decided on the merge
trees: a merge over the border happens when the tokens at the border, at some time both alive, have a merge whose rank
comes before the merges that swallow them.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from math import inf

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from .common import map_rows

#: Words, prefixes and pairs of tokens that a codec remembers at most (words in each of two generations); bounds of memory only.
CACHED_WORDS, CACHED_PREFIXES, CACHED_PAIRS = 300_000, 400_000, 200_000
#: Longest piece whose prefixes are kept; longer ones get a table of their own.
SHORT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PrefixBPE:
    """The dynamic programme over the bytes of one piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = dict(zip(ranks.values(), ranks.keys()))
        self.longest = max(map(len, ranks))
        self._spines: dict[int, tuple[list[int], list[int]] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._prefixes: dict[bytes, tuple[int, bytes]] = {}
        self._packed = {i: i.to_bytes(4, "little") for i in self.tokens}

    def _spine(self, token: int) -> tuple[list[int], list[int]] | None:
        """Tokens at the left and at the right edge of a token while it is merged, first to last; None if merges never build it."""
        if token in self._spines:
            return self._spines[token]
        data, ranks = self.tokens[token], self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(parts) == 1:
            found = ([token], [token])
        else:
            while len(parts) > 2:
                rank, at = min((ranks.get(parts[i] + parts[i + 1], inf), i) for i in range(len(parts) - 1))
                if rank >= token:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = None
            if len(parts) == 2:
                left, right = self._spine(ranks[parts[0]]), self._spine(ranks[parts[1]])
                found = ([*left[0], token], [*right[1], token])
        self._spines[token] = found
        return found

    def may_follow(self, first: int, second: int) -> bool:
        known = self._pairs.get((first, second))
        if known is not None:
            return known
        if len(self._pairs) >= CACHED_PAIRS:
            self._pairs.clear()
        ok = self._pairs[first, second] = self._borders(first, second)
        return ok

    def _borders(self, first: int, second: int) -> bool:
        one, two = self._spine(first), self._spine(second)
        if one is None or two is None:
            return False
        ends, starts, i, j = one[1], two[0], 0, 0
        while True:
            next_end = ends[i + 1] if i + 1 < len(ends) else inf
            next_start = starts[j + 1] if j + 1 < len(starts) else inf
            merged = self.ranks.get(self.tokens[ends[i]] + self.tokens[starts[j]], inf)
            # of equal merges the leftmost goes first: one that ends before the border wins, one that starts behind it loses
            if merged < next_end and merged <= next_start:
                return False
            if next_end is inf and next_start is inf:
                return True
            if next_end <= next_start:
                i += 1
            else:
                j += 1

    def last_token(self, data: bytes, last: list[int], i: int) -> int:
        """The last token of data[:i]; last holds those of the shorter prefixes, from 1."""
        get = self.ranks.get
        for start in range(max(0, i - self.longest), i):
            token = get(data[start:i])
            if token is not None and (self.may_follow(last[start], token) if start else self._spine(token) is not None):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def fill(self, data: bytes, last: list[int]) -> list[int]:
        for i in range(len(last), len(data) + 1):
            last.append(self.last_token(data, last, i))
        return last

    def walk(self, last: list[int]) -> list[int]:
        ids, i = [], len(last) - 1
        while i > 0:
            ids.append(last[i])
            i -= len(self.tokens[last[i]])
        return ids[::-1]

    def _prefix(self, data: bytes) -> tuple[int, bytes]:
        """Last token and packed ids of a short byte string; only the prefixes that its last tokens ask for are looked at."""
        known = self._prefixes.get(data)
        if known is not None:
            return known
        get = self.ranks.get
        for start in range(len(data)):
            token = get(data[start:])
            if token is None:
                continue
            if start:
                before, ids = self._prefix(data[:start])
                if not self.may_follow(before, token):
                    continue
            elif self._spine(token) is None:
                continue
            else:
                ids = b""
            if len(self._prefixes) >= CACHED_PREFIXES:
                self._prefixes.clear()
            found = self._prefixes[data] = (token, ids + self._packed[token])
            return found
        raise ValueError("the vocabulary lacks a byte")

    def encode_packed(self, data: bytes) -> bytes:
        """Ids of one piece, as merging by ranks gives them, as little-endian 32-bit integers; a piece that is itself a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return self._packed[whole]
        if len(data) <= SHORT:
            return self._prefix(data)[1]
        return np.array(self.walk(self.fill(data, [-1])), "<u4").tobytes()

    def encode(self, data: bytes) -> list[int]:
        return np.frombuffer(self.encode_packed(data), "<u4").tolist()


class PrefixTable:
    """Bytes with the last token of each prefix: append(), replace() and ids() without encoding all anew."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data = bpe, data
        self.last = bpe.fill(data, [-1])

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.fill(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put new in place of data[start:stop]; returns how many prefixes were recomputed."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, same = old[: start + 1], 0
        for i in range(start + 1, len(self.data) + 1):
            self.last.append(self.bpe.last_token(self.data, self.last, i))
            behind = i - (start + len(new))
            same = same + 1 if behind > 0 and self.last[i] == old[i - shift] else 0
            if same >= self.bpe.longest and behind >= 2 * self.bpe.longest:
                self.last += old[i - shift + 1 :]
                return i - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.bpe.walk(self.last) if self.data else []


#: White space as the pattern has it: U+001C to U+001F, which re counts too, only make the cut more careful.
_TWO_SPACES = re.compile(r"\s\s").search
_LONE_SPACE = re.compile(r"(?<!\s) (?!\s)").split


#: Signs that end words; behind letters, a row of them is one match of the pattern.
_SIGNS = ".,;:!?%&*#$)"


class _Words(dict):
    """Word, that follows a space, -> packed ids of both; two generations, so that memory stays bounded."""

    def __init__(self, bpe: PrefixBPE, split):
        super().__init__()
        self.bpe, self.split, self.old = bpe, split, {}

    def encode(self, part: str) -> bytes:
        return b"".join([self.bpe.encode_packed(piece.encode()) for piece in self.split(part)])

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            # str.isalpha() is true of letters alone, as \p{L} is
            letters = word.rstrip(_SIGNS)
            if letters.isalpha():
                ids = self.bpe.encode_packed(b" " + letters.encode())
                if len(letters) < len(word):
                    ids += self.bpe.encode_packed(word[len(letters) :].encode())
            else:
                ids = self.encode(" " + word)
        if len(word) <= SHORT:
            if len(self) >= CACHED_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Text to ids and back. Texts are split by public_tokenizers.PATTERN, and every match is encoded by itself. None counts as empty."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int] | None = None):
        self.bpe = PrefixBPE(ranks)
        self.words = _Words(self.bpe, regex.compile(public_tokenizers.PATTERN).findall)
        self.bytes_of = [self.bpe.tokens.get(i, b"") for i in range(max(self.bpe.tokens) + 1)]
        self.special = special or {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut and any(s in text for s in self.special):
            return b"".join(self.special[part].to_bytes(4, "little") if part in self.special else self._plain(part) for part in self.cut(text) if part)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        """No match of the pattern crosses a space that has no white space at either side, and none looks past its end
        but over white space; so the text can be cut before each such space, and each part is matched by itself."""
        if _TWO_SPACES(text) is None:
            first, *rest = text.split(" ")
        else:
            first, *rest = _LONE_SPACE(text)
        return self.words.encode(first) + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode(errors="replace")


@lru_cache(2)
def codec(path: str, special: tuple[tuple[str, int], ...] = ()) -> Codec:
    """One codec for each Python worker and vocabulary file."""
    return Codec(read_ranks(path), special=dict(special))


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, ids array<int>) for each row of df; null and empty texts have no ids, repeated rows stay repeated."""

    def make():
        c = codec(path)
        return lambda b: {id_col: b[id_col], "ids": [c.encode(t).astype("i4") for t in b[text_col]]}

    return map_rows(df.select(id_col, text_col), make, f"{id_col} {df.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row (id, text) for each row of df; bytes that are no UTF-8 become U+FFFD; null ids give an empty text."""

    def make():
        c = codec(path)
        return lambda b: {id_col: b[id_col], "text": [c.decode(i or ()) for i in b[ids_col]]}

    return map_rows(df.select(id_col, ids_col), make, f"{id_col} {df.schema[id_col].dataType.simpleString()}, text string")


def digest_documents(df: DataFrame, path: str) -> DataFrame:
    """Encode, decode again, and return doc_id, n_tokens, ids_sha256 and decoded_sha256; nothing but digests leaves the worker.

    Null and empty texts have no tokens; repeated rows are each returned; an empty table stays empty; extra columns are not
    looked at."""

    def make():
        c = codec(path)
        names = [str(i) for i in range(len(c.bytes_of))]

        def work(b):
            out = {"doc_id": b["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in b["text"]:
                ids = c.encode(text).tolist()
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(c.decode_bytes(ids)).hexdigest())
            return out

        return work

    return map_rows(df.select("doc_id", "text"), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
