"""Words of whole texts as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker remembers at most.
CACHED = 150_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = h
        return h


_hashes = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    """Matches of `[^\\x20\\x09-\\x0D]+`; bytes.split() cuts at just these six characters."""
    return text.encode().split() if text else []


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of x."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, length: int, starts: np.ndarray | None = None, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of `length` words, of those at `starts` if given."""
    if starts is None:
        starts = np.arange(max(0, len(hashes) - length + 1))
    out = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            out = out * np.uint64(base) + hashes[starts + k]
    return mixed(out)
