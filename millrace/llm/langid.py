"""Language identification by words first, then ever shorter character n-grams.

The model holds, for each language, frequencies of its commonest words and of its commonest n-grams. A word that any
language knows is scored by its word frequencies; another one by n-grams: at each place the longest known one, from
LONGEST characters down to one.

Units are kept by a 64-bit hash, and of each only the languages that know it: what a task holds grows with the entries
(languages x WORDS), not with words x languages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_rows, unused

#: Labelled documents of each language to learn from at most; commonest words, and n-grams of each length, that are kept
#: for each language; longest n-gram.
SAMPLE, WORDS, GRAMS, LONGEST = 5_000, 20_000, 4_000, 4
#: What a unit counts in a language that has not shown it; log frequency of a place where not even one character is known.
UNSEEN, UNKNOWN = 0.1, -12.0
#: Words of a text that count in full for the certainty of its score.
CERTAIN = 8
#: Longer words are not remembered; places in a word, and units of a text, that are added up at once.
LONG, PLACES, TOGETHER = 200, 4096, 20_000
#: Numbers for words, and n-grams, that a task remembers at most; units of a model that it finds by a dictionary.
CACHED, INDEXED = 1_000_000, 1_000_000
UND = "und"

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def grams_of(word: str, n: int) -> Iterator[str]:
    word = f"_{word}_"
    return (word[i : i + n] for i in range(len(word) - n + 1))


def key_of(unit: str, size: int) -> int:
    """Hash of a word (size 0) or of an n-gram."""
    # seeds that differ in all their bits: of short units, near ones would only flip a few of the hash's input
    return xxhash.xxh3_64_intdigest(unit, seed=size * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Model:
    """Log frequencies by language, of words (size 0) and of n-grams by their length. Unit i, with the hash keys[i], has
    base[sizes[i]] + gains in the languages langs_of[starts[i] : starts[i + 1]], and base[sizes[i]] in all others. The last
    unit, without a hash, stands for a place where nothing is known."""

    langs: tuple[str, ...]
    keys: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray
    langs_of: np.ndarray
    gains: np.ndarray
    base: np.ndarray

    def sums(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Weighted sum of the log frequencies of the units at these places, by language."""
        first, n = self.starts[at], self.starts[at + 1] - self.starts[at]
        flat = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        by_size = np.bincount(self.sizes[at], weights, len(self.base))
        return by_size @ self.base + np.bincount(self.langs_of[flat], self.gains[flat] * np.repeat(weights, n), self.base.shape[1])


def model(langs: tuple[str, ...], lang: np.ndarray, size: np.ndarray, key: np.ndarray, n: np.ndarray) -> Model:
    """The model of counts n of (language number, size, hash)."""
    order = np.lexsort((lang, key))
    lang, size, key, n = lang[order].astype(np.int32), size[order], key[order], n[order].astype(np.float64)
    keys, starts = np.unique(key, return_index=True)
    sizes = np.append(size[starts], LONGEST + 1).astype(np.int8)
    known = np.bincount(sizes, minlength=LONGEST + 2)
    totals = np.stack([np.bincount(lang[size == s], n[size == s], len(langs)) + UNSEEN * max(1, known[s]) for s in range(LONGEST + 1)])
    base = np.concatenate([np.log(UNSEEN) - np.log(totals), np.full((1, len(langs)), UNKNOWN)])
    return Model(langs, keys, sizes, np.concatenate([starts, [len(key)] * 2]), lang, (np.log(n + UNSEEN) - np.log(UNSEEN)).astype(np.float32), base)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sampled(df: DataFrame, text_col: str, lang_col: str, sample: int) -> DataFrame:
    """text, lang of `sample` labelled rows of each language, all rows of one that has no more. Rows are drawn one by one,
    whatever they hold, so that copies of a text, or rows that share an id, are neither all in nor all out."""
    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.monotonically_increasing_id().alias("row")).where("lang is not null and text is not null")
    rows = rows.withColumn("draw", F.xxhash64("row"))
    large = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > sample)
    # most rows go before any of them moves: so many more than are wanted stay that fewer never do
    share = F.pmod("draw", F.lit(1 << 40)) / F.lit(1 << 40)
    enough = sample + 10 * int(sample**0.5) + 100
    few = rows.join(F.broadcast(large), "lang", "left").where(F.col("n").isNull() | (share * F.col("n") < enough))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "row"))
    return few.withColumn("place", place).where(F.col("place") <= sample).select("text", "lang")


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from a bounded sample of the labelled rows of df: of each language at most `sample` of them, and all rows of a
    language that has no more.

    Rows with a null language or no word don't count; repeated rows count each. Units are counted on the executors; the
    driver gets at most WORDS words and GRAMS n-grams of each length for each language, the commonest, ties by hash. Of an
    empty table, or one without labels, comes a model without languages."""

    def make():
        def work(b):
            words: dict[str, Counter] = {}
            for text, lang in zip(b["text"], b["lang"]):
                words.setdefault(lang, Counter()).update(words_of(text))
            out: dict[str, list] = {"lang": [], "size": [], "key": [], "n": []}
            for lang, counts in words.items():
                grams = [Counter() for _ in range(LONGEST)]
                for word, times in counts.items():
                    for size, counter in enumerate(grams, 1):
                        for gram in grams_of(word, size):
                            counter[gram] += times
                for size, counter in enumerate([counts, *grams]):
                    out["lang"] += [lang] * len(counter)
                    out["size"] += [size] * len(counter)
                    out["key"].append(np.array([key_of(u, size) for u in counter], np.uint64).view(np.int64))
                    out["n"] += counter.values()
            out["key"] = np.concatenate(out["key"])
            return out

        return work

    rows = sampled(df, text_col, lang_col, sample)
    counted = map_rows(rows, make, "lang string, size int, key long, n long").groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "key"))
    top = counted.withColumn("place", place).where(F.col("place") <= F.when(F.col("size") == 0, WORDS).otherwise(GRAMS)).drop("place").toArrow()
    langs = tuple(sorted(set(top["lang"].unique().to_pylist())))
    size, key, n = (top[c].to_numpy() for c in ("size", "key", "n"))
    coded = top["lang"].combine_chunks().dictionary_encode() if top.num_rows else None
    lang = np.array([langs.index(v) for v in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()] if top.num_rows else np.zeros(0, np.int64)
    return model(langs, lang, size, key.view(np.uint64), n)


class Scorer:
    """Predicts by a model. The units that words and n-grams stand for are remembered within bounds."""

    def __init__(self, model: Model):
        self.model, self.nothing = model, len(model.keys)
        # a dictionary where it stays small, else a search in the sorted hashes
        self.index = dict(zip(model.keys.tolist(), range(self.nothing))) if self.nothing <= INDEXED else None
        self.words: dict[str, tuple[int, ...]] = {}
        self.grams: dict[str, int] = {}
        self.room = CACHED

    def find(self, unit: str, size: int) -> int:
        """Place of a unit, -1 for an unknown one."""
        key = key_of(unit, size)
        if self.index is not None:
            return self.index.get(key, -1)
        at = int(np.searchsorted(self.model.keys, np.uint64(key)))
        return at if at < self.nothing and int(self.model.keys[at]) == key else -1

    def units_of(self, word: str) -> Iterator[tuple[int, ...]]:
        """The units that an unknown word stands for, in pieces: at each place the longest n-gram there that is known."""
        padded, seen, out = f"_{word}_", self.grams, []
        for i in range(len(padded)):
            for size in range(min(LONGEST, len(padded) - i), 0, -1):
                gram = padded[i : i + size]
                at = seen.get(gram)
                if at is None:
                    if len(seen) >= CACHED:
                        seen.clear()
                    at = seen[gram] = self.find(gram, size)
                if at >= 0:
                    break
            out.append(at if at >= 0 else self.nothing)
            if len(out) == PLACES:
                yield tuple(out)
                out = []
        if out:
            yield tuple(out)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share of likelihood; `und` and 0 for a text without letters. Ties go to the first
        language in alphabetical order."""
        counts = Counter(words_of(text))
        if not self.model.langs or not any(c.isalpha() for word in counts for c in word):
            return UND, 0.0
        total, n = np.zeros(len(self.model.langs)), sum(counts.values())
        at: list[int] = []
        weights: list[float] = []
        for word, times in counts.items():
            units = self.words.get(word)
            if units is None and (place := self.find(word, 0)) >= 0:
                units = (place,)
            elif units is None and len(word) > LONG:
                for part in self.units_of(word):
                    total += self.model.sums(np.array(part), np.full(len(part), times / (len(word) + 2)))
                continue
            elif units is None:
                (units,) = self.units_of(word)
            if len(word) <= LONG and word not in self.words:
                self.room -= len(units) + 1
                if self.room < 0:
                    self.words.clear()
                    self.room = CACHED
                self.words[word] = units
            at += units
            weights += [times / len(units)] * len(units)
            if len(at) >= TOGETHER:
                total += self.model.sums(np.array(at), np.array(weights))
                at, weights = [], []
        if at:
            total += self.model.sums(np.array(at), np.array(weights))
        mean = total / n
        best = int(mean.argmax())
        share = 1 / np.exp((mean - mean[best]) * min(n, CERTAIN)).sum()
        return self.model.langs[best], float(share)


@lru_cache(1)
def _scorer(sent) -> Scorer:
    """One for each Python worker and model, so that tasks share what is remembered."""
    return Scorer(sent.value)


def predict(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The `keep` columns with the predicted language and score, named by `out`, of every row; only the text decides.

    Null, empty and letterless texts get `und` and 0; with a model of no language all do. Ties go to the first language
    in alphabetical order; repeated rows are each returned, an empty table stays empty."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    text = unused("text", [*keep, *out])

    def make():
        scorer = _scorer(sent)

        def work(b):
            found = [scorer.predict(t) for t in b[text]]
            return {out[0]: [f[0] for f in found], out[1]: [f[1] for f in found]}

        return work

    return map_rows(df.select(*keep, F.col(text_col).alias(text)), make, f"`{out[0]}` string, `{out[1]}` double", keep=keep)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learnt from those that are not held out.

    Null, empty and letterless texts get `und`; a null id is not held out; repeated rows are each returned."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    out = predict(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
