"""Language identification with a pluggable model: normalise, predict the best three, clean labels, round, wrap."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .text import has_text, lid_normalise, one_line

LABELS = T.StructType([T.StructField("lang", T.ArrayType(T.StringType())), T.StructField("prob", T.ArrayType(T.DoubleType()))])
PREFIX = "__label__"


class LanguageModel(Protocol):
    """A model may also have predict_all(texts, k), for many texts at once."""

    def predict(self, text: str, k: int) -> tuple[list[str], list[float]]: ...


#: Labelled texts of each language that are learnt from at most; places that n-grams are hashed to; characters of an n-gram, at
#: least and at most; characters of texts that are looked at together, and features that are added up together.
SAMPLE, BUCKETS, LEAST, MOST, TOGETHER, ADDED = 5_000, 1 << 16, 3, 3, 1 << 20, 1 << 18
#: What an n-gram counts that a language has not shown; how sharply scores tell languages apart.
UNSEEN, SHARP = 0.05, 8.0


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of each n-gram, LEAST to MOST characters, of all texts, one text after another; number of each text's). A text
    has a space at either end and is in lower case; n-grams don't reach into the next one."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(p) for p in padded], np.int64)
    last = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(codes))
    mixed, kept = np.zeros(len(codes), np.uint64), []
    with np.errstate(over="ignore"):
        for n in range(1, MOST + 1):
            mixed[: len(codes) - n + 1] = (mixed[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            if n >= LEAST:
                kept.append(np.where(at + n <= last, (mixed >> np.uint64(40)) % np.uint64(BUCKETS), BUCKETS))
    places = np.stack(kept, 1).ravel().astype(np.int64)
    there = places < BUCKETS
    each = np.add.reduceat(there, np.concatenate([[0], np.cumsum(lengths)[:-1]]) * len(kept)) if len(texts) else np.empty(0, np.int64)
    return places[there], each.astype(np.int64)


class LinearModel:
    """A weight for each place of an n-gram and each language; a text's scores are the mean of its n-grams' weights, and its
    probabilities their softmax. Places that no text has shown count alike for all."""

    def __init__(self, counts: np.ndarray, langs: list[str]):
        """counts: [BUCKETS, languages], of n-grams in what was learnt from."""
        totals = counts.sum(0, keepdims=True) + UNSEEN * BUCKETS
        self.weights, self.langs = np.log((counts + UNSEEN) / totals).astype(np.float32) if langs else np.zeros((BUCKETS, 0), np.float32), langs

    def predict(self, text: str, k: int) -> tuple[list[str], list[float]]:
        return self.predict_all([text], k)[0]

    def predict_all(self, texts: list[str], k: int) -> list[tuple[list[str], list[float]]]:
        """The k likeliest languages of each text, and their probabilities; ties in alphabetical order."""
        if not texts or not self.langs:
            return [([], []) for _ in texts]
        means = np.empty((len(texts), len(self.langs)))
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) < TOGETHER):
                size += len(texts[stop])
                stop += 1
            means[start:stop] = self._means(texts[start:stop])
            start = stop
        shares = np.exp(SHARP * (means - means.max(1, keepdims=True)))
        shares /= shares.sum(1, keepdims=True)
        order = np.argsort(-shares, 1, kind="stable")[:, :k]
        names = np.array([PREFIX + lang for lang in self.langs], object)
        return list(zip(names[order].tolist(), np.take_along_axis(shares, order, 1).tolist()))

    def _means(self, texts: list[str]) -> np.ndarray:
        places, each = features(texts)
        sums = np.zeros((len(texts), len(self.langs)))
        ends = np.cumsum(each)
        for start in range(0, len(places), ADDED):
            stop = min(start + ADDED, len(places))
            # the texts that this run of n-grams belongs to
            first, last = np.searchsorted(ends, [start, stop - 1], "right")
            cuts = np.concatenate([[start], ends[first:last]]) - start
            sums[first : last + 1] += np.add.reduceat(self.weights[places[start:stop]], cuts, 0, dtype=np.float64)
        return sums / np.maximum(each, 1)[:, None]


def sampled(df: DataFrame, text: str, lang: str, sample: int) -> DataFrame:
    """text, lang of `sample` labelled rows with text of each language, all rows of one that has no more. Rows are drawn one by
    one, whatever they hold, so that copies are neither all in nor all out."""
    rows = df.where(F.col(lang).isNotNull() & has_text(F.col(text))).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("draw", F.xxhash64("row"))
    # of over `sample` rows each, so that these languages are few beside the rows: sent, as texts must not be brought together by them
    large = F.broadcast(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > sample))
    # most rows go before any of them moves: so many more than are wanted stay that fewer never do
    share = F.pmod("draw", F.lit(1 << 40)) / F.lit(1 << 40)
    some = rows.join(large, "lang", "left").where(F.col("n").isNull() | (share * F.col("n") < sample + 10 * int(sample**0.5) + 100))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "row"))
    return some.withColumn("place", place).where(F.col("place") <= sample).select("text", "lang")


def fit_linear(df: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> LinearModel:
    """Learns hashed n-grams from at most `sample` texts of each language, all of one that has no more. Executors count them,
    a task its own texts first; the driver gets at most BUCKETS numbers for each language. Without any label, a model that
    knows no language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, len(texts), 256):
                places, each = features(texts[start : start + 256])
                names, of = np.unique(np.array(langs[start : start + 256], object).astype(str), return_inverse=True)
                for i, name in enumerate(names.tolist()):
                    mine = np.bincount(places[np.repeat(of == i, each)], minlength=BUCKETS)
                    seen[name] = seen[name] + mine if name in seen else mine
        for name, counts in seen.items():
            there = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(there), pa.string()), pa.array(there, pa.int64()), pa.array(counts[there], pa.int64())], names=["lang", "place", "n"])

    counted = sampled(df, text, lang, sample).mapInArrow(run, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(langs)))
    if langs:
        number = {lang: i for i, lang in enumerate(langs)}
        counts[found.column("place").to_numpy(), [number[v] for v in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    return LinearModel(counts, langs)


#: Fixed value: where a record's text shows a language that is not the only label.
LABELLED = r'"openlid-v3": ?\{"lang": ?\["([a-z]{3}_[A-Z][a-z]{3})",'


def labelled_language(line: Column) -> Column:
    """First language of a JSON line's identification, found in its text without parsing it; null where there is none, or
    no second one."""
    found = F.regexp_extract(line, LABELLED, 1)
    return F.when(found != "", found)


def model_file(identity: str) -> str | None:
    """`<identity>.bin` beside this file, in $MILLRACE_CACHE, or in ~/.cache/millrace."""
    places = (os.path.dirname(__file__), os.environ.get("MILLRACE_CACHE", ""), os.path.expanduser("~/.cache/millrace"))
    return next((path for place in places if place and os.path.exists(path := os.path.join(place, f"{identity}.bin"))), None)


def binary_model(identity: str) -> Callable[[], LanguageModel]:
    """Loader of a fastText model file, where that library is installed."""

    def make():
        import fasttext

        model = fasttext.load_model(model_file(identity))

        class Loaded:
            def predict(self, text, k):
                labels, probs = model.predict(text=text, k=k, threshold=0.0, on_unicode_error="strict")
                return list(labels), [float(p) for p in probs]

        return Loaded()

    return make


def identify(text: Column, make: Callable[[], LanguageModel], identity: str | None = None, k: int = 3) -> Column:
    """struct(lang array, prob array) of the k likeliest languages; null or empty texts have null in both.

    Word-based identifiers (no identity, or one named openlid) see normalised text, others one line of it."""

    @F.pandas_udf(LABELS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make()
        for texts in batches:
            some = [t for t in texts if t is not None]
            known = iter(model.predict_all(some, k) if hasattr(model, "predict_all") else [model.predict(t, k) for t in some])
            rows = [(None, None) if t is None else next(known) for t in texts]
            labels = [None if names is None else [n.removeprefix(PREFIX) for n in names] for names, _ in rows]
            probs = [None if p is None else [round(float(x), 4) for x in p] for _, p in rows]
            yield pd.DataFrame({"lang": labels, "prob": probs}, dtype=object)

    ready = lid_normalise(text) if identity is None or "openlid" in identity else one_line(text)
    return run(F.when(has_text(text), ready))


def with_language(df: DataFrame, make: Callable[[], LanguageModel], identity: str | None = None, text: str = "text") -> DataFrame:
    """df with a struct column named after the identity, or with lang and prob if there is none."""
    if identity:
        return df.withColumn(identity.replace("-", "_"), identify(F.col(text), make, identity))
    found = df.withColumn("__lid", identify(F.col(text), make))
    return found.withColumns({"lang": F.col("__lid.lang"), "prob": F.col("__lid.prob")}).drop("__lid")
