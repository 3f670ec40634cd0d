"""Removal of repeated passages, found by difference-cover anchors.

COVER is a perfect difference set modulo PERIOD: any difference of two positions is one of two of its members. So if a
run of WINDOW words starts at i in one document and at j in another, some t < PERIOD has both i + t and j + t at cover
positions, and the ANCHOR = WINDOW - PERIOD + 1 words from there lie inside the run in both. Only anchors at cover
positions, a fifth of all, are hashed. Whatever windows contain an anchor that another document has too are then hashed
in full (128 bits): that is the extension, and exact for any number of documents without making pairs of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, map_rows, salted_join, settle
from .words import hashes_of, windows, words_of

WINDOW, PERIOD = 50, 31
#: A perfect difference set modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1


def cover_positions(n_words: int) -> np.ndarray:
    """Starts of the anchors of a text: cover positions that leave room for an anchor."""
    at = (np.arange(0, n_words, PERIOD)[:, None] + np.array(COVER)).ravel()
    return at[at + ANCHOR <= n_words]


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha256 (of the words joined by spaces), anchors (hashes, in the order of their positions)."""

    def make():
        def work(b):
            out = {"doc_id": b["doc_id"], "n_words": [], "sha256": [], "anchors": []}
            for text in b["text"]:
                words = words_of(text)
                out["n_words"].append(len(words))
                out["sha256"].append(hashlib.sha256(b" ".join(words)).hexdigest())
                found = windows(hashes_of(words), ANCHOR, cover_positions(len(words))) if len(words) >= WINDOW else np.zeros(0, np.uint64)
                out["anchors"].append(found.view(np.int64))
            return out

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, n_words long, sha256 string, anchors array<long>")


def _runs(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of n places: those in a run of `length` from one of the starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.clip(starts, 0, n), 1)
    np.add.at(edge, np.clip(starts + length, 0, n), -1)
    return np.cumsum(edge)[:-1] > 0


def candidate_windows(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """doc_id, packed (text), starts, one, two (128-bit hashes) of the windows that contain an anchor at `positions`."""

    def pack():
        squeeze = zstandard.ZstdCompressor(level=3).compress
        return lambda b: {"doc_id": b["doc_id"], "packed": [squeeze((t or "").encode()) for t in b["text"]]}

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def work(b):
            out = {"doc_id": b["doc_id"], "packed": b["packed"], "starts": [], "one": [], "two": []}
            for packed, at in zip(b["packed"], b["positions"]):
                hashes = hashes_of(unpack(packed).split())
                # an id may come with several texts, and so with positions of another one: they only add candidates
                mask = _runs(np.array(at) - PERIOD + 1, PERIOD, max(0, len(hashes) - WINDOW + 1))
                starts = np.flatnonzero(mask)
                out["starts"].append(starts)
                out["one"].append(windows(hashes, WINDOW, starts).view(np.int64))
                out["two"].append(windows(hashes ^ np.uint64(0xA0761D6478BD642F), WINDOW, starts, base=0xE7037ED1A0B428DB).view(np.int64))
            return out

        return work

    # texts move compressed: that halves what this join shuffles
    rows = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), pack, "doc_id long, packed binary")
    # rows that repeat id and text are told apart while they are small; the join has brought them together
    met = rows.join(positions, "doc_id").dropDuplicates(["doc_id", "packed"])
    return map_rows(met, make, "doc_id long, packed binary, starts array<int>, one array<long>, two array<long>")


def without_repeats(found: DataFrame) -> DataFrame:
    """doc_id, sha256 (before), n_removed, kept_sha256, kept_text of found (doc_id, packed, repeats: starts and hashes)."""

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def work(b):
            out = {"doc_id": b["doc_id"], "sha256": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            for packed, repeats in zip(b["packed"], b["repeats"]):
                words = unpack(packed).split()
                starts = np.array([r["start"] for r in repeats], np.int64)
                seen = np.array([r["one"] for r in repeats], np.int64)
                inside = starts + WINDOW <= len(words)
                starts, seen = starts[inside], seen[inside]
                starts = starts[windows(hashes_of(words), WINDOW, starts).view(np.int64) == seen]
                gone = _runs(starts, WINDOW, len(words))
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                for name, value in zip(list(out)[1:], (hashlib.sha256(b" ".join(words)).hexdigest(), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode())):
                    out[name].append(value)
            return out

        return work

    return map_rows(found.select("doc_id", "packed", "repeats"), make, "doc_id long, sha256 string, n_removed long, kept_sha256 string, kept_text string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of every row of docs.

    Removed is each word in a window of WINDOW words whose sequence also starts in a document with a smaller id. Null and
    empty texts have no words; rows that repeat an id and text have the same result; a null id is smaller than none, and
    nothing goes from it. kept_text is null where nothing was removed (the words are then those of the text)."""
    base = settle(anchors(docs), "substring-anchors")
    total = base.count()
    # texts shorter than a window repeat nothing, however often they come: they have no key
    plain = base.select("doc_id", "n_words", "sha256", F.when(F.col("n_words") >= WINDOW, F.col("sha256")).alias("key"))
    # equal texts: all but the first are repeats from end to end, and add no window that the first lacks
    same = plain.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = settle(same, "substring-same")
    placed = salted_join(plain, same.select("key", "first_id"), ["key"], ["doc_id"], hot_keys(same, ["key"], total))
    placed = settle(placed.select("doc_id", "n_words", "sha256", "first_id"), "substring-placed")
    copies = placed.where("doc_id > first_id").select("doc_id", "sha256")
    firsts = base.join(copies, ["doc_id", "sha256"], "left_anti").select("doc_id", F.posexplode("anchors").alias("i", "hash"))
    shared = firsts.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").select("hash", "n")
    shared = settle(shared, "substring-shared")
    at = F.element_at(F.array(*map(F.lit, COVER)), F.col("i") % len(COVER) + 1) + F.floor(F.col("i") / len(COVER)).cast("int") * PERIOD
    hits = salted_join(firsts, shared.select("hash"), ["hash"], ["doc_id", "i"], hot_keys(shared, ["hash"], total * len(COVER)), "inner")
    positions = hits.groupBy("doc_id").agg(F.collect_set(at).alias("positions"))
    wide = settle(candidate_windows(docs, settle(positions, "substring-positions")), "substring-windows")
    every = wide.select("doc_id", F.explode(F.arrays_zip("starts", "one", "two")).alias("w")).select("doc_id", "w.*")
    first_of = every.groupBy("one", "two").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first_of = settle(first_of, "substring-firsts")
    hot = hot_keys(first_of, ["one", "two"], total * len(COVER))
    repeats = salted_join(every, first_of.select("one", "two", "low"), ["one", "two"], ["doc_id", "starts"], hot, "inner").where("low < doc_id")
    by_doc = repeats.groupBy("doc_id").agg(F.collect_set(F.struct(F.col("starts").alias("start"), "one")).alias("repeats"))
    changed = without_repeats(wide.select("doc_id", "packed").join(by_doc, "doc_id")).dropDuplicates(["doc_id", "sha256"])
    out = placed.join(changed, ["doc_id", "sha256"], "left")
    is_copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return out.select(
        "doc_id",
        "n_words",
        F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(is_copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(is_copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
