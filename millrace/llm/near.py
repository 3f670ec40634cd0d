"""MinHash near-dedup with odd sketches.

Documents with the same set of shingles are one class; only classes are compared. The MinHash samples of a class are cut
into bands, whose number follows from the threshold (LOST is the chance that a pair at the threshold shares none), and
the same samples are folded into an odd sketch: a bitmap that keeps of each bit how often, modulo two, a sample fell on
it. From the population count of the XOR of two sketches follows how many samples differ.

In each bucket the class that meets most others is the centre: every other member is held against it (first round). What
that links becomes one component. Only buckets whose members still lie in several components are looked at again (second
round), in blocks of bounded size: first by their sketches alone, which leaves the members that may have a partner in
another component, then these by their texts. A task gives no pairs but links, and no more of them than join the
components. Sketches rule out pairs far below the threshold; every other pair is confirmed on the full sets.

Band keys, centres and labels can be hot: all joins on them are salted.
"""

from __future__ import annotations

from collections import OrderedDict
from functools import lru_cache
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import counted, hot_keys, map_rows, salted_join, settle
from .words import hashes_of, mixed, windows, words_of

ROWS, SKETCH_WORDS = 5, 16
#: Members of a bucket that meet by their sketches, and by their texts, in one group, about, and bytes of these texts;
#: larger buckets are cut into blocks.
SKETCH_BLOCK, BLOCK, BLOCK_BYTES = 4096, 1500, 8 << 20
#: Blocks are smaller where a task's fair share of the rows is, but not below this.
LEAST_BLOCK = 256
#: Shingles of texts that a task keeps at hand.
KEPT = 4_000_000
#: Chance that a pair at the threshold shares no band; standard deviations below the threshold at which a sketch rules out.
LOST, DEVIATIONS = 1e-6, 5.0

def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of `size` words, A-Z lower-cased; with fewer words, of the whole sequence."""
    hashes = hashes_of(words_of(text and text.lower() if text is None or text.isascii() else text.encode().lower().decode()))
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        return windows(hashes, len(hashes), base=0xD6E8FEB86659FD93 + 2 * len(hashes))
    return np.unique(windows(hashes, size))


def bands_for(threshold: float, rows: int = ROWS) -> int:
    return ceil(log(LOST) / log(1 - threshold**rows))


@lru_cache(4)
def _multipliers(samples: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = mixed(np.arange(1, 2 * samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (numbers[:samples] | np.uint64(1))[:, None], numbers[samples:][:, None]


def minhash(members: np.ndarray, samples: int) -> np.ndarray:
    factor, shift = _multipliers(samples)
    least = np.full(samples, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(members), 2048):
            least = np.minimum(least, (members[start : start + 2048] * factor + shift).min(1))
    return least


def band_keys(samples: np.ndarray, rows: int = ROWS) -> np.ndarray:
    cut = samples.reshape(-1, rows)
    key = np.arange(len(cut), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, k])
    return key.astype(np.int64)


def odd_sketch(samples: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parity bitmap of the pairs (place, sample)."""
    with np.errstate(over="ignore"):
        bits = mixed(samples + np.arange(len(samples), dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(64 * words)
    flips = np.zeros(64 * words, np.uint8)
    np.add.at(flips, bits.astype(np.int64), 1)
    return np.packbits(flips & 1).view("<i8")


def most_flips(threshold: float, samples: int, words: int = SKETCH_WORDS) -> int:
    """The largest XOR population count that a pair at the threshold may show, DEVIATIONS allowed for."""
    lowest = threshold - DEVIATIONS * sqrt(threshold * (1 - threshold) / samples)
    n = 64 * words
    expected = n / 2 * (1 - (1 - 2 / n) ** (2 * samples * (1 - lowest)))
    return ceil(expected + DEVIATIONS * sqrt(n) / 4)


def signatures(docs: DataFrame, size: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null for an empty one), bands, sketch."""

    def make():
        def work(b):
            out = {"n_shingles": [], "digest": [], "bands": [], "sketch": []}
            for text in b["text"]:
                members = shingles(text, size)
                out["n_shingles"].append(len(members))
                if len(members):
                    samples = minhash(members, bands * ROWS)
                    out["digest"].append(xxhash.xxh3_128_digest(members.tobytes()))
                    out["bands"].append(band_keys(samples))
                    out["sketch"].append(odd_sketch(samples))
                else:
                    for k in ("digest", "bands", "sketch"):
                        out[k].append(None)
            return out

        return work

    return map_rows(docs.select("doc_id", "text"), make, "n_shingles long, digest binary, bands array<long>, sketch array<long>", keep=("doc_id",))


def packed_texts(digests: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """digest, packed (a text of that set, compressed) of the classes in `digests`; stored."""
    needed = digests.join(classes.select("digest", F.col("rep").alias("doc_id")), "digest")
    texts = docs.select("doc_id", "text").join(needed, "doc_id")

    def pack():
        squeeze = zstandard.ZstdCompressor(level=1).compress

        def work(b):
            # an id may come with several texts: only that of the class counts
            mine = [i for i, (d, t) in enumerate(zip(b["digest"], b["text"])) if xxhash.xxh3_128_digest(shingles(t, size).tobytes()) == d]
            return {"digest": [b["digest"][i] for i in mine], "packed": [squeeze(b["text"][i].encode()) for i in mine]}

        return work

    return settle(map_rows(texts.select("digest", "text"), pack, "digest binary, packed binary").dropDuplicates(["digest"]), "near-texts")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of stored pairs (a, b) of digests, those with 100 * intersection >= percent * union on their full sets; stored."""
    packed = packed_texts(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), classes, docs, size)
    one = packed.select(F.col("digest").alias("a"), F.col("packed").alias("packed_a"))
    two = packed.select(F.col("digest").alias("b"), F.col("packed").alias("packed_b"))
    both = salted_join(pairs.select("a", "b").join(one, "a"), two, ["b"], ["a"], hot_keys(counted(pairs, "b"), ["b"], pairs.count()), "inner")

    def verify():
        unpack = zstandard.ZstdDecompressor().decompress
        read = lru_cache(16)(lambda digest, packed: shingles(unpack(packed).decode(), size))

        def work(b):
            good = []
            for i, (x, y, px, py) in enumerate(zip(b["a"], b["b"], b["packed_a"], b["packed_b"])):
                s, t = read(x, px), read(y, py)
                same = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * same >= percent * (len(s) + len(t) - same):
                    good.append(i)
            return {"a": [b["a"][i] for i in good], "b": [b["b"][i] for i in good]}

        return work

    return settle(map_rows(both, verify, "a binary, b binary"), "near-links")


def hopeful(labels: np.ndarray, blocks: np.ndarray, n: np.ndarray, sketches: np.ndarray, percent: int, flips: int) -> np.ndarray:
    """Which members may be near one of another label, as far as sizes and sketches tell. Of two blocks, members meet those
    of the other; a block by itself, all of its own. Members of the largest label meet the others, but not each other."""
    found = np.zeros(len(labels), bool)
    apart = blocks.min() != blocks.max()
    for i in np.flatnonzero(labels != np.bincount(labels).argmax()):
        near = (labels != labels[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
        if apart:
            near &= blocks != blocks[i]
        if near.any():
            near[near] = np.bitwise_count(sketches[near] ^ sketches[i]).sum(1) <= flips
        if near.any():
            found |= near
            found[i] = True
    return found


def _numbers(labels: list) -> np.ndarray:
    names = {label: i for i, label in enumerate(dict.fromkeys(labels))}
    return np.array([names[label] for label in labels])


class _Group:
    """Members of one bucket, or of two blocks of one: finds links between different components of theirs."""

    def __init__(self, size: int, percent: int, flips: int):
        self.size, self.percent, self.flips = size, percent, flips
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.kept: OrderedDict[bytes, np.ndarray] = OrderedDict()
        self.room = KEPT

    def read(self, packed: bytes) -> np.ndarray:
        """The set of a text; those read last are kept, up to KEPT shingles."""
        if (found := self.kept.get(packed)) is not None:
            self.kept.move_to_end(packed)
            return found
        found = self.kept[packed] = shingles(self.unpack(packed).decode(), self.size)
        self.room -= len(found)
        while self.room < 0 and len(self.kept) > 1:
            self.room += len(self.kept.popitem(last=False)[1])
        return found

    def links(self, members: list[tuple]) -> list[tuple[bytes, bytes]]:
        """members: (block, digest, label, n, sketch, packed). Enough confirmed links to join all components that links join."""
        of = _numbers([m[2] for m in members])
        parent = list(range(int(of.max()) + 1))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        n = np.array([m[3] for m in members], np.int64)
        sketches = np.array([m[4] for m in members], np.int64).view(np.uint64)
        # members of the largest component meet the others, but not each other
        few = np.flatnonzero(of != np.bincount(of).argmax())
        maybe = np.zeros((len(few), len(members)), bool)
        for row, i in enumerate(few):
            near = (100 * np.minimum(n, n[i]) >= self.percent * np.maximum(n, n[i])) & (of != of[i])
            near[near] = np.bitwise_count(sketches[near] ^ sketches[i]).sum(1) <= self.flips
            maybe[row] = near
        rows, cols = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
        if not len(rows):
            return []
        common = self._common([members[i][5] for i in few[rows]], [members[j][5] for j in cols])
        joint = n[few[rows]][:, None] + n[cols][None, :] - common
        found = []
        for r, c in zip(*np.nonzero(maybe[np.ix_(rows, cols)] & (100 * common >= self.percent * joint))):
            i, j = few[rows[r]], cols[c]
            x, y = root(of[i]), root(of[j])
            if x != y:
                parent[x] = y
                found.append((members[i][1], members[j][1]))
        return found

    def _common(self, one: list[bytes], two: list[bytes]) -> np.ndarray:
        """Sizes of the intersections of the sets of two lists of texts, as products of incidence matrices."""
        sets, others = [self.read(p) for p in one], [self.read(p) for p in two]
        shared = np.intersect1d(np.concatenate(sets), np.concatenate(others))
        out = np.zeros((len(sets), len(others)), np.float32)
        places = [np.searchsorted(shared, s[np.isin(s, shared, assume_unique=True)]) for s in sets], [np.searchsorted(shared, s[np.isin(s, shared, assume_unique=True)]) for s in others]
        for start in range(0, len(shared), 4096):
            stop = min(len(shared), start + 4096)
            sides = []
            for side in places:
                matrix = np.zeros((len(side), stop - start), np.float32)
                for i, at in enumerate(side):
                    matrix[i, at[(at >= start) & (at < stop)] - start] = 1
                sides.append(matrix)
            out += sides[0] @ sides[1].T
        return out.astype(np.int64)


def met_in_blocks(members: DataFrame, hot: DataFrame | None, most: int, size: Column | None = None) -> DataFrame:
    """members (key, digest, label and others) with __block and the group (__i, __j) that they meet in, once for each group.

    A bucket of at most `most` members (and BLOCK_BYTES of `size`) is one group. Of a larger one, members of its largest
    component need not meet each other: only the others are cut into blocks of which every two meet, and each of these
    blocks meets the largest component's members block by block. So members of the largest component are copied once for
    each block of others, and where these fit into one block, copies stay in proportion to members, however many."""
    by_label = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), (F.sum(size) if size is not None else F.lit(0)).cast("long").alias("bytes"))
    need = lambda n, size: F.greatest(F.ceil(n / most), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")
    counts = by_label.groupBy("key").agg(F.max(F.struct("n", "label", "bytes")).alias("top"), F.sum("n").alias("all"), F.sum("bytes").alias("all_bytes"))
    top = F.col("top")
    counts = counts.select("key", top["label"].alias("__top"), (need(F.col("all"), F.col("all_bytes")) == 1).alias("__whole"), need(F.col("all") - top["n"], F.col("all_bytes") - top["bytes"]).alias("__few"), need(top["n"], top["bytes"]).alias("__many"))
    placed = salted_join(members, counts, ["key"], ["digest"], hot, "inner")
    part = lambda n: F.pmod(F.xxhash64("digest"), F.col(n)).cast("int")
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    # blocks of the largest component are numbered from -1 down
    largest = F.col("label") == F.col("__top")
    placed = placed.withColumn("__block", F.when(F.col("__whole"), 0).when(largest, -1 - part("__many")).otherwise(part("__few")))
    block, others = F.col("__block"), F.sequence(F.lit(0), F.col("__few") - 1)
    groups = (
        F.when(F.col("__whole"), F.array(pair(F.lit(0), F.lit(0))))
        .when(largest, F.transform(others, lambda i: pair(i, block)))
        .otherwise(F.concat(F.transform(others, lambda j: pair(F.least(block, j), F.greatest(block, j))), F.transform(F.sequence(F.lit(1), F.col("__many")), lambda j: pair(block, -j))))
    )
    return placed.withColumn("__group", F.explode(groups)).withColumns({"__i": F.col("__group.i"), "__j": F.col("__group.j")})


def _in_blocks(members: DataFrame, hot: DataFrame | None, most: int, columns: list[str], work, schema: str, size: Column | None = None) -> DataFrame:
    """work(rows) over each group of met_in_blocks(). work gets (block, digest, columns) and gives rows of `schema`."""
    met = met_in_blocks(members, hot, most, size)
    keys = ["key", "__i", "__j"]
    dealt = met.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "__block", "digest", *columns)
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        do, now, found = work(), None, []
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[:3] != now:
                    found += do(now, rows) if len(rows) > 1 else []
                    now, rows = row[:3], []
                rows.append(row[3:])
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t.type) for i, t in enumerate(arrow)], schema=arrow)
            found = []
        found = do(now, rows) if len(rows) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t.type) for i, t in enumerate(arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def cross_links(open_: DataFrame, sketches: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, flips: int, hot: DataFrame | None) -> DataFrame:
    """Confirmed links (a, b) between different components in the buckets of open_ (key, digest, label).

    No pair leaves a task but as a link, and no more links than join the bucket's components. Large buckets are cut into
    blocks, so that no group grows with the bucket. Members meet by sizes and sketches first; only those that may have a
    partner meet by their texts."""

    def by_sketch():
        def work(now, rows):
            blocks, digests, labels, n, sketch = zip(*rows)
            good = hopeful(_numbers(labels), np.array(blocks), np.array(n, np.int64), np.array(sketch, np.int64).view(np.uint64), percent, flips)
            return [(now[0], digests[i]) for i in np.flatnonzero(good)]

        return work

    def by_text():
        group = _Group(size, percent, flips)
        return lambda now, rows: group.links(rows)

    def block(rows: DataFrame, most: int) -> int:
        return min(most, max(LEAST_BLOCK, rows.count() // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    signed = open_.join(sketches, "digest")
    maybe = _in_blocks(signed, hot, block(open_, SKETCH_BLOCK), ["label", "n", "sketch"], by_sketch, "key long, digest binary").distinct()
    maybe = settle(maybe, "near-hopeful")
    texts = packed_texts(maybe.select("digest").distinct(), classes, docs, size)
    left = open_.join(maybe, ["key", "digest"]).join(sketches, "digest").join(texts, "digest")
    return settle(_in_blocks(left, hot, block(maybe, BLOCK), ["label", "n", "sketch", "packed"], by_text, "a binary, b binary", F.octet_length("packed")).distinct(), "near-links")


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """node, label (smallest node of its component) of every node of links (a, b), stored. Labels spread along links and are
    then followed to their own labels, so that rounds grow with the logarithm of a chain's length; each is stored."""
    both = settle(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-both")
    nodes = both.select(F.col("a").alias("node")).distinct()
    if labels is None:
        labels = nodes.withColumn("label", F.col("node"))
    else:
        labels = nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label")).union(labels.join(nodes, "node", "left_anti").select("node", "label"))
    labels = settle(labels, "near-labels")
    total = both.count()
    hubs = hot_keys(counted(both, "b"), ["b"], total)
    while True:
        around = salted_join(both, labels.select(F.col("node").alias("b"), "label"), ["b"], ["a"], hubs, "inner").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        # what a label's own node has met counts for all that carry the label
        met = settle(labels.join(around, "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("new")), "near-met")
        of_label = met.groupBy("label").agg(F.min("new").alias("by_label"))
        moved = salted_join(met, of_label, ["label"], ["node"], hot_keys(counted(met, "label"), ["label"], total), "inner")
        moved = settle(moved.select("node", F.col("label").alias("old"), F.least("new", "by_label").alias("new")), "near-moved")
        follow = met.select(F.col("node").alias("new"), F.col("new").alias("next"))
        ahead = salted_join(moved, follow, ["new"], ["node"], hot_keys(counted(moved, "new"), ["new"], total))
        stored = settle(ahead.select("node", F.least("new", F.coalesce("next", "new")).alias("label"), "old"), "near-labels")
        labels = stored.select("node", "label")
        if stored.where("label <> old").isEmpty():
            return labels


def near_components(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept of every row of docs (doc_id of any type that has an
    order, text).

    Texts without words (null, empty) have no shingles and are linked with nothing. Rows of the same text are one class;
    each is returned. A row with a null id takes part in no link between different sets; its component has the smallest
    id of its class and links, or null if all are null, and then it is kept. An empty table stays empty."""
    threshold = percent / 100
    bands = bands_for(threshold)
    signed = settle(signatures(docs, size, bands), "near-signatures")
    # all rows of a class have the same bands and sketch
    classes = signed.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n")
    )
    classes = settle(classes, "near-classes")
    keyed = classes.where("rep is not null").select("digest", F.explode("bands").alias("key"))
    shared = settle(counted(keyed, "key").where("n > 1"), "near-shared")
    total = classes.count() * bands
    hot = hot_keys(shared, ["key"], total)
    live = settle(salted_join(keyed, shared, ["key"], ["digest"], hot, "inner"), "near-buckets")
    degree = live.groupBy("digest").agg(F.sum(F.col("n") - 1).alias("degree"))
    centres = live.join(degree, "digest").groupBy("key").agg(F.max(F.struct("degree", "digest")).alias("c")).select("key", F.col("c.digest").alias("b"))
    sketches = classes.select("digest", "sketch", "n")
    flips = most_flips(threshold, bands * ROWS)
    # a: member, b: centre
    first = salted_join(live.select("key", F.col("digest").alias("a")), centres, ["key"], ["a"], hot, "inner").where("a <> b").select("a", "b").distinct()
    first = settle(first, "near-pairs")
    one = sketches.select(F.col("digest").alias("a"), F.col("sketch").alias("sa"), F.col("n").alias("na"))
    two = sketches.select(F.col("digest").alias("b"), F.col("sketch").alias("sb"), F.col("n").alias("nb"))
    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    held = salted_join(first.join(one, "a"), two, ["b"], ["a"], hot_keys(counted(first, "b"), ["b"], first.count()), "inner")
    likely = held.where((F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")) & (apart <= flips)).select("a", "b")
    likely = settle(likely, "near-likely")
    if likely.isEmpty():
        labels = classes.select(F.col("digest").alias("node"), F.col("digest").alias("label")).limit(0)
    else:
        labels = components(confirmed(likely, classes, docs, size, percent))
    placed = live.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select("key", "digest", F.coalesce("label", "digest").alias("label"))
    split = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("n > 2 and low <> high").select("key")
    open_ = settle(salted_join(placed, split, ["key"], ["digest"], hot, "inner"), "near-open")
    if not open_.isEmpty():
        links = cross_links(open_, sketches, classes, docs, size, percent, flips, hot)
        if not links.isEmpty():
            labels = components(links, labels)
    named = settle(classes.select("digest", "rep", "size").join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest")), "near-named")
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    groups = salted_join(named, least, ["label"], ["digest"], hot_keys(counted(named, "label"), ["label"], total), "inner")
    groups = settle(groups.select("digest", F.col("size").alias("n"), "component_id"), "near-components")
    copies = hot_keys(groups.select("digest", "n"), ["digest"], signed.count())
    rows = salted_join(signed.select("doc_id", "n_shingles", "digest"), groups.drop("n"), ["digest"], ["doc_id"], copies)
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))
