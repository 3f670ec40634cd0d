"""Exact search for the largest integer inner products, by an M-tree that is searched best first.

Every row lies in a page, below a centre; each page and each node above it stores a radius that covers all its rows, and its
centre's distance from the one above it; each row stores its own distance from its page's centre. For a query q and a row x
below a centre c, q.x = q.c + q.(x - c) is at most q.c + |q| d(c, x), and by the triangle inequality d(c, x) is at most the
stored distances on the way down: a node can be passed over by its parent's product alone, a page by its radius, a row by
its stored distance, each without a product of its own. A query takes pages from a priority queue, best bound first, until it
has met enough rows; its last of k scores is then the least that others have to reach, so that what is passed over can't be
among the k: the result is exact whatever the tree is like.

The tree's centres come from a bounded sample, its radii from all rows. Pages meet their queries in blocks.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import map_rows, settle

SCALE, NEIGHBOURS = 1024, 10
#: Entries of a node; rows of a page, about; rows of the sample for each page; most rows of the sample; most bytes of centres,
#: which are sent to every task: beyond it, pages grow, and their blocks become more.
FAN_OUT, PAGE_ROWS, PAGE_SAMPLE, SAMPLE, TREE_BYTES = 8, 1024, 32, 65_536, 32 << 20
#: Rows that a query meets first, at least.
FIRST_ROWS = 1024
#: Rows and queries that meet in one group at most, about.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048
#: Whole numbers up to this are exact in double precision, sums of products too.
EXACT, LAST = float(1 << 53), 2**63 - 1
#: Bounds are widened by this share, so that rounding passes nothing over.
SLACK = 1e-9


def scaled(lists) -> np.ndarray:
    """floor(1024 x) of each component, as doubles, which hold them exactly."""
    return np.floor(np.array([np.asarray(v, np.float64) for v in lists], np.float64) * SCALE)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: exact, in doubles where no sum can round, else in integers of any size; those beyond 64
    bits become the nearest number of 64 bits."""
    most = (np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0)) * max(1, q.shape[1])
    if most < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    exact = whole(q) @ whole(x).T
    return np.array([[max(-LAST - 1, min(LAST, v)) for v in r] for r in exact.tolist()], np.int64).reshape(exact.shape)


def distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(-1))


@dataclass
class Tree:
    """Nodes by number, 0 the root; a leaf is a page. up: distance of a node's centre from its parent's."""

    centres: np.ndarray
    children: list[list[int]]
    up: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def path(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(page, distance from its centre) of each row: down to the nearest centre at each level."""
        page, far = np.zeros(len(x), np.int64), np.zeros(len(x))
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                page[rows], far[rows] = node, distances(x[rows], self.centres[node])
            elif len(rows):
                near = np.stack([distances(x[rows], self.centres[kid]) for kid in kids]).argmin(0)
                todo += [(kid, rows[near == i]) for i, kid in enumerate(kids)]
        return page, far

    def cover(self, pages: dict[int, tuple[int, float]]) -> None:
        """Takes rows and radius of each page, of all rows, upward: a node covers its children's balls."""
        self.rows, self.radius = np.zeros(len(self.children), np.int64), np.full(len(self.children), -1.0)
        for page, (n, far) in pages.items():
            self.rows[page], self.radius[page] = n, far
        for node in range(len(self.children) - 1, -1, -1):
            kids = [k for k in self.children[node] if self.rows[k]]
            if kids:
                self.rows[node] = self.rows[kids].sum()
                self.radius[node] = max(self.up[k] + self.radius[k] for k in kids)

    def search(self, q: np.ndarray, least: float = -np.inf):
        """(page, bound) best first, of pages that may hold a product of `least`; most nodes below it are passed over by the
        stored distance from their parent, without a product."""
        norm = float(np.sqrt(q @ q))
        top = float(self.centres[0] @ q)
        queue = [(-(top + norm * self.radius[0]), 0, top)]
        while queue:
            bound, node, product = heapq.heappop(queue)
            if -bound + SLACK * (1 + abs(bound)) < least:
                return
            if not self.children[node]:
                yield node, -bound
                continue
            for kid in self.children[node]:
                if self.rows[kid]:
                    rough = product + norm * (self.up[kid] + self.radius[kid])
                    if not rough + SLACK * (1 + abs(rough)) < least:
                        own = float(self.centres[kid] @ q)
                        heapq.heappush(queue, (-min(rough, own + norm * self.radius[kid]), kid, own))


def _split(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres that differ, first far from each other, then moved to the middle of what is near them; and the nearest of each."""
    picks = [int(rng.integers(len(x)))]
    far = distances(x, x[picks[0]])
    while len(picks) < k and far.max() > 0:
        picks.append(int(far.argmax()))
        far = np.minimum(far, distances(x, x[picks[-1]]))
    centres = x[picks]
    for _ in range(6):
        near = np.stack([distances(x, c) for c in centres]).argmin(0)
        centres = np.stack([x[near == i].mean(0) for i in np.unique(near)])
    return centres, np.stack([distances(x, c) for c in centres]).argmin(0)


def grow(sample: np.ndarray, pages: int, seed: int = 12) -> Tree:
    """Splits the fullest node until there are `pages`, or nothing differs any more."""
    rng = np.random.default_rng(seed)
    centres, children, up, full, n = [sample.mean(0)], [[]], [0.0], [(-len(sample), 0, np.arange(len(sample)))], 1
    while full and n < pages:
        size, node, rows = heapq.heappop(full)
        if -size < 2 * FAN_OUT:
            break
        found, near = _split(sample[rows], min(FAN_OUT, pages - n + 1), rng)
        if len(found) < 2:
            continue
        for i, centre in enumerate(found):
            children[node].append(len(children))
            heapq.heappush(full, (-int((near == i).sum()), len(children), rows[near == i]))
            centres.append(centre)
            up.append(float(distances(centre, centres[node])))
            children.append([])
        n += len(found) - 1
    m = len(children)
    return Tree(np.stack(centres), children, np.array(up), np.zeros(m), np.zeros(m, np.int64))


def meet(q: np.ndarray, asking: np.ndarray, least: np.ndarray, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, far: np.ndarray, centre: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of query, index of row, score) of each query's k largest products with rows of a page that reach its `least`,
    ties to smaller ids, then rows. Rows that no query's bound reaches are not multiplied."""
    norm, near = np.sqrt((q * q).sum(1)), q @ centre
    # the farthest a row may lie from the centre is what a query leaves it; of all queries, the most
    open_ = np.zeros(len(x), bool)
    order = np.argsort(far)
    with np.errstate(invalid="ignore", divide="ignore"):
        bound = (least - near - SLACK * (1 + np.abs(near) + norm * far.max(initial=0.0))) / norm
    from_ = np.searchsorted(far[order], np.where((norm > 0) & ~np.isnan(bound), bound, -np.inf).min(initial=np.inf))
    open_[order[from_:]] = True
    some = np.flatnonzero(open_)
    score = products(q, x[some])
    # doubles beyond EXACT may have been rounded; what reaches too far is sorted out by whole numbers
    reach = (score >= (least - np.where(np.abs(least) > EXACT, np.abs(least) * SLACK, 0))[:, None]) & (asking[:, None] != rows[some][None, :])
    if len(some) > k:
        held = np.where(reach, score, -LAST - 1)
        reach &= score >= np.partition(held, len(some) - k, axis=1)[:, len(some) - k, None]
    qi, xi = np.nonzero(reach)
    value, at = score[qi, xi], some[xi]
    # a score's bits turned about fall as it rises, and never overflow
    order = np.lexsort((rows[at], ids[at], ~value, qi))
    qi, at, value = qi[order], at[order], value[order]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[keep], at[keep], value[keep]


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("asking").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(vector: Column) -> Column:
    """Not null nor empty, of components only that are finite, multiplied too."""
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double") * SCALE) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding", page_rows: int = PAGE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query with all other rows, components being
    floor(1024 x); fewer if there are no more rows.

    Rows with a null id, or vectors that are null, empty, or hold null or non-finite components, take no part; zero vectors
    do. Vectors of another length than the commonest (of equally common ones, the longest) have no inner product with the
    others and take no part. A query's own row is left out, not other rows of its id: each of several rows of one id asks,
    and may be found, by itself. Scores beyond 64 bits become the nearest number of 64 bits, and tie there. An empty
    table, or one without queries, gives none. Other columns are left out."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    kind = vectors.schema[vector_col].dataType
    # numbers of single precision move as such, and are reckoned with in double
    numbers = "array<float>" if kind == T.ArrayType(T.FloatType()) else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(numbers).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return empty
    d, total = sizes["d"], sizes["n"]
    rows = rows.where(F.size("v") == d).withColumn("row", F.monotonically_increasing_id())
    pages = max(1, min(total // page_rows, SAMPLE // PAGE_SAMPLE, TREE_BYTES // (8 * d)))
    wanted = min(SAMPLE, PAGE_SAMPLE * pages)
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000_007))
    near = rows.select("v", hashed.alias("h")).where(F.col("h") < int(1_000_000_007 * min(1.0, 1.1 * wanted / total)) + 1)
    sample = near.orderBy("h").limit(wanted).select("v").toPandas()["v"]
    tree = grow(scaled(sample) if len(sample) else np.zeros((1, d)), pages)
    plain = spark.sparkContext.broadcast(tree)

    def put():
        def work(b):
            page, far = plain.value.path(scaled(b["__v"])) if b["__v"] else ([], [])
            return {"page": page, "far": far}

        return work

    index = settle(map_rows(rows.withColumn("__v", F.col("v")), put, "page long, far double", keep=("vec_id", "row", "v", "asks")), "topk-pages")
    # as many rows as there are pages
    tree.cover({r["page"]: (r["n"], r["far"]) for r in index.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()})
    sent = spark.sparkContext.broadcast(tree)
    queries = index.where("asks").select(F.col("vec_id").alias("query_id"), F.col("row").alias("asking"), F.col("v").alias("q"))
    if queries.isEmpty():
        return empty

    def first():
        def work(b):
            out = {"query_id": [], "asking": [], "q": [], "page": [], "least": []}
            for query, asking, q in zip(b["query_id"], b["asking"], b["q"]):
                seen = 0
                for page, _ in sent.value.search(scaled([q])[0]):
                    for name, value in zip(out, (query, asking, q, page, None)):
                        out[name].append(value)
                    seen += int(sent.value.rows[page])
                    if seen > max(k, FIRST_ROWS):
                        break
            return out

        return work

    def others():
        def work(b):
            out = {"query_id": [], "asking": [], "q": [], "page": [], "least": []}
            for query, asking, q, least, met in zip(b["query_id"], b["asking"], b["q"], b["least"], b["met"]):
                for page, _ in sent.value.search(scaled([q])[0], -np.inf if least is None else float(least)):
                    if page not in met:
                        for name, value in zip(out, (query, asking, q, page, least)):
                            out[name].append(value)
            return out

        return work

    schema = f"query_id long, asking long, q {numbers}, page long, least long"
    part = lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["page", "b", "c"]

    def group(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "asking", "vec_id", "row", "score")})
        least = q["least"].astype("float64").fillna(-np.inf).to_numpy()
        asking, ids, rows_ = q["asking"].to_numpy(), x["vec_id"].to_numpy(), x["row"].to_numpy()
        qi, xi, score = meet(scaled(q["q"]), asking, least, scaled(x["v"]), rows_, ids, x["far"].to_numpy(), sent.value.centres[x["page"].iloc[0]], k)
        return pd.DataFrame({"query_id": q["query_id"].to_numpy()[qi], "asking": asking[qi], "vec_id": ids[xi], "row": rows_[xi], "score": score})

    full = spark.createDataFrame([(i, int(n)) for i, n in enumerate(tree.rows) if n and not tree.children[i]], "page long, n long")

    def met(probes: DataFrame) -> DataFrame:
        """What the queries find in the pages that they ask."""
        asked = probes.groupBy("page").agg(F.count(F.lit(1)).alias("asked")).join(F.broadcast(full), "page")
        cuts = asked.select("page", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("by_rows"), F.ceil(F.col("asked") / BLOCK_QUERIES).cast("int").alias("by_queries"))
        cuts = F.broadcast(settle(cuts, "topk-cuts"))
        left = index.join(cuts, "page").select("page", part("row", F.col("by_rows")).alias("b"), each("by_queries").alias("c"), "vec_id", "row", "v", "far")
        right = probes.join(cuts, "page").select("page", each("by_rows").alias("b"), part("asking", F.col("by_queries")).alias("c"), "query_id", "asking", "q", "least")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(group, "query_id long, asking long, vec_id long, row long, score long")

    begun = settle(map_rows(queries, first, schema), "topk-first")
    found = settle(met(begun), "topk-found")
    bounds = _best(found, k).groupBy("asking").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).select("asking", F.when(F.col("n") >= k, F.col("least")).alias("least"))
    been = begun.groupBy("asking").agg(F.collect_set("page").alias("met"))
    rest = settle(map_rows(queries.join(been, "asking").join(bounds, "asking", "left").select("query_id", "asking", "q", "least", "met"), others, schema), "topk-rest")
    return _best(found.unionByName(met(rest)), k).select("query_id", "rank", "vec_id", "score")
