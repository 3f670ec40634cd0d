"""Approximate nearest neighbours (largest inner product) by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is put into a leaf. A query goes through the tree best bin first: a
priority queue holds the branches not yet taken, and leaves are visited in its order. How many, is calibrated: for a
sample of queries the exact neighbours are found among all rows, in blocks, and visits widen until RECALL of them are
seen. Leaves are cut into blocks by the rows and the queries that they have, so that no leaf, however full or however
often asked, meets in one task.
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

#: Children of a node; rows of the table for each leaf, so that leaves grow with it, and most leaves; rows of the sample for
#: each leaf, and rows of the sample at most.
BRANCH, LEAF_ROWS, MOST_LEAVES, LEAF_SAMPLE, SAMPLE = 8, 1000, 8192, 100, 102_400
#: Rows that a query meets before what it has found bounds what other leaves give.
FIRST_ROWS = 3000
#: Recall aimed at among the neighbours of so many calibration queries.
RECALL, CALIBRATION = 0.97, 200
#: Rows and queries that meet in one group at most, about.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 1024
NEIGHBOURS = 20


@dataclass
class Tree:
    """Nodes by number; node 0 is the root. children[n] is empty for a leaf."""

    centres: np.ndarray
    children: list[list[int]]

    def __post_init__(self):
        self.leaves = [n for n, kids in enumerate(self.children) if not kids]
        self.place = {n: i for i, n in enumerate(self.leaves)}

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row: down the tree to the nearest centre."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.place[node]
            elif len(rows):
                c = self.centres[kids]
                near = ((c * c).sum(1) - 2 * x[rows] @ c.T).argmin(1)
                todo += [(kid, rows[near == i]) for i, kid in enumerate(kids)]
        return out

    def visit(self, q: np.ndarray):
        """Leaf numbers, best bin first."""
        queue, n = [(0.0, 0, 0)], 0
        while queue:
            node = heapq.heappop(queue)[2]
            kids = self.children[node]
            if not kids:
                yield self.place[node]
            else:
                for score, kid in zip(self.centres[kids] @ q, kids):
                    n += 1
                    heapq.heappush(queue, (-float(score), n, kid))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)
        used = np.unique(near)
        moved = np.stack([x[near == i].mean(0) for i in used])
        if len(moved) == len(centres) and np.allclose(moved, centres):
            break
        centres = moved
    return centres, ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)


def fit(sample: np.ndarray, leaves: int, seed: int = 8) -> Tree:
    """Splits the fullest leaf into BRANCH until there are `leaves`, or nothing differs any more."""
    rng = np.random.default_rng(seed)
    centres, children, full = [sample.mean(0)], [[]], [(-len(sample), 0, np.arange(len(sample)))]
    n_leaves = 1
    while full and n_leaves < leaves:
        size, node, rows = heapq.heappop(full)
        if -size < 2 * BRANCH:
            break
        found, near = _kmeans(sample[rows], BRANCH, rng)
        parts = [rows[near == i] for i in range(len(found))]
        if sum(len(p) > 0 for p in parts) < 2:
            continue
        for centre, part in zip(found, parts):
            if len(part):
                children[node].append(len(children))
                heapq.heappush(full, (-len(part), len(children), part))
                centres.append(centre)
                children.append([])
        n_leaves += len(children[node]) - 1
    return Tree(np.stack(centres), children)


def usable(vector: Column) -> Column:
    """Not null nor zero, and of finite components only."""
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda v: v != 0)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from left to right, so that equal vectors always score the same."""
    return np.add.accumulate(q * x, axis=1)[:, -1]


def top(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of query, index of row, score) of each query's k nearest rows but its own; ties to smaller ids."""
    rough = queries @ x.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    if x.shape[0] > k:
        cut = -np.partition(-rough, k - 1, axis=1)[:, k - 1 : k]
        # rounding may not push out what ties with the last
        cut = np.where(np.isfinite(cut), cut - 1e-9 * (1 + np.abs(cut)), cut)
        qi, xi = np.nonzero((rough >= cut) & np.isfinite(rough))
    else:
        qi, xi = np.nonzero(np.isfinite(rough))
    exact = scores(queries[qi], x[xi])
    order = np.lexsort((ids[xi], -exact, qi))
    qi, xi, exact = qi[order], xi[order], exact[order]
    first = np.searchsorted(qi, qi)
    keep = np.arange(len(qi)) - first < k
    return qi[keep], xi[keep], exact[keep]


def _matrix(lists) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in lists], np.float64)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest of those found, fewer if there are no more rows.

    Rows with a null id, or vectors that are null, zero, or hold null or non-finite components, take no part; nor do
    vectors of another length than the commonest (of equally common ones, the longest), which have no inner product with
    the others. Rows that repeat an id are candidates one by one, but none for their own id. An empty table gives none."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = vectors.schema[vector_col].dataType
    # numbers of single precision move as such, and are reckoned with in double
    vec = F.col(vector_col) if kind == T.ArrayType(T.FloatType()) else F.col(vector_col).cast("array<double>")
    numbers = "array<float>" if kind == T.ArrayType(T.FloatType()) else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return empty
    rows, total = rows.where(F.size("v") == sizes["d"]), sizes["n"]
    leaves = max(1, min(MOST_LEAVES, total // leaf_rows))
    wanted = min(SAMPLE, LEAF_SAMPLE * leaves)
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000_007))
    near = rows.select("v", hashed.alias("h")).where(F.col("h") < int(1_000_000_007 * min(1.0, 1.1 * wanted / total)) + 1)
    sample = near.orderBy("h").limit(wanted).select("v").toPandas()["v"]
    tree = fit(_matrix(sample), leaves) if len(sample) else Tree(np.zeros((1, sizes["d"])), [[]])
    sent = spark.sparkContext.broadcast(tree)

    def put():
        return lambda b: {"leaf": sent.value.assign(_matrix(b["__v"])) if b["__v"] else []}

    index = settle(map_rows(rows.withColumn("__v", F.col("v")), put, "leaf long", keep=("vec_id", "v", "asks")), "ann-index")
    held = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    queries = index.where("asks").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    n_queries = queries.count()
    if not n_queries:
        return empty
    visits = calibrate(index, queries, n_queries, tree, k, recall)

    def probe():
        def work(b):
            out = {"query_id": [], "q": [], "leaf": [], "early": []}
            for query, q in zip(b["query_id"], b["q"]):
                seen = 0
                for n, leaf in enumerate(sent.value.visit(np.asarray(q, np.float64))):
                    # widen, too, until there are enough rows
                    if n >= visits and seen > k:
                        break
                    if leaf in held:
                        for name, value in zip(out, (query, q, leaf, seen < FIRST_ROWS)):
                            out[name].append(value)
                        seen += held[leaf]
            return out

        return work

    probes = settle(map_rows(queries, probe, f"query_id long, q {numbers}, leaf long, early boolean"), "ann-probes")
    full = spark.createDataFrame(list(held.items()), "leaf long, n long")
    part = lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def meet(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        ids, asking, bound = x["vec_id"].to_numpy(), q["query_id"].to_numpy(), q["bound"].to_numpy(np.float64)
        qi, xi, score = top(_matrix(q["q"]), asking, _matrix(x["v"]), ids, k)
        good = ~(score < bound[qi])
        return pd.DataFrame({"query_id": asking[qi[good]], "vec_id": ids[xi[good]], "score": score[good]})

    keys = ["leaf", "b", "c"]

    def met(some: DataFrame) -> DataFrame:
        """What the probes (with bound) find. Leaves that none of them asks are left out."""
        asked = some.groupBy("leaf").agg(F.count(F.lit(1)).alias("__asked")).join(full, "leaf")
        cuts = asked.select("leaf", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("by_rows"), F.ceil(F.col("__asked") / BLOCK_QUERIES).cast("int").alias("by_queries"))
        # as many rows as there are leaves
        cuts = F.broadcast(settle(cuts, "ann-cuts"))
        left = index.select("vec_id", "v", "leaf").join(cuts, "leaf").select("leaf", part("vec_id", F.col("by_rows")).alias("b"), each("by_queries").alias("c"), "vec_id", "v")
        right = some.join(cuts, "leaf").select("leaf", each("by_rows").alias("b"), part("query_id", F.col("by_queries")).alias("c"), "query_id", "q", "bound")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")

    # the first leaves' last neighbour bounds what can still be among the nearest: others give only what reaches it
    first = settle(met(probes.where("early").withColumn("bound", F.lit(None).cast("double"))), "ann-first")
    bounds = _best(first, k).groupBy("query_id").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).drop("n")
    rest = met(probes.where("not early").join(bounds, "query_id", "left"))
    return _best(first.union(rest), k).select("query_id", "rank", "vec_id", "score")


def calibrate(index: DataFrame, queries: DataFrame, n_queries: int, tree: Tree, k: int, recall: float) -> int:
    """Leaves to visit: the least number at which `recall` of the exact neighbours of CALIBRATION queries are seen."""
    hashed = F.pmod(F.xxhash64("query_id"), F.lit(1_000_000_007))
    some = queries.withColumn("h", hashed).where(F.col("h") < int(1_000_000_007 * min(1.0, 2 * CALIBRATION / n_queries)) + 1).orderBy("h").limit(CALIBRATION).toPandas()
    ids, q = some["query_id"].to_numpy(), _matrix(some["q"])
    sent = index.sparkSession.sparkContext.broadcast((ids, q))

    def exact():
        ids, q = sent.value

        def work(b):
            mine = np.array(b["vec_id"], np.int64)
            qi, xi, score = top(q, ids, _matrix(b["v"]), mine, k)
            return {"query_id": ids[qi], "vec_id": mine[xi], "score": score, "leaf": np.array(b["leaf"], np.int64)[xi]}

        return work

    truth = _best(map_rows(index, exact, "query_id long, vec_id long, score double, leaf long"), k).select("query_id", "leaf").toPandas()
    wanted = truth.groupby("query_id")["leaf"].apply(list).to_dict()
    seen_at = []
    for query, vector in zip(ids, q):
        order = {leaf: n for n, leaf in enumerate(tree.visit(vector))}
        seen_at += [order[leaf] for leaf in wanted.get(query, [])]
    if not seen_at:
        return 1
    return int(np.sort(seen_at)[min(len(seen_at) - 1, int(np.ceil(recall * len(seen_at))) - 1)]) + 1
