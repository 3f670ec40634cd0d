"""Repair of conversations to the form `(s?(ua)+)?` with the fewest edits, by a time-major tensor programme.

What has been said so far is one of four states (nothing, a system turn, a user's, an assistant's). Rows are sorted once, in
parallel, by conversation and turn, and cut into chunks of at most CHUNK rows, so that a conversation of any length is many
tasks' work. In a chunk, the pieces of conversations are bucketed by length; for each turn, last to first, the costs to go of
all pieces of a bucket are updated at once and stored; then all are traced at once, first turn to last, taking the
ASCII-least edit that keeps the cost. Of a conversation in several chunks, each piece first gives its 4 x 4 costs between the
states before and after it, which are combined from the end; then where it goes from each state, combined from the beginning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bounded_batches, settle

#: Bits of the rows of a chunk.
CHUNK = 13
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing said, or the initial of who spoke last. Codes of rows: s, u, a, any other role, and no row.
START, SYSTEM, USER, ASSISTANT = range(4)
OTHER, PAD = 3, 4
FAR = 1 << 40
#: State after a row of each code is kept, from each state; -1 where it may not stand.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1] * 4, [-1] * 4])
#: State after an inserted turn, or one with a new role, which is always the one that has to come.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Cost of ending in each state: the turns that are still to be inserted.
END = np.array([0, 2 * INSERT, INSERT, 0])
#: What is inserted from each state in 0, 1, 2 turns.
INSERTED = np.array([["", "u", "ua"], ["", "u", "ua"], ["", "a", "au"], ["", "u", "ua"]], object)
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32 of `conv_id:turn`, modulo 20, deals: 0 drops a row, 1 empties its
    text, 2 takes out its `[.!?]`, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))) % 20
    out = rows.select("conv_id", "turn", kind.alias("kind"), space("role").alias("role"), space("text").alias("text")).where("kind > 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return out.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def costs_to_go(codes: np.ndarray, must: np.ndarray, cut: np.ndarray, end: np.ndarray) -> np.ndarray:
    """[T + 1, N, 4]: least cost of what is still to come, from each state before each turn.

    codes, must, cut: [T, N], the rows' codes, whether they have to go, and what they cost if they don't; end: [N, 4]."""
    out = np.empty((len(codes) + 1, *end.shape), np.int64)
    out[-1] = end
    for t in range(len(codes) - 1, -1, -1):
        after, stay = out[t + 1], np.where(must[t], FAR, cut[t])[:, None]
        to = KEPT[codes[t]]
        keep = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1), FAR) + stay
        once = np.minimum(np.minimum(DELETE + after, keep), REROLE + after[:, NEXT] + stay)
        best = np.minimum(once, np.minimum(INSERT + once[:, NEXT], 2 * INSERT + once[:, NEXT[NEXT]]))
        out[t] = np.where((codes[t] == PAD)[:, None], after, best)
    return out


def trace(codes: np.ndarray, must: np.ndarray, cut: np.ndarray, costs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(edits, turns inserted before each, states before those) [T, N] of the cheapest edits that are ASCII-least (D, I, K, R),
    and the states after all."""
    shape, each = codes.shape, np.arange(codes.shape[1])
    edits, inserted, before = np.full(shape, " ", "U1"), np.zeros(shape, np.int8), np.zeros(shape, np.int8)
    state = state.copy()
    for t in range(shape[0]):
        before[t] = state
        open_ = codes[t] != PAD
        for _ in range(3):
            now, after = costs[t, each, state], costs[t + 1]
            drop = open_ & (DELETE + after[each, state] == now)
            edits[t, drop] = "D"
            open_ &= ~drop
            insert = open_ & (INSERT + costs[t, each, NEXT[state]] == now)
            inserted[t] += insert
            to = KEPT[codes[t], state]
            keep = open_ & ~insert & ~must[t] & (to >= 0) & (cut[t] + after[each, np.maximum(to, 0)] == now)
            edits[t, keep] = "K"
            rerole = open_ & ~insert & ~keep
            edits[t, rerole] = "R"
            state = np.where(keep, to, np.where(insert | rerole, NEXT[state], state))
            open_ &= insert
            if not open_.any():
                break
    return edits, inserted, before, state


class _Pieces:
    """Rows of a chunk, in order, as pieces of conversations, and their tensors by length."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("at", kind="stable")
        self.rows, key = rows, rows["key"].to_numpy()
        self.first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.n = np.diff(np.append(self.first, len(key)))
        self.keys = key[self.first]
        self.codes, self.must, self.cut = rows["code"].to_numpy(np.int64), rows["must"].to_numpy(bool), rows["cut"].to_numpy(np.int64)
        #: whether a row and the one before it in its piece make no legal pair
        said = self.codes
        legal = (said[1:] == 1) & np.isin(said[:-1], (0, 2)) | (said[1:] == 2) & (said[:-1] == 1)
        self.odd = np.concatenate([[False], ~legal])
        self.odd[self.first] = False

    def buckets(self):
        """(pieces, rows [T, N], and codes, must, cut of those) of the pieces of up to 1, 2, 4 ... rows; 0 stands for no row."""
        kind = np.ceil(np.log2(self.n)).astype(int)
        for k in np.unique(kind):
            pieces = np.flatnonzero(kind == k)
            t = np.arange(self.n[pieces].max())[:, None]
            there = t < self.n[pieces]
            at = np.where(there, self.first[pieces] + t, 0)
            yield pieces, there, at, np.where(there, self.codes[at], PAD), self.must[at], self.cut[at]


def _between(rows: pd.DataFrame) -> pd.DataFrame:
    """key, chunk, costs (16, by state before and after), codes of the first and last row of each piece."""
    p = _Pieces(rows)
    costs = np.empty((len(p.keys), 4, 4), np.int64)
    ends = np.where(np.eye(4, dtype=bool), 0, FAR)
    for pieces, _, _, *tensors in p.buckets():
        many = [np.repeat(x, 4, axis=1) for x in tensors]
        costs[pieces] = costs_to_go(*many, np.tile(ends, (len(pieces), 1)))[0].reshape(-1, 4, 4).transpose(0, 2, 1)
    return pd.DataFrame({"key": p.keys, "chunk": rows["chunk"].iloc[0], "costs": list(costs.reshape(-1, 16)), "first": p.codes[p.first], "last": p.codes[p.first + p.n - 1]})


def _from_the_end(pieces: pd.DataFrame) -> pd.DataFrame:
    """key, chunk, end (costs from each state after a piece), crossing (whether it follows the one before it illegally)."""
    pieces = pieces.sort_values("chunk")
    costs, end, ends = np.stack(pieces["costs"]).reshape(-1, 4, 4), END, []
    for c in costs[::-1]:
        ends.append(end)
        end = (c + end).min(1)
    last, first = pieces["last"].to_numpy()[:-1], pieces["first"].to_numpy()[1:]
    legal = (first == 1) & np.isin(last, (0, 2)) | (first == 2) & (last == 1)
    return pd.DataFrame({"key": pieces["key"], "chunk": pieces["chunk"], "end": ends[::-1], "crossing": np.concatenate([[False], ~legal])})


def _ways(rows: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    """key, chunk, to: the state after each piece from each state before it."""
    p, to = _Pieces(rows), {}
    end_of = dict(zip(ends["key"], ends["end"]))
    for pieces, _, _, *tensors in p.buckets():
        costs = costs_to_go(*tensors, np.array([end_of[k] for k in p.keys[pieces]], np.int64))
        ways = [trace(*tensors, costs, np.full(len(pieces), s))[3] for s in range(4)]
        to |= dict(zip(p.keys[pieces], np.stack(ways, 1)))
    return pd.DataFrame({"key": p.keys, "chunk": rows["chunk"].iloc[0] if len(rows) else 0, "to": [to[k] for k in p.keys]})


def _from_the_beginning(pieces: pd.DataFrame) -> pd.DataFrame:
    pieces = pieces.sort_values("chunk")
    state, states = START, []
    for to in pieces["to"]:
        states.append(state)
        state = int(to[state])
    return pd.DataFrame({"key": pieces["key"], "chunk": pieces["chunk"], "state": states})


def _edited(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """at, edit, before, role, after, odd of each row. known: state before and costs after the pieces of conversations that
    lie in several chunks, and whether they are the last."""
    p = _Pieces(rows)
    n = len(p.codes)
    out = {"at": p.rows["at"].to_numpy(), "edit": np.full(n, "", object), "before": np.full(n, "", object), "role": np.full(n, "", object), "after": np.full(n, "", object), "odd": p.odd}
    of = {k: v for k, *v in zip(known["key"], known["end"], known["state"], known["crossing"], known["last"])}
    usual = (END, START, False, True)
    for pieces, there, at, *tensors in p.buckets():
        end, state, crossing, last = zip(*(of.get(k, usual) for k in p.keys[pieces]))
        costs = costs_to_go(*tensors, np.array(end, np.int64))
        edits, inserted, before, final = trace(*tensors, costs, np.array(state))
        out["odd"][p.first[pieces]] |= np.array(crossing, bool)
        rows_ = at[there]
        out["edit"][rows_] = edits[there].astype(object)
        out["before"][rows_] = INSERTED[before[there], inserted[there]]
        # a new role is the one that has to come after what was inserted
        came = before[there]
        for k in (1, 2):
            came = np.where(inserted[there] >= k, NEXT[came], came)
        out["role"][rows_] = np.where(edits[there] == "R", np.where(NEXT[came] == USER, "u", "a"), "").astype(object)
        ends = p.first[pieces] + p.n[pieces] - 1
        out["after"][ends] = np.where(last, INSERTED[final, END[final] // INSERT], "")
    return pd.DataFrame(out)


def _sorted(rows: DataFrame) -> DataFrame:
    """rows with key (their conversation as text) and at (their place in order), stored."""
    key = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("key")
    df = rows.select(key, "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("__salt"))
    # equal rows may come in any order, so that a hot one is dealt out too
    order = ["key", F.col("turn").asc_nulls_first(), "role", "text", "__salt"]
    return settle(df.repartitionByRange(*order).sortWithinPartitions(*order).drop("__salt").withColumn("at", F.monotonically_increasing_id()), "turns")


def _faults(stored: DataFrame) -> DataFrame:
    """stored with fault: blank, duplicate, truncated or null, in this order."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    blank, cut = bare == "", ~F.right(bare, F.lit(1)).isin(".", "!", "?")
    # the first of equal rows is found by partial sums, and told by its own place: a hot text is no one's key
    firsts = stored.where(~blank).groupBy("key", "role", F.sha2("text", 256).alias("digest")).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("__first"))
    found = stored.join(firsts, "at", "left")
    return found.withColumn("fault", F.when(blank, "blank").when(F.col("__first").isNull(), "duplicate").when(cut, "truncated")).drop("__first")


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows of conversations (conv_id, turn, role, text) with key, at (their order), fault, edit (K, D, R), before and after
    (initials of the turns inserted there), new_role (u or a, of R), odd (no legal pair with the row before); stored.

    Rows come by turn, nulls first; those of one turn by role, then text. Null roles and texts count as one space, null
    conv_ids as one conversation. A row is legal by the initial of its role alone. Repeated rows are duplicates. An empty
    table gives none; other columns are left out."""
    bounded_batches(rows.sparkSession)
    filled = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    found = settle(_faults(_sorted(filled)), "faults")
    code = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.left("role", F.lit(1))), F.lit(0)) - 1, F.lit(OTHER))
    code = F.when(F.col("role") == "", OTHER).otherwise(code)
    narrow = found.select("key", F.shiftright("at", chunk).alias("chunk"), "at", code.cast("int").alias("code"), F.col("fault").isin("blank", "duplicate").alias("must"), F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0).alias("cut"))
    narrow = narrow.withColumn("must", F.coalesce("must", F.lit(False)))
    spans = narrow.groupBy("key").agg(F.min("chunk").alias("from"), F.max("chunk").alias("last_chunk")).where("from < last_chunk").select("key", "last_chunk")
    spans = settle(spans, "long-conversations")
    known = "key string, chunk long, end array<long>, state int, crossing boolean, last boolean"
    if spans.isEmpty():
        table = rows.sparkSession.createDataFrame([], known)
    else:
        some = settle(narrow.join(spans, "key").drop("last_chunk"), "long-rows")
        between = some.groupBy("chunk").applyInPandas(_between, "key string, chunk long, costs array<long>, first int, last int")
        ends = settle(between.groupBy("key").applyInPandas(_from_the_end, "key string, chunk long, end array<long>, crossing boolean"), "long-ends")
        ways = some.groupBy("chunk").cogroup(ends.groupBy("chunk")).applyInPandas(_ways, "key string, chunk long, to array<int>")
        starts = ways.groupBy("key").applyInPandas(_from_the_beginning, "key string, chunk long, state int")
        table = ends.join(starts, ["key", "chunk"]).join(spans, "key").select("key", "chunk", "end", "state", "crossing", (F.col("chunk") == F.col("last_chunk")).alias("last"))
    edits = narrow.groupBy("chunk").cogroup(table.groupBy("chunk")).applyInPandas(_edited, "at long, edit string, before string, role string, after string, odd boolean")
    return settle(found.join(edits.withColumnRenamed("role", "new_role"), "at"), "repaired")


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """conv_id, at, place, role, text: what repair() leaves, in order of at and place; inserted turns have an empty text."""
    role = lambda c: F.when(c == "u", "user").otherwise("assistant")
    added = lambda c: F.when(F.length(c) > 0, F.transform(F.split(c, ""), lambda x: F.struct(role(x).alias("role"), F.lit("").alias("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    own = F.when(F.col("edit") == "D", F.array().cast("array<struct<role:string,text:string>>")).otherwise(F.array(F.struct(F.when(F.col("edit") == "R", role(F.col("new_role"))).otherwise(F.col("role")).alias("role"), "text")))
    return repaired.select("conv_id", "at", F.posexplode(F.concat(added(F.col("before")), own, added(F.col("after")))).alias("place", "t")).select("conv_id", "at", "place", "t.role", "t.text")


def _spelled(df: DataFrame) -> DataFrame:
    """key, audit, repaired_sha256. A digest of a whole conversation can only be taken in its order, by one task; texts stream
    through it in small batches, and only the audit is held."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "audit", "repaired_sha256")])
    arrow = to_arrow_schema(schema)
    names = {"u": "user", "a": "assistant"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, digest, any_ = None, [], None, False

        def say(text: str) -> None:
            nonlocal any_
            digest.update((("\n" if any_ else "") + text).encode())
            any_ = True

        for batch in batches:
            done = []
            for key, role, text, edit, before, new, after in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if key != now:
                    if now is not None:
                        done.append((now, "".join(audit), digest.hexdigest()))
                    now, audit, digest, any_ = key, [], hashlib.sha256(), False
                audit.append("I" * len(before) + edit + "I" * len(after))
                for x in before:
                    say(f"{names[x]}:")
                if edit != "D":
                    say(f"{names.get(new, role)}:{text}")
                for x in after:
                    say(f"{names[x]}:")
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*done) if done else [[]] * 3)], schema=arrow)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (now, "".join(audit), digest.hexdigest())], schema=arrow)

    dealt = df.repartition("key").sortWithinPartitions("key", "at")
    return dealt.select("key", "role", "text", "edit", "before", "new_role", "after").mapInArrow(run, schema)


def audits(ids: DataFrame, repaired: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conv_id of `ids` (one column),
    null as well; zeros, '' and the digest of nothing where repair() got no row of it."""
    cut = F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0)
    row_cost = F.when(F.col("edit") == "D", DELETE).otherwise(F.when(F.col("edit") == "R", REROLE).otherwise(0) + cut) + INSERT * (F.length("before") + F.length("after"))
    turns = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    sums = repaired.groupBy("key").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
        F.count_if(F.col("odd")).alias("illegal"),
        F.sum(row_cost).cast("long").alias("cost"),
    )
    key = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    all_ = ids.select("conv_id").distinct().withColumn("key", key)
    out = all_.join(sums, "key", "left").join(_spelled(repaired), "key", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def audit_damaged(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """audits() of what damaged() leaves of the conversations."""
    return audits(conversations, repair(damaged(conversations), chunk))
