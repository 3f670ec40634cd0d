"""Repair of conversations against brute force over all edits."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, turns

FORM = re.compile(r"(s?(ua)+)?")
sys.setrecursionlimit(10_000)
SPACE = " \t\n\x0b\x0c\r"


def damage(conv, turn, role, text):
    conv, turn_, role, text = (" " if v is None else str(v) for v in (conv, turn, role, text))
    kind = zlib.crc32(f"{conv}:{turn_}".encode()) % 20
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """(cost, audit, said) by search over all edits of rows (initial, fault, role, text), ties ASCII-least."""

    def may_follow(last, x):
        return any(FORM.fullmatch(start + last + x + end) for start in ("", "u") for end in ("", "a", "ua") if last or not start)

    @lru_cache(None)
    def best(i, last, inserted):
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def say(cost, edit, x, turn, i, inserted):
            if may_follow(last, x):
                c, audit, said = best(i, x, inserted)
                found.append((cost + c, edit + audit, (turn,) + said))

        if inserted < 4:
            say(2, "I", "u", ("user", ""), i, inserted + 1)
            say(2, "I", "a", ("assistant", ""), i, inserted + 1)
        if i < len(rows):
            initial, fault, role, text = rows[i]
            c, audit, said = best(i + 1, last, 0)
            found.append((3 + c, "D" + audit, said))
            if fault not in ("blank", "duplicate"):
                cut = int(fault == "truncated")
                if initial in ("s", "u", "a"):
                    say(cut, "K", initial, (role, text), i + 1, 0)
                say(2 + cut, "R", "u", ("user", text), i + 1, 0)
                say(2 + cut, "R", "a", ("assistant", text), i + 1, 0)
        return min(found, default=(10**9, "", ()))

    return best(0, "", 0)


def plain(rows):
    """The contract, conversation by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        all_ = [d for r in rows if r[0] == conv for d in damage(*r)]
        all_.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for turn, role, text in all_:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role[:1], fault, role, text))
        numbers = [t for t, *_ in all_ if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        n = lambda f: sum(j[1] == f for j in judged)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, said = cheapest(tuple(judged))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (gaps, n("blank"), n("duplicate"), n("truncated"), illegal, cost, audit, digest)
    return out


def conversations(seed, n=60, most=9):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "so it is", "Why? ", " \t\n", None, "", "Fine.\x0b", f"{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("key", "at", "chunk", "state")})


def result(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed,chunk", [(1, turns.CHUNK), (2, 3), (3, 1)])
def test_against_all_edits(spark, seed, chunk):
    rows = conversations(seed)
    assert result(turns.audit_damaged(frame(spark, rows), chunk)) == plain(rows)


def test_one_long_conversation_in_many_chunks(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["A.", f"{t}.", f"{t}", ""])) for t in range(900)] + [(8, 0, "user", "Hm."), (8, 1, "assistant", "Ah.")]
    alone = result(turns.audit_damaged(frame(spark, rows)))
    assert result(turns.audit_damaged(frame(spark, rows), 4)) == alone
    some = [r for r in rows if r[0] == 8 or r[1] < 100]
    assert result(turns.audit_damaged(frame(spark, some), 4)) == plain(some)


def test_whole_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = queries.op13_turns(spark, data)
    assert df.columns[:9] == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert result(df) == plain(rows)


def test_rows_of_the_repaired(spark):
    rows = conversations(9, 30)
    repaired = turns.repair(turns.damaged(frame(spark, rows)))
    said = {}
    for r in turns.repaired_rows(repaired).orderBy("at", "place").collect():
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    expected = plain(rows)
    for conv, turns_ in said.items():
        assert FORM.fullmatch("".join(r[:1] for r, _ in turns_))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns_).encode()).hexdigest() == expected[conv][-1]


def test_empty_and_all_dropped(spark):
    assert result(turns.audit_damaged(frame(spark, []))) == {}
    # crc32 of this key is a multiple of 20
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert result(turns.audit_damaged(frame(spark, [(conv, 0, "user", "Yes.")]))) == {conv: (0,) * 6 + ("", hashlib.sha256().hexdigest())}
