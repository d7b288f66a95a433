"""Conversation repair against a search over all edits."""

import collections
import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.llm import conversations

SF_DIR = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ONE = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def cheapest(rows):
    """Least (cost, edits) over all ways; rows are (role, text, must go, cut off)."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, edits, i, state, lines = heapq.heappop(heap)
        if state == "end":
            return cost, edits, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows):
            if state in (0, 3):
                heapq.heappush(heap, (cost, edits, i, "end", lines))
        else:
            role, text, must_go, cut_off = rows[i]
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, state, lines))
            if not must_go:
                more = 3 if cut_off else 0
                if state in NEXT.get(role[:1], {}):
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, NEXT[role[:1]][state], lines + ((role, text),)))
                heapq.heappush(heap, (cost + 3 + more, edits + "R", i + 1, ONE[state][0], lines + ((ONE[state][1], text),)))
        heapq.heappush(heap, (cost + 3, edits + "I", i, ONE[state][0], lines + ((ONE[state][1], ""),)))


def expected(rows):
    """``(turn, role, text)`` of one conversation to its result."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, n, judged = set(), collections.Counter(), []
    for _, role, text in rows:
        words = text.rstrip(BLANKS)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        n[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, edits, lines = cheapest(judged)
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()
    return (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, edits, digest), lines


def damaged(rows):
    out = collections.defaultdict(list)
    one = lambda v: " " if v is None else v
    for conv, turn, role, text in rows:
        out[conv]
        case = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = "user" if case == 4 else one(role), "" if case == 1 else one(text)
        if case == 2:
            text = "".join(c for c in text if c not in ".!?")
        out[conv] += [(turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in entry.queries()["op11_conversation_repair"](spark, SF_DIR).collect()}
    assert got == {conv: expected(own)[0] for conv, own in damaged(rows).items()}


ODD = (
    [(None, None, "user", "Hi."), (None, None, None, "Hi."), (None, 1, "assistant", "Yes.")]
    + [(1, t, r, "A.") for t, r in enumerate(["user", "user", "user", "assistant", "system", "tool", ""])]
    + [(2, 0, "user", None), (2, 0, "user", ""), (2, 1, None, " \t")]
    + [(3, t, "user", f"Turn {t}" + "." * (t % 3)) for t in range(41)]
    + [(4, None, "user", "Same."), (4, 7, "user", "Same."), (4, 7, "user", "Same."), (4, 9, "assistant", "Same.")]
    + [(5, 0, "system", "S."), (5, 1, "user", "w " * 50_000 + "?"), (5, 2, "assistant", "é\U0001f600!")]
    + [(6, t, ("user", "assistant")[t % 2], "Once more.") for t in range(12)]
)
SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, what int, lines string"


@pytest.mark.parametrize("damage", [False, True])
def test_odd_rows(spark, damage):
    table = spark.createDataFrame([(*r, "x", 7, "y") for r in ODD], SCHEMA)
    rows = conversations.damaged(table) if damage else table
    want = damaged(ODD) if damage else collections.defaultdict(list)
    if not damage:
        for conv, turn, role, text in ODD:
            want[conv].append((turn, role or (" " if role is None else ""), " " if text is None else text))
    got = {r.conv_id: tuple(r)[1:] for r in conversations.audit(rows, table.select("conv_id")).collect()}
    assert got == {conv: expected(own)[0] for conv, own in want.items()}
    lines = collections.defaultdict(list)
    for r in conversations.repaired(rows).orderBy("conv_id", "nth").collect():
        lines[r.conv_id].append((r.role, r.text))
    assert dict(lines) == {conv: list(expected(own)[1]) for conv, own in want.items() if expected(own)[1]}


def test_no_rows(spark):
    table = spark.createDataFrame([(*r, "x", 7, "y") for r in ODD], SCHEMA)
    none = table.limit(0)
    assert conversations.audit(none).collect() == [] and conversations.repaired(none).collect() == []
    got = conversations.audit(none, table.select("conv_id")).collect()
    assert {r.conv_id for r in got} == {r[0] for r in ODD} and len(got) == 7
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_ties_take_the_least_edits():
    rnd = random.Random(5)
    for _ in range(400):
        roles = rnd.choice((["user"], ["user", "assistant"], ["user", "assistant", "system", "tool"]))
        rows = [(rnd.choice(roles), f"t{i}", rnd.random() < 0.2, rnd.random() < 0.3) for i in range(rnd.randint(0, 14))]
        out = []
        search = conversations.Repair(lambda edit, line: out.append((edit, line)))
        for row in rows:
            search.row(*row)
        cost = search.end()
        assert (cost, "".join(e for e, _ in out), tuple(x for _, x in out if x)) == cheapest(rows)


def test_what_is_settled_leaves_memory():
    rnd, most, settled = random.Random(6), 0, [0]
    search = conversations.Repair(lambda edit, line: settled.__setitem__(0, settled[0] + (edit != "I")))
    for i in range(20_000):
        search.row(rnd.choice(["user", "assistant"]), "", rnd.random() < 0.1, rnd.random() < 0.2)
        most = max(most, i - settled[0])
    assert most < 50


def test_damage_keeps_no_dropped_row(spark):
    rows = spark.range(2000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("a.").alias("text"))
    kept = {r.turn for r in conversations.damaged(rows).collect()}
    assert kept == {t for t in range(2000) if zlib.crc32(f"1:{t}".encode()) % 20}
