"""Operator 12 against a best-first search over (cost, edits)."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tests.conftest import SF_CHECK
from tests.llm.helpers import key
from tidewell.llm import repair
from tidewell.llm.registered import QUERIES
from tidewell.session import read_table

TURNS = "conv_id long, turn long, role string, text string"
STEP, WHO = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of the
    sorted rows (turn, role, text) of a conversation."""
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.strip(" \t\n\r\x0b\x0c")
        faults.append("b" if not end else "d" if (role, text) in seen else "" if end[-1] in ".!?" else "t")
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, s, out = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == len(rows) and s in (0, 3):
            break
        to = STEP[s]
        heapq.heappush(heap, (cost + 3, audit + "I", i, to, out + ((WHO[to], ""),)))
        if i < len(rows):
            _, role, text = rows[i]
            more = 3 if faults[i] == "t" else 0
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, s, out))
            if faults[i] not in ("b", "d"):
                init = (role or " ")[0]
                if s == 0 and init == "s":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, 1, out + ((role, text),)))
                elif init == WHO[to][0]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, to, out + ((role, text),)))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, to, out + ((WHO[to], text),)))
    initials = [(role or " ")[0] for _, role, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest()), out


def of_conversations(rows):
    """Per conversation its rows as the operator orders them; texts tied on
    turn and role must be equal in the tests."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for c, r in out.items()}


def random_conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, longest)):
            for _ in range(rng.choice([1, 1, 1, 2])):
                number = rng.choice([turn, turn, turn, turn + 100, None])
                role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
                text = f"{number} {role} says so" if rng.random() < 0.6 else rng.choice(["Yes.", "no? ", " \t", "", None, "ok\n.", "…"])
                rows.append((conv, number, role, text))
    by = {}
    for r in rows:  # one text for each conversation, turn and role, so that the order is plain
        by.setdefault(r[:3], r[3])
    return [(*r[:3], by[r[:3]]) for r in rows]


@pytest.mark.parametrize("seed,longest,segment", [(0, 6, 1024), (1, 12, 1024), (2, 12, 1), (3, 40, 3), (4, 200, 16), (5, 3, 1)])
def test_op12_against_search(spark, monkeypatch, seed, longest, segment):
    """Small segments cut conversations, which then are solved in parts."""
    monkeypatch.setattr(repair, "SEGMENT_TURNS", segment)
    rows = random_conversations(seed, 12, longest)
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS seg", "'x' AS conv", "2 AS audit", "3 AS count").repartition(5)
    found, turns = repair.repair(df)
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    want = {c: brute(r) for c, r in of_conversations(rows).items()}
    assert got == {c: w[0] for c, w in want.items()}
    left = {}
    for r in turns.orderBy("seg", "place").collect():
        left.setdefault(r.conv, []).append((r.role, r.text))
    assert left == {c: list(w[1]) for c, w in want.items() if w[1]}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 100])
def test_checkpoints_hold_the_root_of_the_turns(n):
    """The walk by checkpoints equals one with all vectors kept."""
    rng = random.Random(n)
    turns = [(rng.choice("sua "), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
    vectors = [repair.END]
    for init, fault in reversed(turns):
        vectors.append(repair.before(vectors[-1], init, fault))
    vectors.reverse()
    exits = repair.walk(turns, repair.END, range(4), True)
    for state in range(4):
        cost, s, i = 0, state, 0
        for edit in exits[state][1]:
            if edit == "I":
                cost, s = cost + 3, STEP[s]
            else:
                e = next(e for e in repair.edits(s, *turns[i]) if e[0] == edit)
                cost, s, i = cost + e[1], e[2], i + 1
        assert (cost, i, s) == (vectors[0][state], n, exits[state][0]) and s in (0, 3)


def test_op12_query_damages_and_repairs(spark):
    turns = read_table(spark, SF_CHECK, "conversations")
    rows, ids = {}, set()
    for r in turns.collect():
        ids.add(r.conv_id)
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", r.text) if kind == 2 else r.text
        if kind:
            rows.setdefault(r.conv_id, []).extend([(r.turn, "user" if kind == 4 else r.role, text)] * (1 + (kind == 3)))
    want = {c: brute(sorted(r))[0] for c, r in rows.items()}
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op12_conversation_repair"](spark, SF_CHECK).collect()}
    assert set(got) == ids and {c: got[c] for c in want} == want


def test_op12_lost_and_empty_conversations(spark, tmpdir_str):
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello."), (None, None, None, None)], TURNS)
    df.write.parquet(f"{tmpdir_str}/conversations.parquet")
    got = sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, tmpdir_str).collect()), key=key)
    kind = zlib.crc32(b" : ") % 20
    left = brute([(None, "user" if kind == 4 else " ", "" if kind == 1 else " ")] * (1 + (kind == 3)))[0] if kind else nothing
    assert got == sorted([(gone, *nothing), (None, *left)], key=key)
    assert repair.repair(spark.createDataFrame([], TURNS))[0].count() == 0


def test_op12_one_long_conversation(spark, monkeypatch):
    """A conversation with nearly all rows, most of them the same, goes through many tasks."""
    monkeypatch.setattr(repair, "SEGMENT_TURNS", 50)
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Text {t}.", f"cut {t}"])) for t in range(6000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hello.")]
    found, _ = repair.repair(spark.createDataFrame(rows, TURNS))
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert got == {c: brute(r)[0] for c, r in of_conversations(rows).items()}
