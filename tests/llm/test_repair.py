"""Conversation repair against dynamic programming and a plain version of the damage."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from tablecheck.llm import repair
from tablecheck.llm.repair import BLANK, DUPLICATE, NO_FAULT, TRUNCATED, search

from .helpers import frame

TURNS = "conv_id long, turn long, role string, text string"
NEXT = ({"s": 1, "u": 3}, {"u": 3}, {"u": 3}, {"a": 2})


def cheapest(initials, faults):
    """Least (cost, edits) over all edit sequences, state by state."""

    def with_inserts(best):
        for _ in range(3):
            more = dict(best)
            for q, (cost, edits) in best.items():
                p = 2 if q == 3 else 3
                more[p] = min(more.get(p, (10**9, "")), (cost + 2, edits + "I"))
            best = more
        return best

    best = {0: (0, "")}
    for sign, fault in zip(initials, faults):
        best, after = with_inserts(best), {}
        for q, (cost, edits) in best.items():
            ways = [(q, cost + 3, "D")]
            if fault not in (BLANK, DUPLICATE):
                late = fault == TRUNCATED
                ways += [(2 if q == 3 else 3, cost + 2 + late, "R")]
                ways += [(NEXT[q][sign], cost + late, "K")] if sign in NEXT[q] else []
            for p, total, edit in ways:
                after[p] = min(after.get(p, (10**9, "")), (total, edits + edit))
        best = after
    best = with_inserts(best)
    return min(best[q] for q in (0, 2) if q in best)


def plain(rows):
    """The result for one conversation's damaged rows (turn, role, text), nulls replaced."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = BLANK if not solid else DUPLICATE if (role, text) in seen else TRUNCATED if solid[-1] not in ".!?" else NO_FAULT
        seen.add((role, text))
        faults.append(fault)
    signs = [role[:1] or "?" for _, role, _ in rows]
    cost, audit = cheapest(signs, faults)
    lines, state, at = [], 0, 0
    for edit in audit:
        role, text = (rows[at][1], rows[at][2]) if edit != "I" else ("", "")
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 3 else "user"
        state = NEXT[state][role[0]]
        lines.append(f"{role}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
    count = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_search_finds_the_cheapest_and_least_edits():
    rng = random.Random(1)
    for _ in range(4000):
        n = rng.randint(0, 9)
        signs = "".join(rng.choice("suax") for _ in range(n))
        faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        assert search(signs, faults) == cheapest(signs, faults), (signs, faults)


def test_long_conversation():
    rng = random.Random(2)
    signs = "".join("ua"[i % 2] if rng.random() > 0.05 else rng.choice("sua") for i in range(2000))
    faults = bytes(rng.choice([0] * 17 + [1, 2, 3]) for _ in range(2000))
    assert search(signs, faults) == cheapest(signs, faults)


def result(turns):
    return {r["conv_id"]: tuple(r)[1:] for r in repair.repair_digests(turns).collect()}


def test_odd_rows_equal_the_plain_version(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "User", "", None, "tool"]
    texts = ["Fine.", "Cut", "", None, " \t\n", "Why? \x0b", "End. ", "é!"]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for _ in range(400)
    ] + [(99, 0, "user", "a long one. " * 200_000), (99, 1, "assistant", "Yes.")]
    expected: dict = {}
    for conv, turn, role, text in rows:
        expected.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    df = frame(spark, rows, TURNS).selectExpr("*", "1 as fault", "2 as digest", "3 as kind", "4 as audit", "5 as copy", "6 as mark")
    assert result(df) == {c: plain(r) for c, r in expected.items()}


def test_damage_and_vanished_conversations(spark):
    rng = random.Random(4)
    rows = [(c, t, ("user", "assistant")[t % 2], f"Line {c} {t}{rng.choice('.!?x')}") for c in range(150) for t in range(rng.randint(1, 4))]
    rows += [(None, 1, "user", "Lost."), (5, None, None, None)]
    expected: dict = {}
    for conv, turn, role, text in rows:
        kept = expected.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        mark = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if mark == 0:
            continue
        text = "" if mark == 1 else re.sub("[.!?]", "", text) if mark == 2 else text
        kept += [(turn, "user" if mark == 4 else role, text)] * (2 if mark == 3 else 1)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    got = result(repair.damaged(frame(spark, rows, TURNS), F.crc32(name.cast("binary")) % 20))
    assert got == {c: plain(r) for c, r in expected.items()}
    assert any(not kept for kept in expected.values())


def test_repaired_turns_are_in_order(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "tool", "So."), (2, 0, "user", "")]
    df = frame(spark, rows, TURNS)
    turns = repair.repaired_turns(df, repair.plan_repairs(df)).collect()
    assert [tuple(r) for r in turns] == [
        (1, 0, "user", "Hi."), (1, 1, "assistant", ""), (1, 2, "user", "Again."), (1, 3, "assistant", "So."),
    ]


def test_empty_table(spark):
    assert repair.repair_digests(frame(spark, [], TURNS)).collect() == []
