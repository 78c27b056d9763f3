"""Repair of damaged conversations: the cheapest edits that give a well-formed sequence of roles.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.
Its rows are reduced to one code each (initial of the role, fault), and iterative
deepening A* looks for the cheapest edits: depth first, edits in ASCII order of
their initials, under a cost bound that grows until a path is accepted. States
that failed with as much budget are not entered again. As the search is ordered,
the first accepted path is the cheapest and, among those, the ASCII-least.

Spark sorts each conversation's codes together, without texts; the found edits then
meet the texts in a second sorted stream. So a task never holds the texts of a
conversation, only some hundred bytes per row of the one it searches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .batches import ship

DELETE, INSERT, KEEP, REROLE = "DIKR"
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
USER, ASSISTANT = "user", "assistant"
SPACE = " \t\n\x0b\x0c\r"
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Where a sequence of roles may stand, what each initial leads to, and where it may end.
START, AFTER_SYSTEM, AFTER_ASSISTANT, AFTER_USER = range(4)
NEXT = ({"s": AFTER_SYSTEM, "u": AFTER_USER}, {"u": AFTER_USER}, {"u": AFTER_USER}, {"a": AFTER_ASSISTANT})
ACCEPTS = (True, False, True, False)
#: The role that a rerole or an insert gives in each state.
WANTED = ("u", "u", "u", "a")
LEGAL = {"su", "ua", "au"}
CACHED = 100_000

PLAN = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
TURNS = "conv_id long, position long, role string, text string"


def search(initials: str, faults: bytes) -> tuple[int, str]:
    """Cost and edits of the cheapest repair, the ASCII-least among equals.

    The estimate of a state's remaining cost is the deletions that faults force,
    one for each truncated row, and two for each illegal neighbourhood of rows
    that need not go, counted so that no row takes part in two of them: either
    one of its rows is changed or deleted or something is inserted between them.
    """
    n = len(initials)
    forced = [f in (BLANK, DUPLICATE) for f in faults]
    penalty = [TRUNCATED_COST if f == TRUNCATED else 0 for f in faults]
    base = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        base[i] = base[i + 1] + (COSTS[DELETE] if forced[i] else penalty[i])
    staying = [i for i in range(n) if not forced[i]]
    m = len(staying)
    pairs = [0] * (m + 2)
    for k in range(m - 1, -1, -1):
        mine = initials[staying[k]]
        bad = mine + initials[staying[k + 1]] not in LEGAL if k + 1 < m else mine != "a"
        pairs[k] = max(pairs[k + 1], bad + pairs[k + 2])
    first_staying, at = [m] * (n + 1), m
    for i in range(n - 1, -1, -1):
        at -= not forced[i]
        first_staying[i] = at

    def estimate(i: int, q: int) -> int:
        k = first_staying[i]
        if k == m:
            return base[i] + (0 if ACCEPTS[q] else COSTS[INSERT])
        bad = initials[staying[k]] not in NEXT[q]
        return base[i] + 2 * max(pairs[k], bad + pairs[k + 1])

    def edits(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits from a state in ASCII order: initial, cost, next row, next state."""
        if i < n:
            yield DELETE, COSTS[DELETE], i + 1, q
        yield INSERT, COSTS[INSERT], i, NEXT[q][WANTED[q]]
        if i < n and not forced[i]:
            if initials[i] in NEXT[q]:
                yield KEEP, COSTS[KEEP] + penalty[i], i + 1, NEXT[q][initials[i]]
            yield REROLE, COSTS[REROLE] + penalty[i], i + 1, NEXT[q][WANTED[q]]

    bound = estimate(0, START)
    while True:
        failed: dict[tuple[int, int], int] = {}
        over = None
        path: list[str] = []
        stack = [(0, START, 0, edits(0, START))]
        if n == 0:
            return 0, ""
        while stack:
            i, q, spent, rest = stack[-1]
            for edit, cost, j, p in rest:
                total = spent + cost
                least = total + estimate(j, p)
                if least > bound:
                    over = least if over is None else min(over, least)
                    continue
                if failed.get((j, p), -1) >= bound - total:
                    continue
                path.append(edit)
                if j == n and ACCEPTS[p]:
                    return total, "".join(path)
                stack.append((j, p, total, edits(j, p)))
                break
            else:
                failed[i, q] = bound - spent
                stack.pop()
                if path:
                    path.pop()
        # Deleting every row is always accepted, so some bound below that was cut.
        bound = over


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its sorted codes; a conversation may span batches."""
    cache: dict[tuple[str, bytes], tuple[int, str]] = {}
    done: list[tuple] = []
    now, begun = None, False
    initials: list[str] = []
    faults, digests = bytearray(), bytearray()
    low = high = None
    turns = 0

    def close() -> None:
        nonlocal low, high, turns
        if faults:
            # A row whose role and text came before is a duplicate unless it is blank.
            seen = np.frombuffer(bytes(digests), np.dtype([("a", "<u8"), ("b", "<u8")]))
            order = np.argsort(seen, order=("a", "b"), kind="stable")
            again = np.zeros(len(seen), bool)
            again[order[1:]] = seen[order[1:]] == seen[order[:-1]]
            codes = np.frombuffer(bytes(faults), np.uint8).copy()
            codes[again & (codes != BLANK)] = DUPLICATE
            signs, key = "".join(initials), codes.tobytes()
            if (signs, key) not in cache:
                if len(cache) >= CACHED or len(key) > 1000:
                    cache.clear()
                cache[signs, key] = search(signs, key)
            cost, audit = cache[signs, key]
            count = np.bincount(codes, minlength=4)
            illegal = sum(a + b not in LEGAL for a, b in zip(signs, signs[1:]))
            gaps = 0 if low is None else high - low + 1 - turns
            done.append((now, gaps, *[int(count[f]) for f in (BLANK, DUPLICATE, TRUNCATED)], illegal, cost, audit))
        else:
            done.append((now, 0, 0, 0, 0, 0, 0, ""))
        initials.clear()
        faults.clear()
        digests.clear()
        low, high, turns = None, None, 0

    def out() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()]
        columns = list(zip(*done)) if done else [[]] * 8
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in PLAN.split(", ")]
        )

    for batch in batches:
        convs, turn_of, signs, codes, hashes = [batch.column(i).to_pylist() for i in range(5)]
        for conv, turn, sign, code, digest in zip(convs, turn_of, signs, codes, hashes):
            if not begun or conv != now:
                if begun:
                    close()
                now, begun = conv, True
            if code < 0:
                continue
            # A role without an initial fits nowhere, like any other unknown one.
            initials.append(sign or "?")
            faults.append(code)
            digests += digest
            if turn is not None:
                if low is None:
                    low = turn
                turns += turn != high
                high = turn
        if len(done) >= 10_000:
            yield out()
    if begun:
        close()
    yield out()


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest")


def _read(turns: DataFrame) -> DataFrame:
    """The needed columns with their fault, nulls as one space, and a digest of role and text."""
    space = F.lit(" ")
    present = F.col("present") if "present" in turns.columns else F.lit(True)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.coalesce(present, F.lit(True)).alias("present"),
    )
    solid = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(~F.col("present"), F.lit(-1)).when(solid == "", F.lit(BLANK))
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(NO_FAULT))
    )
    # The length of the role keeps role and text apart.
    named = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    return rows.select("*", fault.cast("int").alias("fault"), F.unhex(F.md5(named)).alias("digest"))


def plan_repairs(turns: DataFrame) -> DataFrame:
    """One row per conversation: its faults, and cost and edits of the cheapest repair.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are
    ignored, but for a boolean ``present``: a row for which it is false only names
    its conversation. Rows are taken by turn, null turns first, equal turns by role
    and then by MD5 of role and text. A null role or text counts as one space, and
    a null ``conv_id`` is a conversation like any other. The first fault of a row
    counts: ``blank`` (white space only), ``duplicate`` (role and text came before),
    ``truncated`` (does not end in ``.``, ``!`` or ``?``). ``gaps`` are turns missing
    between the first and the last. ``audit`` has one initial per edit: Delete (3,
    required for blank and duplicate rows), Insert of an empty turn (2), Keep (0),
    Rerole to user or assistant (2); a truncated row that stays costs one more. An
    empty table gives an empty result.
    """
    ship(turns.sparkSession)
    rows = _read(turns).select(
        "conv_id", "turn", F.left("role", F.lit(1)).alias("sign"), "fault", "digest", "role"
    )
    return _ordered(rows).select("conv_id", "turn", "sign", "fault", "digest").mapInArrow(_plans, PLAN)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns, in order; the edits of a conversation come before its rows."""
    audit, at, state, position = "", 0, START, 0
    rows: list[tuple] = []

    def edit(conv, role, text) -> None:
        nonlocal at, state, position
        kind = audit[at]
        at += 1
        if kind == DELETE:
            return
        sign = role[:1] if kind == KEEP else WANTED[state]
        if kind != KEEP:
            role = USER if sign == "u" else ASSISTANT
        state = NEXT[state][sign]
        rows.append((conv, position, role, text))
        position += 1

    def inserts(conv) -> None:
        while at < len(audit) and audit[at] == INSERT:
            edit(conv, "", "")

    def out() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = list(zip(*rows)) if rows else [[]] * 4
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in TURNS.split(", ")])

    for batch in batches:
        size = 0
        for conv, kind, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if kind == 0:
                audit, at, state, position = text, 0, START, 0
            else:
                edit(conv, role, text)
            inserts(conv)
            size += len(text)
            if size > 1 << 22:
                yield out()
                size = 0
        yield out()


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations as rows ``conv_id, position, role, text``.

    ``plans`` are those of :func:`plan_repairs` for the same turns. The rows of a
    conversation lie together in one partition, in the order of ``position``. A
    conversation of which nothing stays has no row.
    """
    ship(turns.sparkSession)
    rows = _read(turns).filter("fault >= 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    none = F.lit(None)
    first = plans.select(
        "conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("binary").alias("digest"), F.col("audit").alias("text"),
    )
    arranged = rows.union(first).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest"
    )
    return arranged.select("conv_id", "kind", "role", "text").mapInArrow(_apply, TURNS)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest = None, None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        ids, hashes = [d[0] for d in done], [d[1] for d in done]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], ["conv_id", "digest"])

    for batch in batches:
        for conv, position, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if position == 0:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256()
            digest.update((("\n" if position else "") + f"{role}:{text}").encode())
        yield out()
    if digest is not None:
        done.append((now, digest.hexdigest()))
    yield out()


def repair_digests(turns: DataFrame) -> DataFrame:
    """The plans of all conversations with ``repaired_sha256``, a digest of the repaired ``role:text`` lines."""
    spark = turns.sparkSession
    path = scratch_path(spark, "repairs")
    plan_repairs(turns).write.parquet(path)
    plans = spark.read.schema(PLAN).parquet(path)
    found = repaired_turns(turns, plans).mapInArrow(_hash, "conv_id long, digest string")
    named = found.withColumnRenamed("conv_id", "__conv")
    joined = plans.join(named, plans["conv_id"].eqNullSafe(named["__conv"]), "left")
    return joined.select(*plans.columns, F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(turns: DataFrame, mark: Column) -> DataFrame:
    """The turns with faults made by ``mark``, a number from 0 on: 0 takes the row out (``present`` is false),
    1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 sets its role to user."""
    space = F.lit(" ")
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return turns.select(
        "conv_id", "turn", mark.alias("mark"),
        F.when(mark == 4, F.lit(USER)).otherwise(role).alias("role"),
        F.when(mark == 1, F.lit("")).when(mark == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(mark == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).select("conv_id", "turn", "role", "text", (F.col("mark") != 0).alias("present"))
