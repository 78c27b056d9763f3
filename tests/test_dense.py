"""Bitmaps for references and two-pass uniqueness against plain versions."""

import random
from collections import Counter

import pytest

from tablecheck.operators import bitmaps, keys
from tablecheck.operators.joins import key_match


def plain_integrity(child, parent):
    known = {p for p in parent if p is not None}
    hit = sum(c in known for c in child)
    return len(child), hit, hit / len(child) if child else None


@pytest.mark.parametrize("child_type, parent_type", [("long", "long"), ("int", "long"), ("short", "int"), ("string", "long"), ("double", "double")])
def test_integrity_equals_a_plain_count(spark, child_type, parent_type):
    rng = random.Random(2)
    values = [None, 0, -1, 1, 32767, -32768, *[rng.randint(-32000, 32000) for _ in range(60)]]
    child = [rng.choice(values) for _ in range(500)]
    for parent in (values, values[10:40], [], [None]):
        cast = f"CAST(k AS {child_type}) AS k"
        left = spark.createDataFrame([(v,) for v in child], "k long").selectExpr(cast, "'a' AS n", "1 AS __bits")
        right = spark.createDataFrame([(v,) for v in parent], "k long").selectExpr(f"CAST(k AS {parent_type}) AS p")
        row = bitmaps.integrity(left, right, "k", "p").first()
        assert (row["total"], row["matched"], row["value"]) == plain_integrity(child, parent)
        lost = {r["key"]: r["n"] for r in bitmaps.orphan_keys(left, right, "k", "p").collect()}
        known = set(parent)
        assert {int(k): n for k, n in lost.items()} == Counter(v for v in child if v is not None and v not in known)


def test_far_apart_keys_and_empty_child(spark):
    far = [2**63 - 1, -(2**63) + 1, -(2**63), 2**40, 5]
    child = spark.createDataFrame([(v,) for v in far], "k long")
    parent = spark.createDataFrame([(v,) for v in far[::2]], "p long")
    assert bitmaps.integrity(child, parent, "k", "p").first()["matched"] == 3
    assert sorted(r["k"] for r in bitmaps.orphans(child, parent, "k", "p").collect()) == sorted(far[1::2])
    assert tuple(bitmaps.integrity(child.limit(0), parent, "k", "p").first()) == (0, 0, None)


def shuffled_bytes(df):
    """Bytes that the exchanges of an executed frame wrote."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_dense_keys_move_far_fewer_bytes(spark):
    child = spark.range(1_000_000).selectExpr("id + 1 AS k")
    parent = spark.range(1_000_000).selectExpr("id + 1 AS p")
    whole = key_match(child, parent, "k", "p").groupBy("matched").count()
    assert [tuple(r) for r in whole.collect()] == [(True, 1_000_000)]
    found = bitmaps.integrity(child, parent, "k", "p")
    assert found.first()["value"] == 1.0
    grouped = bitmaps.key_bits(child, parent, "k", "p")
    grouped.collect()
    assert 0 < shuffled_bytes(grouped) < shuffled_bytes(whole) / 50


def test_summary_equals_a_plain_count(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice([None, 1, 2, 3, 40, 50]), rng.choice([None, "", "a", "A", "1:a", "-"]), rng.choice([0.0, -0.0, float("nan"), 1.5, None]), i % 90)
        for i in range(100)
    ]
    df = spark.createDataFrame(rows, "a int, b string, c double, d int").selectExpr("*", "1 AS rule", "2 AS hash", "3 AS key", "4 AS nulls")
    sets = [["a"], ["b"], ["c"], ["d"], ["a", "b"], ["b", "a", "c"], "d"]
    got = [tuple(r) for r in keys.key_summary(df, sets).collect()]
    expected = []
    for names in sets:
        names = [names] if isinstance(names, str) else names
        at = ["abcd".index(c) for c in names]
        whole = [tuple("nan" if isinstance(r[i], float) and r[i] != r[i] else r[i] for i in at) for r in rows]
        counts = Counter(whole)
        full = {k: n for k, n in counts.items() if None not in k and n > 1}
        nulls = sum(all(v is None for v in k) for k in whole)
        some = sum(None in k for k in whole) - nulls
        once = sum(n == 1 and any(v is not None for v in k) for k, n in counts.items())
        expected.append((",".join(names), len(rows), nulls, some, once, len(full), sum(full.values())))
    assert sorted(got) == sorted(expected)


def test_hashes_that_clash_change_nothing(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(keys.F, "xxhash64", lambda c: F.pmod(F.hash(c), F.lit(7)).cast("long"))
    df = spark.range(200).selectExpr("id", "id div 2 AS half", "if(id < 150, id, 7) AS some")
    got = {r["key"]: (r["once"], r["repeated_keys"], r["repeated_rows"]) for r in keys.key_summary(df, ["id", "half", "some"]).collect()}
    assert got == {"id": (200, 0, 0), "half": (0, 100, 200), "some": (149, 1, 51)}


def test_long_texts_whose_hashes_clash(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(keys.F, "xxhash64", lambda c: F.pmod(F.hash(c), F.lit(7)).cast("long"))
    rng = random.Random(8)
    texts = [None, "", "é" * 16, "é" * 17, "x" * 32, "x" * 33, *["y" * 40 + str(i) for i in range(30)], *[str(i) for i in range(30)]]
    rows = [(rng.choice([None, 1, 2]), rng.choice(texts)) for _ in range(150)]
    df = spark.createDataFrame(rows, "a int, b string").withColumn("c", F.encode("b", "UTF-8"))
    got = {r["key"]: tuple(r)[1:] for r in keys.key_summary(df, ["b", "c", ["a", "b"], ["c", "a"]]).collect()}
    for name, whole in {"b": [r[1:] for r in rows], "c": [r[1:] for r in rows], "a,b": rows, "c,a": rows}.items():
        counts = Counter(whole)
        nulls = sum(all(v is None for v in k) for k in whole)
        repeated = [n for k, n in counts.items() if None not in k and n > 1]
        once = sum(n == 1 and any(v is not None for v in k) for k, n in counts.items())
        assert got[name] == (150, nulls, sum(None in k for k in whole) - nulls, once, len(repeated), sum(repeated)), name


def test_keys_without_long_texts_are_moved_once(spark):
    df = spark.range(50_000).selectExpr("id div 2 AS k", "id % 3 AS l", "'d' || id % 5 AS s").repartition(4)
    found = keys.key_summary(df, [["k", "l"], ["k", "s"], "k"])
    assert {r["key"]: r["once"] for r in found.collect()} == {"k,l": 50_000, "k,s": 50_000, "k": 0}
    # Numbers are grouped as numbers: no join with repeated hashes, no key as a text.
    plain = keys.key_summary(df, [["k", "l"], "k"])
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "xxhash64" not in plan and "concat" not in plan


def test_empty_table_and_unfit_types(spark):
    df = spark.createDataFrame([], "a int, b array<int>")
    assert [tuple(r) for r in keys.key_summary(df, ["a"]).collect()] == [("a", 0, 0, 0, 0, 0, 0)]
    assert keys.uniqueness(df, ["a"]).first()["value"] is None
    with pytest.raises(ValueError, match="type that is no key"):
        keys.key_summary(df, ["b"])
