import random

import numpy as np
import pytest
import xxhash

from tablecheck.llm import simhash
from tablecheck.llm.components import components

from .helpers import doc, frame, prose


def brute_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + size]), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(prints, ids, bits):
    label = list(ids)
    while True:
        new = [min(label[j] for j in range(len(ids)) if bin(prints[i] ^ prints[j]).count("1") <= bits) for i in range(len(ids))]
        if new == label:
            return label
        label = new


def rows():
    rng = random.Random(4)
    texts = [prose(rng, "en", rng.choice([4, 40, 300])) for _ in range(60)]
    for base in list(texts[:20]):
        words = base.split()
        words[len(words) // 2] = "changed"
        texts += [base, " ".join(words), base.upper()]
    texts += [None, "", "  \n", "one", "One", "two words", "İSTANBUL ſ \x0b x"]
    return [doc(100 + k, t) for k, t in enumerate(texts)]


def test_against_brute_force(spark):
    table = rows()
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, table)).collect()}
    prints = [brute_print(r[1]) for r in table]
    groups = brute_groups(prints, [r[0] for r in table], 3)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        r[0]: (f"{p:016x}", g) for r, p, g in zip(table, prints, groups)
    }


def test_dense_group_of_prints(spark):
    """A cluster of many fingerprints around one, split over chunks, keeps all its links."""
    rng = np.random.default_rng(2)
    base, found = 0x123456789ABCDEF0, set()
    while len(found) < 700:
        found.add(int(base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False))))
    signed = [p - (1 << 64) if p >> 63 else p for p in found]
    prints = spark.createDataFrame([(p,) for p in signed], "print long")
    links = simhash.links(prints, bits=3, group_limit=90)
    root = {r["node"]: r["root"] for r in components(links).collect()}
    array = np.array(signed, np.int64).view(np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 3
    label = np.array(signed)
    while True:
        new = np.array([label[near[i]].min() for i in range(len(label))])
        if (new == label).all():
            break
        label = new
    assert [root.get(p, p) for p in signed] == label.tolist()


def test_pivots_never_lose_a_link():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    b = a.copy()
    for k in range(500):
        for bit in rng.choice(64, 3, replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    table = np.abs(simhash.pivot_table(a, 24).astype(int) - simhash.pivot_table(b, 24))
    assert table.max() <= 3


def test_one_per_group_keeps_columns(spark):
    table = [doc(1, "a b c d"), doc(2, "a b c d"), doc(2, "a b c d"), doc(3, "other words here"), doc(None, "no id"), doc(None, "no id")]
    df = frame(spark, table).selectExpr("*", "1 as print", "2 as component_id")
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [
        (0, "no id"), (0, "no id"), (1, "a b c d"), (3, "other words here"),
    ]


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.one_per_group(frame(spark, [])).collect() == []


@pytest.mark.parametrize("links,expected", [
    ([], {}),
    ([(1, 1), (None, 2)], {}),
    ([(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9)], {5: 1, 4: 1, 3: 1, 2: 1, 9: 8}),
])
def test_components(spark, links, expected):
    got = components(spark.createDataFrame(links, "u long, v long"))
    assert {r["node"]: r["root"] for r in got.collect()} == expected


def test_one_row_of_a_repeated_id_stays_whatever_the_order(spark):
    rows = [(1, f"text number {k} of one id with its own words {k * 7}") for k in range(30)] + [(2, "another one")]
    df = frame(spark, rows, "doc_id long, text string").selectExpr("*", "map('a', doc_id) as m", "1 as print")
    kept = {tuple(map(str, r)) for n in (1, 3, 7) for r in simhash.one_per_group(df.repartition(n).orderBy("text", ascending=n > 1)).collect()}
    assert len(kept) == 2
