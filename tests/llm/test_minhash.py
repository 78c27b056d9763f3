"""MinHash near-duplicates against brute force on all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tablecheck.llm import minhash
from tablecheck.llm.batches import words

from .helpers import DOCS, doc, frame

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def word_set(text):
    """The distinct 2-word shingles of a text, as a plain reading of the definition."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(zip(found, found[1:])) if len(found) > 1 else frozenset(found)


def brute_groups(texts):
    """Smallest reachable id of every id; ``texts`` maps ids to texts."""
    sets = {i: word_set(t) for i, t in texts.items()}
    group = {i: i for i in sets}
    changed = True
    links = [
        (i, j) for i in sets for j in sets
        if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in links:
            least = min(group[i], group[j])
            changed |= group[i] != least or group[j] != least
            group[i] = group[j] = least
    return {i: (len(sets[i]), group[i], group[i] == i) for i in sets}


def edited(rng, parts, share):
    return [("".join(rng.choices(LETTERS, k=6)) if rng.random() < share else w) for w in parts]


def run(df, **options):
    return {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(df, **options).collect()}


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    texts = {}
    for base in range(12):
        parts = ["".join(rng.choices(LETTERS, k=rng.randint(2, 7))) for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(8):
            # Shares around the one at which the similarity of two copies crosses the limit.
            texts[len(texts)] = " ".join(edited(rng, parts, rng.choice([0, 0.01, 0.02, 0.03, 0.05])))
    texts |= {1000: "", 1001: None, 1002: " \t\n", 1003: "One", 1004: "oNE", 1005: "two words", 1006: "TWO\x0bWORDS", 1007: "É x", 1008: "é x"}
    assert run(frame(spark, [doc(i, t) for i, t in texts.items()])) == brute_groups(texts)


def test_large_group_of_near_copies_is_one_chain_of_links(spark):
    rng = random.Random(6)
    parts = ["".join(rng.choices(LETTERS, k=5)) for _ in range(120)]
    texts = {i: " ".join([f"w{i}", *parts, f"v{i}"]) for i in range(300)}
    assert {v[1] for v in run(frame(spark, [doc(i, t) for i, t in texts.items()])).values()} == {0}


def test_groups_and_clusters_in_chunks_lose_no_link(spark):
    rng = random.Random(7)
    parts = ["".join(rng.choices(LETTERS, k=5)) for _ in range(60)]
    texts = {i: " ".join(edited(rng, parts, rng.choice([0.0, 0.02, 0.04]))) for i in range(60)}
    df = frame(spark, [doc(i, t) for i, t in texts.items()]).select("doc_id", "text")
    from pyspark.sql import functions as F

    marked = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(minhash._mark(2), minhash.MARKED)
    reps = marked.dropDuplicates(["d1", "d2"]).withColumn("cls", F.col("doc_id"))
    whole = {tuple(r) for r in minhash.components(minhash.candidates(reps)).collect()}
    cut = minhash.components(minhash.candidates(reps, group_limit=5))
    assert {tuple(r) for r in cut.collect()} == whole
    links = [
        {tuple(r) for r in minhash.components(minhash.verified(df, reps, cut, limit=n)).collect()} for n in (100, 10_000_000)
    ]
    assert links[0] == links[1] and links[0]


def test_odd_rows_and_clashing_columns(spark):
    text = "a b c d e f g h i j k l"
    rows = [(1, text), (1, text), (1, "something else entirely here"), (None, text), (None, "alone and without id"), (7, text + " m")]
    df = frame(spark, rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'x' as d1", "1 as row", "2 as cls", "3 as n", "4 as root", "5 as component_id", "6 as sig", "7 as group"
    )
    got = sorted(map(str, minhash.near_duplicates(df).collect()))
    expected = [(1, 11, 1, True)] * 2 + [(1, 3, 1, True), (None, 11, 1, False), (None, 3, None, False), (7, 12, 1, False)]
    names = ("doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted("Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, e)) + ")" for e in expected)


def test_empty_table(spark):
    assert minhash.near_duplicates(frame(spark, [], DOCS)).collect() == []


def test_very_long_text(spark):
    rng = random.Random(8)
    parts = ["".join(rng.choices(LETTERS, k=6)) for _ in range(200_000)]
    texts = {1: " ".join(parts), 2: " ".join(parts[:-5_000]), 3: " ".join(parts[100_000:])}
    got = run(frame(spark, [doc(i, t) for i, t in texts.items()]))
    assert got == {1: (len(word_set(texts[1])), 1, True), 2: (len(word_set(texts[2])), 1, False), 3: (len(word_set(texts[3])), 3, True)}


def test_posterior_gives_up_rarely_above_the_limit_and_often_below():
    rng = np.random.default_rng(1)
    table = minhash.least_matches()
    assert [k for k, _ in table] == list(range(16, 161, 16)) and all(m < k for k, m in table)
    for similarity, stays in ((0.8, lambda s: s > 0.999), (0.5, lambda s: s < 0.02), (0.3, lambda s: s == 0)):
        sigs = rng.integers(0, 256, (2001, minhash.HASHES), dtype=np.uint8)
        same = rng.random((2000, minhash.HASHES)) < similarity
        sigs[1:] = np.where(same, sigs[0], sigs[1:])
        assert stays(len(minhash.survivors(sigs, 0, np.arange(1, 2001), table)) / 2000), similarity


def test_signatures_estimate_the_similarity():
    rng = random.Random(9)
    parts = ["".join(rng.choices(LETTERS, k=5)) for _ in range(400)]
    texts = [" ".join(parts[:300]), " ".join(parts[50:350])]
    values, starts = minhash.shingle_sets(words(pa.array(texts), lower=True))
    found = minhash.signatures(values, starts, 2000)
    a, b = map(word_set, texts)
    assert np.mean(found[0] == found[1]) == pytest.approx(len(a & b) / len(a | b), abs=0.04)
