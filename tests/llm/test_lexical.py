"""Ranked lexical search against a plain version that scores every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tablecheck.llm import lexical

from .helpers import DOCS, doc, frame

ITEMS = "item_id long, text string"


def read_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=10):
    """Rows (item, rank, document, score); ``docs`` are (id, text) rows, ``items`` maps ids to texts."""
    counts = [(i, Counter(read_terms(t))) for i, t in docs]
    documents = sum(bool(c) for _, c in counts)
    length = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items.items():
        scored = []
        for i, c in counts:
            if not c:
                continue
            m = 10 + (90 * sum(c.values()) * documents) // length
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(read_terms(text)) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(docs, items, **options):
    return sorted((tuple(r) for r in lexical.search(docs, items, **options).collect()), key=str)


def corpus(rng, n):
    words = [f"{rng.choice('abcdéß東')}{k}" for k in range(400)] + ["The", "the", "of", "A1b2"]
    weights = [1 / (1 + k) for k in range(len(words))]
    return [(i, rng.choice(" ,-_\n").join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    docs = corpus(rng, 400)
    docs += [(1000 + i, docs[3][1]) for i in range(30)]  # more equal scores than ranks
    docs += [(2000, ""), (2001, None), (2002, "?!"), (2003, "the " * 3000)]
    items = {i: " ".join(rng.choices(read_terms(docs[i * 7][1]), k=1 + i % 7)) for i in range(40)}
    items |= {50: docs[3][1], 51: "nowhereseen", 52: "the THE tHe"}
    items[53] = None
    got = run(frame(spark, [doc(*d) for d in docs]), frame(spark, list(items.items()), ITEMS))
    assert got == brute(docs, items)
    # Blocks of few characters give the same.
    assert run(frame(spark, [doc(*d) for d in docs]), frame(spark, list(items.items()), ITEMS), chars=60) == got


def test_odd_rows_and_clashing_columns(spark):
    rows = [(5, "red fox"), (5, "red fox red"), (None, "red fox"), (3, "red fox"), (3, "red fox"), (9, "blue")]
    items = [(1, "red"), (1, "blue"), (1, "red"), (None, "fox"), (2, None)]
    docs = frame(spark, rows, "doc_id long, text string").selectExpr("*", "1 as item", "2 as items", "3 as score", "4 as rank", "5 as term")
    got = run(docs, frame(spark, items, ITEMS).selectExpr("*", "1 as doc_id", "2 as item"))
    assert got == brute(rows, {1: "red blue", None: "fox", 2: None})


def test_empty_tables(spark):
    some, none = frame(spark, [doc(1, "red fox")]), frame(spark, [], DOCS)
    item = frame(spark, [(1, "fox")], ITEMS)
    assert run(none, item) == [] and run(some, frame(spark, [], ITEMS)) == []
    assert [r[:3] for r in run(some, item)] == [(1, 1, 1)]


def test_bounds_never_underrate_and_mostly_leave_out():
    rng = random.Random(4)
    docs = corpus(rng, 500)
    found = lexical.terms(pa.array([t for _, t in docs]))
    text, code, tf = lexical.occurrences(found)
    query = lexical.read_query([1, 2, 3], ["a0 b1 the", docs[9][1], docs[4][1]])
    query = query._replace(weights=np.full(len(query.vocab), 700), documents=500, length=len(found.codes))
    flat, at = lexical.max_sketches(found, text, code, tf)
    n, pairs = np.diff(found.starts), np.meshgrid(np.arange(500), np.arange(3), indexing="ij")
    exact = lexical.exact_scores(query, found, pairs[0].ravel(), pairs[1].ravel()).reshape(500, 3)
    bounds = np.zeros_like(exact)
    for d in range(500):
        if n[d]:
            bounds[d] = lexical.upper_bounds(query, flat[at[d] : at[d + 1]][None, :], n[d : d + 1])[0]
    assert (bounds >= exact).all()
    assert np.mean(bounds == exact) > 0.8


def test_very_long_text_and_frequent_term(spark):
    docs = [(1, "x " * 600_000 + "needle"), (2, "needle hay"), (3, " ".join(f"w{i}" for i in range(300_000)))]
    items = {1: "needle x", 2: "w7 w299999"}
    assert run(frame(spark, [doc(*d) for d in docs]), frame(spark, list(items.items()), ITEMS)) == brute(docs, items)
