"""Every registered query over its whole tables, against SQL or a plain version of its own."""

import os
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tablecheck.llm import decontamination, packing
from tablecheck.llm.queries import ORACLE, QUERIES

from .test_lexical import brute as brute_search
from .test_minhash import brute_groups as brute_sets
from .test_simhash import brute_groups, brute_print
from .test_text_operators import bare, brute_edits, lm_tokens
from .test_tokens import check_packing

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


def rows(spark, name):
    return [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return rows(spark, "documents")


def run(spark, start):
    name = next(n for n in QUERIES if n.startswith(start))
    return QUERIES[name](spark, SF_DIR).collect()


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def ids_of(texts, name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_op1(spark, docs):
    ordered = sorted(docs, key=lambda d: d["doc_id"])
    ids = ids_of([d["text"] for d in ordered], "byte_bpe_50k.json")
    starts = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).tolist()
    got = sorted(tuple(r)[:4] for r in run(spark, "op1_"))
    assert got == [(d["doc_id"], s, len(i), crc(i)) for d, s, i in zip(ordered, starts, ids)]


def test_op2(spark):
    import html

    expected = {}
    for p in rows(spark, "pages"):
        inside = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        plain = re.sub(r"</?b>", "", re.sub(r"<(/?p|br|/?h1)>", " ", inside))
        expected[p["page_id"]] = (p["url"], " ".join(html.unescape(plain).split()))
    got = run(spark, "op2_")
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_op3(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF_DIR}/conversations.parquet'")
    got = run(spark, "op3_")
    con.execute(ORACLE["op3_chat_formatting"])
    names = [c[0] for c in con.description]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(con.fetchall())


@pytest.mark.parametrize("start", ["op12_", "op13_"])
def test_equals_its_sql(spark, start):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    got = run(spark, start)
    con.execute(ORACLE[next(n for n in ORACLE if n.startswith(start))])
    names = [c[0] for c in con.description]
    assert got and sorted(tuple(r[n] for n in names) for r in got) == sorted(con.fetchall())


def test_op11(spark, docs):
    expected = brute_sets({d["doc_id"]: d["text"] for d in docs})
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in run(spark, "op11_")} == expected


def test_op12(spark, docs):
    items = {r["item_id"]: r["text"] for r in rows(spark, "benchmark")}
    got = sorted((tuple(r[n] for n in ("item_id", "rank", "doc_id", "score")) for r in run(spark, "op12_")), key=str)
    assert got == brute_search([(d["doc_id"], d["text"]) for d in docs], items)


def test_op4(spark, docs):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    got = run(spark, "op4_")
    assert len(got) == len(docs) and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.97


def test_op5(spark, docs):
    train = Counter(t for d in docs if fold(d["doc_id"], 10) for t in lm_tokens(d["text"]))
    total, distinct = sum(train.values()), len(train)
    got = {r["doc_id"]: r for r in run(spark, "op5_")}
    for d in docs:
        r, t = got[d["doc_id"]], lm_tokens(d["text"])
        base = sum(np.log10((train[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in train for w in t), total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and r["held_out"] == (fold(d["doc_id"], 10) == 0)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op6(spark):
    quality = {r["doc_id"]: r["quality"] for r in rows(spark, "labels")}
    got = run(spark, "op6_")
    held = [r for r in got if r["held_out"] and r["doc_id"] in quality]
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert np.mean([r["predicted"] == quality[r["doc_id"]] for r in held]) >= 0.9


@pytest.fixture(scope="module")
def contaminated(spark, docs):
    items = {b["item_id"]: bare(b["text"]) for b in rows(spark, "benchmark")}
    found = set()
    for d in docs:
        words = bare(d["text"])
        known = set(words)
        for k, item in items.items():
            allowed = decontamination.edits_allowed(len(item), 0.8)
            # An item of which more words are absent than edits are allowed cannot occur.
            if sum(w not in known for w in item) <= allowed and brute_edits(item, words) <= allowed:
                found.add((d["doc_id"], k))
    return found


def test_op7(spark, contaminated):
    assert {(r["doc_id"], r["item_id"]) for r in run(spark, "op7_")} == contaminated


def test_op8(spark, docs):
    prints = [brute_print(d["text"]) for d in docs]
    groups = brute_groups(prints, [d["doc_id"] for d in docs], 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op8_")}
    assert got == {d["doc_id"]: (f"{p:016x}", g) for d, p, g in zip(docs, prints, groups)}


def test_op9(spark, docs):
    got = run(spark, "op9_")
    ids = dict(zip([d["doc_id"] for d in docs], ids_of([d["text"] for d in docs], "word_bpe_49k.json")))
    expected = {(i, k // 2048): (k, len(t[k : k + 2048]), crc(t[k : k + 2048])) for i, t in ids.items() for k in range(0, len(t), 2048)}
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == expected
    assert len(got) == len(expected)
    used = check_packing(got, 2048)
    assert used <= packing.lower_bound(np.array([r["length"] for r in got]), 2048) + 1


def test_op10(spark):
    table = {r["vec_id"]: np.array(r["embedding"], float) for r in rows(spark, "embeddings")}
    ids, matrix = np.array(sorted(table)), np.stack([table[i] for i in sorted(table)])
    got = {}
    for r in run(spark, "op10_"):
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == {i for i in table if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = matrix @ table[q]
        score[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        assert sorted(found) == list(range(1, 21))
        assert all(abs(s - float(table[i] @ table[q])) < 1e-9 for i, s in found.values())
        hits += len({i for i, _ in found.values()} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_pipeline(spark, docs, contaminated):
    """Each stage on what the stage before it kept; the last holds every document left."""
    frame, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), docs
    quality = {r["doc_id"]: r["quality"] for r in rows(spark, "labels")}
    columns = frame.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        frame = stage(spark, frame, SF_DIR)
        assert frame.columns == columns
        after = [r.asDict() for r in frame.collect()]
        ids = {d["doc_id"] for d in after}
        before = {d["doc_id"] for d in kept}
        assert ids <= before and len(after) == len(ids)
        if number == 0:
            known = [i for i in before if i in quality]
            assert np.mean([(i in ids) == (quality[i] == 1) for i in known]) >= 0.95
        elif number == 1:
            assert len(ids) >= 0.98 * len(before)
        elif number == 2:
            groups = brute_groups([brute_print(d["text"]) for d in kept], [d["doc_id"] for d in kept], 3)
            assert ids == set(groups)
        else:
            assert ids == before - {i for i, _ in contaminated}
        kept = after
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packing(packed, 2048)
    tokens = ids_of([d["text"] for d in kept], "word_bpe_49k.json")
    total = Counter()
    for r in packed:
        total[r["doc_id"]] += r["length"]
    assert total == {d["doc_id"]: len(t) for d, t in zip(kept, tokens)}
