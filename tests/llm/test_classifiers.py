import random

import numpy as np
import pyarrow as pa
import pytest

from tablecheck.llm import langid, quality

from .helpers import doc, frame, junk, prose


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(240):
        lang = ("en", "fr", "de")[i % 3]
        bad = i % 5 == 0
        rows.append(doc(i, junk(rng, rng.randint(30, 200)) if bad else prose(rng, lang, rng.randint(30, 300)), lang))
        labels.append((i, 0 if bad else 1, 0))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


ODD = [doc(900, None, None), doc(901, "", None), doc(902, "12 34 ...", None), doc(903, "the " * 30_000, None), doc(904, "a", None)]


def test_quality_on_rows_it_did_not_learn(spark, corpus):
    docs, labels = corpus
    model = quality.fit(docs, labels.filter("doc_id % 4 != 2"))
    scored = docs.select("doc_id", quality.score_column(model, "text").alias("score")).join(labels, "doc_id").filter("doc_id % 4 = 2")
    rows = scored.collect()
    assert rows and all((r["score"] >= 0.5) == (r["quality"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_keeps_good_rows_and_columns(spark, corpus):
    docs, labels = corpus
    odd = docs.selectExpr("*", "1 as score", "2 as __id")
    kept = quality.keep_good(odd, labels.union(labels))
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(240) if i % 5]


def test_quality_without_labels_or_rows(spark, corpus):
    docs, labels = corpus
    none, ones = labels.filter("doc_id < 0"), labels.filter("quality = 1")
    assert quality.keep_good(docs, none).count() == 240
    for some, value in ((none, 0.5), (ones, 1.0), (labels.selectExpr("doc_id", "cast(null as int) quality"), 0.5)):
        model = quality.fit(docs, some)
        assert {r[0] for r in docs.select(quality.score_column(model, "text")).collect()} == {value}
    model = quality.fit(docs, labels)
    scores = [r[0] for r in frame(spark, ODD).select(quality.score_column(model, "text")).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert frame(spark, []).select(quality.score_column(model, "text")).collect() == []


def test_density_equals_the_formula():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 4)) @ rng.normal(size=(4, 4))
    spread = x.var(axis=0)
    g = quality.gaussian(x, 0.3, spread)
    cov = (50 * np.cov(x, rowvar=False, bias=True) + 4 * np.diag(spread)) / 54
    cov = 0.7 * cov + 0.3 * np.diag(np.diag(cov)) + 0.01 * np.diag(spread)
    centred = x - x.mean(axis=0)
    expected = -0.5 * np.einsum("ij,jk,ik->i", centred, np.linalg.inv(cov), centred) - 0.5 * np.linalg.slogdet(cov)[1]
    assert np.allclose(g.log_density(x), expected)


def test_statistics_of_single_texts_equal_those_of_a_block():
    texts = ["A b. c", "", "x  x x\n$$$ !!", "Ünï 12"]
    whole = quality.statistics(pa.array(texts))
    assert np.allclose(whole, np.concatenate([quality.statistics(pa.array([t])) for t in texts]))


def test_language_on_rows_it_did_not_learn(spark, corpus):
    docs = corpus[0].filter("doc_id % 5 != 0")
    model = langid.fit(docs.filter("doc_id % 3 != 1 or doc_id % 2 = 0"))
    rows = docs.select("lang", langid.language_column(model, "text").alias("f")).collect()
    assert all(r["f"]["lang"] == r["lang"] and 0 <= r["f"]["score"] <= 1 for r in rows)
    assert sum(r["f"]["accepted"] for r in rows) >= 0.98 * len(rows)
    odd = {r["doc_id"]: r["f"] for r in frame(spark, ODD).select("doc_id", langid.language_column(model, "text").alias("f")).collect()}
    assert all((odd[i]["lang"], odd[i]["score"], odd[i]["accepted"]) == ("und", 0.0, False) for i in (900, 901, 902))
    assert odd[903]["lang"] == "en" and odd[904]["lang"] in ("en", "fr", "de")


def test_language_without_anything_to_learn(spark):
    none = frame(spark, ODD)
    assert langid.fit(none).langs == []
    assert langid.keep_identified(none).count() == 5
    found = none.select(langid.language_column(langid.fit(none), "text").alias("f")).collect()
    assert {r["f"]["lang"] for r in found} == {"und"}
    assert langid.keep_identified(frame(spark, [])).collect() == []


def test_word_scores_equal_a_plain_mean():
    rng = np.random.default_rng(3)
    bits = 8
    table = np.concatenate([rng.normal(size=(1 << bits, 3)), np.zeros((1, 3))]).astype(np.float32)
    vocab = pa.array(["a", "longer", "día", "x" * 40])
    got = langid.word_scores(vocab, table, bits)
    grams, starts, whole = langid.ngram_buckets(vocab, bits)
    for k in range(len(vocab)):
        own = [whole[k]] + [b for bucket in grams for b in bucket[starts[k] : starts[k + 1]] if b < 1 << bits]
        framed = len(vocab[k].as_py().encode()) + 2
        assert len(own) == 1 + sum(max(framed - n + 1, 0) for n in langid.SIZES)
        assert np.allclose(got[k], table[own].mean(axis=0), atol=1e-5)
