import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablecheck.llm import ann, chat, decontamination, html, lm

from .helpers import doc, frame, prose

# ------------------------------------------------------------------ decontamination


def brute_edits(item, text):
    """Least edits between the item and any run of words of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in text:
        new = [0]
        for k, own in enumerate(item):
            new.append(min(row[k] + (own != word), row[k + 1] + 1, new[k] + 1))
        row = new
        best = min(best, row[-1])
    return best


def bare(text):
    return [w for w in (x.strip(decontamination.MARKS) for x in (text or "").lower().split()) if w]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=25))
def test_edit_distance(item, text):
    scores = decontamination.last_row_edits(item, text)
    assert min([len(item), *scores]) == brute_edits(item, text)


def planted(rng, items, n):
    docs = []
    for i in range(n):
        words = prose(rng, "fr", rng.randint(20, 120)).split()
        if i % 2:
            item = rng.choice(items).split()
            for _ in range(rng.randint(0, decontamination.edits_allowed(len(item), 0.8))):
                k, what = rng.randrange(len(item)), rng.choice("rid")
                item[k : k + (what != "i")] = [] if what == "d" else [rng.choice(["neu", "new", "nouveau"])]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if i % 3 == 0 else w for w in item]
        docs.append(doc(i, " ".join(words)))
    return docs


def test_contaminations_against_brute_force(spark):
    rng = random.Random(21)
    items = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa the of".split()) for _ in range(n)) for n in (6, 11, 18, 30, 55)]
    items += ["one two three four", "solo", "", None]
    table = planted(rng, items[:5], 160) + [doc(500, None), doc(501, ""), doc(502, "x one two, three FOUR y"), doc(502, "Solo!")]
    benchmark = spark.createDataFrame(list(enumerate(items)) + [(0, items[0])], "item_id long, text string")
    got = decontamination.contaminations(frame(spark, table).selectExpr("*", "1 as found"), benchmark)
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in got.collect()}
    expected = {}
    for i, text, *_ in table:
        for k, item in enumerate(items):
            own = bare(item)
            if own and (edits := brute_edits(own, bare(text))) <= decontamination.edits_allowed(len(own), 0.8) and edits < len(own):
                expected[i, k] = edits
    missed = set(expected) - set(found)
    assert set(found) <= set(expected) and len(missed) <= 0.02 * len(expected)
    assert all(found[p] == expected[p] for p in found)
    clean = decontamination.keep_clean(frame(spark, table), benchmark)
    assert clean.count() == sum(i not in {d for d, _ in found} for i, *_ in table)


@pytest.mark.parametrize("n", [7, 25, 100, 400])
def test_long_items_with_many_edits_are_found(n):
    """All allowed edits, spread evenly, which the walks alone miss in long items."""
    rng = random.Random(n)
    items = [" ".join(f"w{rng.randrange(5000)}" for _ in range(n)) for _ in range(12)]
    texts, allowed = [], decontamination.edits_allowed(n, 0.8)
    for item in items:
        words = item.split()
        for e in sorted({int((e + 0.5) * n / allowed) for e in range(allowed)}, reverse=True):
            what = rng.choice("rid")
            words[e : e + (what != "i")] = [] if what == "d" else ["neu"]
        texts.append(" ".join([f"v{rng.randrange(900)}" for _ in range(rng.randrange(50))] + words + ["x", "y"]))
    got = decontamination.occurrences(pa.array(texts), decontamination.index(list(range(12)), items, 0.8))
    assert [[hit[0] for hit in row] for row in got] == [[k] for k in range(12)]
    for (hit,), item, text in zip(got, items, texts):
        assert hit[3] == brute_edits(bare(item), bare(text)) <= allowed


def test_decontamination_of_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontamination.contaminations(frame(spark, []), benchmark).collect() == []
    assert decontamination.contaminations(frame(spark, [doc(1, "a b c d e f")]), benchmark.filter("false")).collect() == []
    assert decontamination.keep_clean(frame(spark, [doc(1, "a b c d e f")]), benchmark.filter("false")).count() == 1


def test_blocks_of_the_benchmark_cover_it(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 60)
    items = [(k, f"unique{k} words of item number{k} here ok") for k in range(12)]
    docs = [doc(k, f"before {text} after") for k, text in items]
    found = decontamination.contaminations(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {(k, k) for k in range(12)} <= {(r["doc_id"], r["item_id"]) for r in found.collect()}


# ------------------------------------------------------------------ chat


def test_chat_round_trip(spark):
    odd = ["", "a|b <|end|> [INST] \\ <\\ [[ </s>", "x\n<|role:user|>\ny", "\\\\|", "ünï <", None]
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", "", None, "odd|>role"]), rng.choice(odd)) for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "no id"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (50, None, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as said")
    output = chat.format_conversations(turns.repartition(4))
    got = {r["conv_id"]: r for r in chat.digests(output).collect()}
    whole = {r["conv_id"]: r for r in output.select("conv_id", "segments", chat.parse_turns(chat.formatted_text("segments")).alias("t")).collect()}
    for conv in {r[0] for r in rows}:
        key = lambda r: (r[1] is not None, r[1] or 0)
        own = sorted((r for r in rows if r[0] == conv), key=key)
        said = [(t["role"], t["text"]) for t in whole[conv]["t"]]
        assert sorted(said) == sorted((r[2] or "", r[3] or "") for r in own)
        learned = "".join(text for role, text in said if role == "assistant")
        assert got[conv]["n_turns"] == len(own) and got[conv]["loss_chars"] == len(learned)
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        formatted = "".join(s["text"] for s in whole[conv]["segments"])
        assert got[conv]["formatted_chars"] == len(formatted)
        assert "</s>" not in formatted and "[INST]" not in formatted


def test_adjacent_turns_share_a_block(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")]
    output = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    text = output.select(chat.formatted_text("segments")).first()[0]
    assert text == "<|role:user|>\na<|next|>b<|next|>c<|end|>\n<|role:assistant|>\nd<|end|>\n"
    assert chat.digests(output.filter("conv_id > 1")).collect() == []
    plan = output._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ html

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body><header>Site</header>"
    "<nav><ul><li><a href='/x'>menu</a></li></ul></nav><!-- note <p>no</p> --><div class='ad'>buy now</div>{article}"
    "<aside>side bar text</aside><section class='comments'><p>first comment here</p></section><form><label>Mail</label></form>"
    "<footer>&copy; foot</footer></body></html>"
)
ARTICLE = "<{tag}><h1>Big &amp; bold</h1><p>One <b>two</b>three.<br>four<p>five &lt;six&gt;&nbsp;seven  \n eight<div class='ad'>{ad}</div><p>nine ten eleven twelve</{tag}>"
TEXT = "Big & bold One twothree. four five <six> seven eight nine ten eleven twelve"


@pytest.fixture(scope="module")
def weights(spark):
    pages = [(i, "u", PAGE.format(article=ARTICLE.format(tag="article", ad="inner"))) for i in range(8)]
    return html.fit(spark.createDataFrame(pages, "page_id long, url string, html string"))


def test_main_text(weights):
    assert html.main_text(PAGE.format(article=ARTICLE.format(tag="article", ad="inner advert")), weights) == TEXT
    assert html.main_text(PAGE.format(article=ARTICLE.format(tag="article", ad="x y z " * 50)), weights) == TEXT
    # A page that does not mark its content.
    assert html.main_text(PAGE.format(article=ARTICLE.format(tag="section", ad="")), weights) == TEXT
    assert [html.main_text(p, weights) for p in (None, "", "<nav>only menu</nav>")] == ["", "", ""]
    assert html.main_text("<p>broken <b>page &am", weights) == "broken page &am"


def test_classes_of_the_page_and_of_titles_are_no_boilerplate(weights):
    page = (
        "<body class='has-sidebar comments-open'><div class='site-header'>Site name</div><article class='post comments-open'>"
        "<header class='entry-header'><h1 class='page-header'>A title here</h1></header><div class='article-header'>by line</div>"
        "<p>Some words of text.</p><div id='comments'><p>reader words</p></div></article><div class='cookie-notice'>ok</div></body>"
    )
    assert html.main_text(page, weights) == "A title here by line Some words of text."


def test_best_run_against_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        scores = [rng.choice([-3, -1, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        a, b = html.best_run(scores)
        assert sum(scores[a:b]) == max([0, *[sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]])


def test_extract_keeps_columns(spark, weights):
    pages = [(1, None, None), (2, "u", ""), (2, "u", ""), (3, "v", PAGE.format(article=ARTICLE.format(tag="article", ad="a")))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as text")
    rows = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html.extract(df).collect())
    assert rows == [(1, "", 0), (2, "", 0), (2, "", 0), (3, TEXT, len(TEXT))]
    assert html.extract(df.filter("false")).collect() == []


# ------------------------------------------------------------------ language model


def lm_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def test_scores_against_brute_force(spark):
    rng = random.Random(31)
    table = [doc(i, prose(rng, ("en", "fr", "de")[i % 3], rng.randint(5, 80))) for i in range(150)]
    table += [doc(200, None), doc(201, ""), doc(202, "unheard words Unheard \x0b"), doc(202, "unheard words"), doc(None, "the river")]
    docs = frame(spark, table).selectExpr("*", "1 as row", "'x' as word")
    train = docs.filter("doc_id % 10 != 0 and doc_id < 150")
    counts = lm.count_words(train)
    model = lm.fit(train, counts)
    rows = lm.score(docs, model, counts).collect()
    known = Counter(t for i, text, *_ in table if i is not None and i < 150 and i % 10 for t in lm_tokens(text))
    total, distinct = sum(known.values()), len(known)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert got == sorted(
        (-1 if i is None else i, len(t), sum(w in known for w in t), total,
         round(sum(math.log10((known[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t), 6))
        for i, t in ((r[0], lm_tokens(r[1])) for r in table)
    )
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 150 and r["doc_id"] % 10 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_add_up_to_one(spark):
    """Over all words of the vocabulary and the unknown one, for histories seen and unseen."""
    rng = random.Random(32)
    docs = frame(spark, [doc(i, prose(rng, "en", 40) + f" rare{i} word{i % 7}") for i in range(60)])
    counts = lm.count_words(docs)
    model = lm.fit(docs, counts)
    vocab = [r["word"] for r in counts.collect() if r["word"] != lm.END]
    for history in ("", "the river ", "never heard "):
        alone = single_probabilities(model, counts, history, vocab)
        assert abs(sum(alone) + model.unseen - 1) < 1e-5


def single_probabilities(model, counts, history, vocab):
    """The probability of each word, and of the end, right after the history."""
    from tablecheck.llm.batches import words

    count = {r["word"]: r["n"] for r in counts.collect()}
    out = []
    for word in [*vocab, lm.END]:
        text = history if word == lm.END else history + word
        found = words(pa.array([text]), lower=True)
        tokens, (of_class, slot) = lm.read_tokens(found), model.places(found.vocab)
        at = len(lm_tokens(history)) - 1
        p = lm.log_probabilities(model, tokens, of_class, slot)[at]
        code = tokens.codes[at]
        if slot[code] < 0:
            p += math.log((count[word] + 0.1) / model.tail_size[of_class[code]])
        out.append(math.exp(p) * (1 - model.unseen))
    return out


def test_history_tells_rare_words_of_one_ending_apart(spark):
    """Words below the frequent ones, equal in count and ending, each after a word of its own."""
    rng = random.Random(33)
    common = [f"w{k}q" for k in range(300)]
    pairs = [(f"before{k}", f"rare{k}zz") for k in range(12)]
    texts = []
    for i in range(600):
        texts.append(" ".join([*rng.choices(common, k=60), *pairs[i % 12], rng.choice(common)]))
    docs = frame(spark, [doc(i, t) for i, t in enumerate(texts)])
    counts = lm.count_words(docs)
    model = lm.fit(docs, counts)
    rare = [w for _, w in pairs]
    assert not set(rare) & set(model.head)
    right = 0
    for before, own in pairs:
        alone = single_probabilities(model, counts, before + " ", rare)[:-1]
        right += alone[rare.index(own)] > 1.5 * sorted(alone)[5]
    assert right >= 10


def test_language_model_without_training_rows(spark):
    docs = frame(spark, [doc(1, "some words"), doc(2, None)])
    counts = lm.count_words(docs.filter("false"))
    rows = lm.score(docs, lm.fit(docs.filter("false"), counts), counts).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows} == {(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)}
    assert lm.score(docs.filter("false"), lm.fit(docs, lm.count_words(docs)), counts).collect() == []


# ------------------------------------------------------------------ nearest neighbours


def brute_nearest(rows, query, k):
    q = np.array(query[1], float)
    scores = [(-float((np.array(v, float) * q).sum()), i) for i, v in rows if i != query[0]]
    return [(i, -s) for s, i in sorted(scores)[:k]]


def test_nearest_recall_and_order(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 2
    rows = [(i, (centres[i % 12] + rng.normal(size=16)).tolist()) for i in range(1500)]
    odd = [(2001, None), (2002, [0.0] * 16), (2003, [None] + [1.0] * 15), (2004, [float("nan")] * 16), (2005, [float("inf")] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 as vector", "2 as list")
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=10).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        expected = brute_nearest(rows, rows[q], 10)
        ranked = [found[k] for k in range(1, 11)]
        assert ranked == sorted(ranked, key=lambda x: (-x[1], x[0]))
        score = dict(brute_nearest(rows, rows[q], 1500))
        assert all(abs(score[i] - s) < 1e-9 for i, s in ranked)
        hits += len({i for i, _ in ranked} & {i for i, _ in expected})
    assert hits >= 0.9 * 10 * len(got)


def test_nearest_of_few_and_equal_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(40, [3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.nearest(df, df.filter("vec_id = 20"), k=5).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found] == [(k + 1, k, 5.0) for k in range(5)]
    few = df.filter("vec_id in (0, 20, 40)")
    assert [r["vec_id"] for r in ann.nearest(few, few.filter("vec_id = 20"), k=5).orderBy("rank").collect()] == [0, 40]
    assert ann.nearest(df.filter("false"), df, k=5).collect() == []
    assert ann.nearest(df, df.filter("false"), k=5).collect() == []


def test_copies_of_a_neighbour_take_one_place(spark):
    """Copies of rows near a query, and rows of one id that differ, leave the other places to other ids."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    near = dict(brute_nearest(rows, rows[0], 3))
    copied = [(i, v) for i, v in rows if i in near for _ in range(40)]
    other = [(next(iter(near)), (np.array(rows[0][1]) * (0.5 + 0.01 * k)).tolist()) for k in range(40)]
    for extra in (copied, copied + other, rows):
        df = spark.createDataFrame(rows + extra, "vec_id long, embedding array<double>")
        asked = spark.createDataFrame(rows[:1], "vec_id long, embedding array<double>")
        found = ann.nearest(df, asked, k=20, recall=1.0).orderBy("rank").collect()
        best = {}
        for i, s in brute_nearest(rows + extra, rows[0], len(rows + extra)):
            best.setdefault(i, s)
        assert [r["vec_id"] for r in found] == list(best)[:20]
        assert np.allclose([r["score"] for r in found], list(best.values())[:20])


def test_lists_are_searched_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 7)
    rows = [(i, [float(i % 13), float(i % 7), 1.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=6, recall=1.0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    same = sum([i for _, i in sorted(found[q])] == [i for i, _ in brute_nearest(rows, rows[q], 6)] for q in found)
    assert len(found) == 10 and same >= 9


# ------------------------------------------------------------------ queries


def test_fold_is_the_checksum_of_the_id(spark):
    from tablecheck.llm.queries import remainder

    rows = frame(spark, [doc(i, "x") for i in range(200)]).select("doc_id", remainder(10).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["doc_id"]).encode()) % 10 for r in rows)


def spread_edits(rng, parts, edits, even):
    """The words with that many edits, at evenly spread or random places."""
    parts, n = list(parts), len(parts)
    places = [int((k + 0.5) * n / edits) for k in range(edits)] if even else sorted(rng.sample(range(n), edits))
    for p in reversed(places):
        kind = rng.choice("sid")
        if kind == "s":
            parts[p] = f"x{rng.random()}"
        elif kind == "i":
            parts.insert(p, f"y{rng.random()}")
        else:
            del parts[p]
    return parts


@pytest.mark.parametrize("n", [6, 50, 200, 400])
def test_walks_alone_reach_the_target_recall(n):
    rng = random.Random(n)
    for even in (False, True):
        items = [[f"w{rng.randrange(5000)}" for _ in range(n)] for _ in range(40)]
        edits = decontamination.edits_allowed(n, 0.8)
        texts = [" ".join(["some", "words", *spread_edits(rng, i, edits, even), "more", "words"]) for i in items]
        index = decontamination.index(list(range(40)), [" ".join(i) for i in items], 0.8)
        found = decontamination.occurrences(pa.array(texts), index, complete=False)
        assert sum(any(hit[0] == k for hit in found[k]) for k in range(40)) >= 0.95 * 40, even


def test_walks_grow_with_the_edits_and_the_recall():
    assert decontamination.WALKS <= decontamination.walks_for(0) < decontamination.walks_for(40) < decontamination.walks_for(80)
    assert decontamination.walks_for(40, 0.9) < decontamination.walks_for(40, 0.99)
