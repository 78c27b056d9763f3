import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablecheck.llm import packing, simple8b
from tablecheck.llm.tokens import Encoder

from .helpers import doc, frame, prose

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [None, "", " ", "\n\n", " a", "a ", "a  b", "a \n b", "don't 'twas", "x y 　 z", "<|endoftext|> a", "\x1c a \x1c", " a  b", "é ﬁ İ"]

ODD += ["a\n\n b", "a\n\nb", "a,\n\n\nb. c", "it's, isn't.", "x-y (z)", "a.\n b\n\n\n c"]


def reference(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
def test_pieces_equal_whole_texts(path, spaced):
    rng = random.Random(1)
    letters = list(" \n\n\t .,'sté1À|　\xa0\x1c<>$")
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    found = Encoder(path, spaced).block(pa.array([t or "" for t in texts], pa.string()))
    for k, text in enumerate(texts):
        assert found.ids[found.starts[k] : found.starts[k + 1]].tolist() == reference(path, text), repr(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=600))
def test_simple8b_round_trip(values):
    ids = np.array(values, np.uint64)
    words, skips, escapes = simple8b.pack(ids)
    assert simple8b.unpack(words, len(ids), escapes).tolist() == values
    assert len(skips) == -(-len(words) // simple8b.STRIDE)


def test_skips_give_places():
    ids = np.random.default_rng(3).integers(0, 50_000, 5000).astype(np.uint64)
    words, skips, escapes = simple8b.pack(ids)
    for k, before in enumerate(skips.tolist()):
        n = (skips[k + 1] if k + 1 < len(skips) else len(ids)) - before
        part = simple8b.unpack(words[k * simple8b.STRIDE : (k + 1) * simple8b.STRIDE], int(n))
        assert part.tolist() == ids[before : before + n].tolist()


def test_files_in_document_order(spark, tmp_path):
    rng = random.Random(2)
    table = [doc(i, prose(rng, "fr", rng.randint(0, 60))) for i in rng.sample(range(1000), 80)] + [doc(2000 + k, t) for k, t in enumerate(ODD)]
    table += [doc(5000, "same id"), doc(5000, "same id")]
    path = str(tmp_path / "ids")
    df = frame(spark, table).selectExpr("*", "1 as shard", "2 as ids")
    simple8b.write_ids(df.repartition(5), path, BYTE)
    got = sorted(simple8b.digests(spark, path).collect(), key=lambda r: r["start"])
    at, expected = 0, []
    for i, text, *_ in sorted(table, key=lambda r: r[0]):
        ids = reference(BYTE, text)
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r) for r in got] == expected
    back = {r["doc_id"]: list(r["ids"]) for r in simple8b.read_ids(spark, path).collect()}
    assert back[5000] == reference(BYTE, "same id") and back[2000] == [0]


def test_empty_file(spark, tmp_path):
    path = str(tmp_path / "none")
    simple8b.write_ids(frame(spark, []), path, BYTE)
    assert simple8b.digests(spark, path).collect() == []


def check_packing(rows, length):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence)


@pytest.mark.parametrize("part_pieces", [10_000, 40])
def test_packing_reaches_its_bound(spark, part_pieces):
    rng = random.Random(6)
    rows = [(i, 0, 0, rng.choice([2048, 1500, 1100, 700, 400, 90, rng.randint(1, 2048)]), i) for i in range(600)]
    packed = packing.pack(spark.createDataFrame(rows, packing.PIECES), 2048, part_pieces).collect()
    assert sorted(r["doc_id"] for r in packed) == list(range(600))
    used, bound = check_packing(packed, 2048), packing.lower_bound(np.array([r[3] for r in rows]), 2048)
    assert bound <= used <= bound * (1.02 if part_pieces > 600 else 1.06)


def test_exchange_saves_sequences(spark):
    rng = random.Random(8)
    rows = [(i, 0, 0, rng.randint(200, 900), i) for i in range(800)]
    df = spark.createDataFrame(rows, packing.PIECES)
    apart = packing.PART_PIECES and sum(
        int(packing.best_fit(np.array([r[3] for r in rows[k::20]]), 2048).max()) + 1 for k in range(20)
    )
    assert check_packing(packing.pack(df, 2048, 40).collect(), 2048) <= apart


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_lower_bound_is_one(lengths):
    """Never above the true least number of bins, found by trying all ways."""
    best = [len(lengths)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[k] <= 30:
                bins[b] += lengths[k]
                place(k + 1, bins)
                bins[b] -= lengths[k]
        place(k + 1, bins + [lengths[k]])

    place(0, [])
    bound = packing.lower_bound(np.array(lengths), 30)
    fit = int(packing.best_fit(np.array(lengths), 30).max()) + 1
    assert bound <= best[0] <= fit


def test_packing_documents(spark):
    rng = random.Random(7)
    long = prose(rng, "en", 3000)
    table = [doc(1, long), doc(2, None), doc(3, ""), doc(4, "The River"), doc(4, "The River"), doc(None, "no id")]
    rows = packing.pack_documents(frame(spark, table).selectExpr("*", "1 as piece"), WORD).collect()
    check_packing(rows, 2048)
    ids = reference(WORD, long)
    own = sorted((r for r in rows if r["doc_id"] == 1), key=lambda r: r["piece"])
    assert [(r["start"], r["length"], r["ids_crc32"]) for r in own] == [
        (k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048)
    ]
    assert sorted(r["length"] for r in rows if r["doc_id"] in (2, 3)) == [1, 1]
    assert sum(r["doc_id"] == 4 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 1
    assert packing.pack_documents(frame(spark, []), WORD).collect() == []


def test_exchange_groups_stay_bounded(spark):
    """Lengths of which no partition meets its bound: nearly every sequence is given back at every level."""
    rng = random.Random(10)
    rows = [(i, 0, 0, rng.randint(570, 819), i) for i in range(24_000)]
    packed = packing.pack(spark.createDataFrame(rows, packing.PIECES), 2048, 1000).collect()
    assert sorted(r["doc_id"] for r in packed) == list(range(24_000))
    check_packing(packed, 2048)
    groups = Counter(r["sequence_id"] >> 32 for r in packed)
    assert max(groups.values()) <= 1.5 * packing.GROUP_PARTS * 1000
