"""Ranked lexical search by hashed max-sketches.

A document's score for an item sums, over the item's terms, the term's weight
times an impact that grows with the term's occurrences in the document. Each
document gets a small sketch: its terms are hashed to coordinates, twice, and a
coordinate keeps the largest number of occurrences of the terms that fall on it
(for one document impacts grow with occurrences, so this is the maximum of the
impacts too). Looking an item's terms up in the sketch, and taking the smaller
coordinate of the two, can only overrate them, so the sum is an upper bound.

The texts are read once to write the sketches. All items of a block look their
terms up in batches of sketches. The documents with the highest bounds are
scored exactly from their texts; the last of the wanted ranks gives a threshold,
and every document whose bound reaches it is scored exactly too. So no document
that belongs in the result is missed, whatever the hashing does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import scratch_path
from .batches import Words, bytes_of, encode, hash_words, ship, text_blocks

#: Characters of item texts that are searched for at once.
ITEM_CHARS = 2_000_000
#: A sketch row has at least this many coordinates per distinct term.
SPARSE = 8
LEAST_SIZE = 256
#: The first threshold comes from this many times the wanted ranks, those with the highest bounds.
FIRST = 4
#: The largest number of occurrences a coordinate tells apart; beyond it the impact's limit counts.
MOST = 255
#: Scale of an impact and its limit, and the parts of a document's length norm.
SCALE, LIMIT = 1_000_000_000, 1_000_000
FLAT, SLOPE = 10, 90
NO_ID = np.iinfo(np.int64).max
CELLS = 1 << 21
KEPT = 1 << 18
#: Numbers of a table of wanted documents that may be sent to every executor.
SENT = 2_000_000

SKETCH = "doc_id long, n long, sketch binary, term int, df long"
WANTED = "doc_id long, items array<int>"
BOUND = "item int, doc_id long, bound long"
SCORE = "item int, doc_id long, score long"

_FOLD = np.full(256, 32, np.uint8)
for _low, _high, _to in ((0x30, 0x39, 0x30), (0x41, 0x5A, 0x61), (0x61, 0x7A, 0x61), (0x80, 0xFF, 0x80)):
    _FOLD[_low : _high + 1] = np.arange(_to, _to + _high - _low + 1)


def terms(texts: pa.Array) -> Words:
    """Runs of ASCII letters and digits and characters beyond ASCII; A-Z only is folded."""
    raw, at = bytes_of(texts)
    folded = pa.StringArray.from_buffers(len(texts), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(_FOLD[raw]))
    lists = pc.ascii_split_whitespace(folded)
    offsets = lists.offsets.to_numpy()
    return encode(lists.flatten(), offsets - offsets[0])


def occurrences(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term code and number of occurrences, one entry for each distinct term of a text."""
    width = max(len(found.vocab), 1)
    key, tf = np.unique(found.of_text() * width + found.codes, return_counts=True)
    return key // width, key % width, tf


class Query(NamedTuple):
    """The items of a block: ids, distinct terms with their hashes and weights, and each item's terms."""

    ids: list
    vocab: pa.Array
    first: np.ndarray
    second: np.ndarray
    starts: np.ndarray
    flat: np.ndarray
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 1

    def norms(self, n: np.ndarray) -> np.ndarray:
        return FLAT + (SLOPE * n * self.documents) // max(self.length, 1)


def read_query(ids: list, texts: list[str]) -> Query:
    """Items with the distinct terms of their texts."""
    found = terms(pa.array(texts, pa.string()))
    item, code, _ = occurrences(found)
    hashes = hash_words(found.vocab)
    starts = np.searchsorted(item, np.arange(len(ids) + 1))
    return Query(ids, found.vocab, hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32), starts, code)


def max_sketches(found: Words, text: np.ndarray, code: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketches of all texts behind one another, and where each begins (empty for a text without terms)."""
    distinct = np.bincount(text, minlength=len(found.starts) - 1)
    size = np.maximum(LEAST_SIZE, 1 << np.ceil(np.log2(np.maximum(SPARSE * distinct, 1))).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(np.where(distinct > 0, 2 * size, 0))])
    flat = np.zeros(at[-1], np.uint8)
    hashes = hash_words(found.vocab)[code]
    mask, value = (size[text] - 1).astype(np.uint64), np.minimum(tf, MOST).astype(np.uint8)
    low, high = hashes & np.uint64(0xFFFFFFFF) & mask, (hashes >> np.uint64(32)) & mask
    np.maximum.at(flat, at[text] + low.astype(np.int64), value)
    np.maximum.at(flat, at[text] + size[text] + high.astype(np.int64), value)
    return flat, at


def _sketch(query: Query, sketches: bool):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(query.vocab), np.int64)
        names = [c.split()[0] for c in SKETCH.split(", ")]
        for batch in batches:
            ids, done = batch.column(0), 0
            for block in text_blocks(batch.column(1)):
                found = terms(block)
                text, code, tf = occurrences(found)
                known = pc.index_in(found.vocab, value_set=query.vocab).fill_null(-1).to_numpy(zero_copy_only=False)[code]
                df += np.bincount(known[known >= 0], minlength=len(df))
                own = ids.slice(done, len(block))
                done += len(block)
                if not sketches:
                    continue
                flat, at = max_sketches(found, text, code, tf)
                some = np.flatnonzero(np.diff(at))
                binary = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(block), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)]
                )
                none = pa.nulls(len(some))
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(some)), pa.array(np.diff(found.starts)[some]),
                     binary.take(pa.array(some)).cast(pa.binary()), none.cast(pa.int32()), none.cast(pa.int64())], names,
                )
        met = np.flatnonzero(df)
        none = pa.nulls(len(met))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(met.astype(np.int32)), pa.array(df[met])], names
        )

    return of_batches


def upper_bounds(query: Query, table: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bounds of documents (rows) for items (columns); all sketches in ``table`` have one size."""
    size = table.shape[1] // 2
    mask = np.uint64(size - 1)
    low = (query.first[query.flat] & mask).astype(np.int64)
    high = (query.second[query.flat] & mask).astype(np.int64) + size
    tf = np.minimum(table[:, low], table[:, high])
    doc, at = np.nonzero(tf)
    count = tf[doc, at].astype(np.int64)
    norm = query.norms(n)[doc]
    impact = np.where(count < MOST, SCALE * count // (1000 * count + 8 * norm), LIMIT)
    item = np.repeat(np.arange(len(query.ids)), np.diff(query.starts))[at]
    value = impact * query.weights[query.flat[at]]
    # Sums of whole numbers below 2**53 are exact in doubles.
    return np.bincount(doc * len(query.ids) + item, value, len(n) * len(query.ids)).reshape(len(n), -1).astype(np.int64)


def _batches_of_bounds(query: Query, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Document ids and bounds, a few sketches of one size at a time."""
    ids = pc.fill_null(batch.column(0), int(NO_ID)).to_numpy(zero_copy_only=False)
    n, blobs = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
    sizes = pc.binary_length(blobs).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, CELLS // max(len(query.flat), size))
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            table = np.stack([np.frombuffer(blobs[int(r)].as_buffer(), np.uint8) for r in own])
            yield ids[own], upper_bounds(query, table, n[own])


def _id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def _ranked(rows: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` rows of each item with the highest value, equal values by id; rows are (item, id, value)."""
    item, ids, value = rows
    order = np.lexsort((ids, -value, item))
    item, ids, value = item[order], ids[order], value[order]
    first = np.concatenate([[True], item[1:] != item[:-1]]) if len(item) else np.zeros(0, bool)
    place = np.arange(len(item)) - np.maximum.accumulate(np.where(first, np.arange(len(item)), 0))
    return item[place < k], ids[place < k], value[place < k]


class _Best:
    """The best ``k`` rows per item of a task, so that no task sends more than those."""

    def __init__(self, k: int, names: list[str]):
        self.k, self.names, self.held, self.parts = k, names, 0, []

    def add(self, item: np.ndarray, ids: np.ndarray, value: np.ndarray) -> None:
        self.parts.append((item.astype(np.int64), ids, value))
        self.held += len(item)
        if self.held > KEPT:
            self.parts = [self.ranked()]
            self.held = len(self.parts[0][0])

    def ranked(self) -> tuple[np.ndarray, ...]:
        empty = np.zeros(0, np.int64)
        return _ranked(tuple(np.concatenate([empty, *[p[i] for p in self.parts]]) for i in range(3)), self.k)

    def batch(self) -> pa.RecordBatch:
        item, ids, value = self.ranked()
        return pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), _id_array(ids), pa.array(value)], self.names)


def _highest_bounds(query: Query, k: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k, ["item", "doc_id", "bound"])
        # A bound below the k-th of this task so far cannot be among the highest.
        limit = np.zeros(len(query.ids), np.int64)
        for batch in batches:
            for ids, bounds in _batches_of_bounds(query, batch):
                doc, item = np.nonzero(bounds > limit)
                best.add(item, ids[doc], bounds[doc, item])
                if len(doc):
                    kept, _, value = best.ranked()
                    full = np.bincount(kept, minlength=len(limit)) >= k
                    least = np.full(len(limit), NO_ID)
                    np.minimum.at(least, kept, value)
                    # Equal bounds stay in, as the smaller id goes first.
                    limit = np.where(full, np.maximum(least - 1, 0), 0)
        yield best.batch()

    return of_batches


def _reaching(query: Query, threshold: np.ndarray, last: np.ndarray):
    """Documents whose bound lets them into some item's ranks, with those items."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, bounds in _batches_of_bounds(query, batch):
                tied = (bounds == threshold) & (bounds > 0) & (ids[:, None] <= last)
                doc, item = np.nonzero((bounds > threshold) | tied)
                some, size = np.unique(doc, return_counts=True)
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(item.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([_id_array(ids[some]), lists], ["doc_id", "items"])

    return of_batches


def exact_scores(query: Query, found: Words, doc: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Scores of pairs of a text and an item."""
    text, code, tf = occurrences(found)
    known = pc.index_in(found.vocab, value_set=query.vocab).fill_null(-1).to_numpy(zero_copy_only=False)[code]
    width = max(len(query.vocab), 1)
    key = text[known >= 0] * width + known[known >= 0]
    order = np.argsort(key)
    key, tf = key[order], tf[known >= 0][order]
    norm = query.norms(np.diff(found.starts))
    score = np.zeros(len(doc), np.int64)
    lengths = np.diff(query.starts)
    step = max(1, CELLS // max(int(lengths.max(initial=1)), 1))
    for at in range(0, len(doc) if len(key) else 0, step):
        d, i = doc[at : at + step], item[at : at + step]
        pair = np.repeat(np.arange(len(d)), lengths[i])
        ends = np.cumsum(lengths[i])
        term = query.flat[np.arange(len(pair)) - np.repeat(ends - lengths[i], lengths[i]) + np.repeat(query.starts[i], lengths[i])]
        wanted = d[pair] * width + term
        place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        count = np.where(key[place] == wanted, tf[place], 0)
        value = (SCALE * count) // (1000 * count + 8 * norm[d[pair]]) * query.weights[term]
        score[at : at + step] = np.bincount(pair, value, len(d)).astype(np.int64)
    return score


def _rescored(query: Query, k: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k, ["item", "doc_id", "score"])
        for batch in batches:
            ids = pc.fill_null(batch.column(0), int(NO_ID)).to_numpy(zero_copy_only=False)
            done = 0
            for block in text_blocks(batch.column(1)):
                lists = batch.column(2).slice(done, len(block))
                own = ids[done : done + len(block)]
                done += len(block)
                doc = np.repeat(np.arange(len(block)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                item = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                score = exact_scores(query, terms(block), doc, item)
                some = score > 0
                best.add(item[some], own[doc[some]], score[some])
        yield best.batch()

    return of_batches


def _top(rows: DataFrame, value: str, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col(value).desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _score(texts: DataFrame, wanted: DataFrame, query: Query, k: int) -> DataFrame:
    """Exact scores of the wanted items of documents, the best ``k`` of each item with their rank.

    The wanted documents are sent to the texts if their table is small; its size is
    read first. A larger one is joined as Spark sees fit.
    """
    spark = texts.sparkSession
    one = wanted.select(F.col("doc_id").alias("__id"), F.explode("items").alias("item"))
    path = scratch_path(spark, "wanted")
    # At most as many items as the block has, whatever number of rows shares an id.
    one.groupBy("__id").agg(F.collect_set("item").alias("items")).write.parquet(path)
    items = spark.read.schema("__id long, items array<int>").parquet(path)
    if (items.agg(F.sum(F.size("items") + 4)).first()[0] or 0) <= SENT:
        items = F.broadcast(items)
    joined = texts.join(items, texts["doc_id"].eqNullSafe(items["__id"])).select("doc_id", "text", "items")
    return _top(joined.mapInArrow(_rescored(query, k), SCORE), "score", k)


def _blocks(items: DataFrame, item_id: str, text: str, chars: int) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of about ``chars`` characters; texts of one id are taken together."""
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // chars)
    for k in range(n):
        own = rows.filter(F.pmod(F.xxhash64(F.lit(3), "item_id"), F.lit(n)) == k)
        texts: dict = {}
        for r in own.distinct().collect():
            texts.setdefault(r[0], []).append(r[1])
        if texts:
            yield list(texts), [" ".join(t) for t in texts.values()]


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", doc_id: str = "doc_id",
    item_id: str = "item_id", item_text: str = "text", chars: int = ITEM_CHARS,
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for each item: ``item_id, rank, doc_id, score``.

    Equal scores are ranked by document id, null last. Each row of ``docs`` is a
    document, also where rows share an id; rows of ``items`` that share an id are
    one item with the terms of all. Null texts, and texts without a term, match
    nothing; an item without a match has no row, and empty tables give an empty
    result. Other columns are ignored.

    The items are collected in blocks of ``chars`` characters; sketches are
    written once and serve all blocks. What reaches the driver per block is the
    document frequencies of its terms and one threshold per item.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sketched, results = None, []
    for ids, item_texts in _blocks(items, item_id, item_text, chars):
        query = read_query(ids, item_texts)
        path = scratch_path(spark, "sketches")
        texts.mapInArrow(_sketch(query, sketched is None), SKETCH).write.option("compression", "zstd").parquet(path)
        read = spark.read.schema(SKETCH).parquet(path)
        if sketched is None:
            sketched = read.filter("term is null").select("doc_id", "n", "sketch")
            documents, length = sketched.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(query.vocab), np.int64)
        for term, n in read.filter("term is not null").groupBy("term").agg(F.sum("df")).collect():
            df[term] = n
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()]
        query = query._replace(weights=np.array(weights, np.int64), documents=documents, length=length)
        highest = _top(sketched.mapInArrow(_highest_bounds(query, FIRST * k), BOUND), "bound", FIRST * k)
        first = _score(texts, highest.select("doc_id", F.array("item").alias("items")), query, k)
        threshold, last = np.zeros(len(ids), np.int64), np.full(len(ids), NO_ID)
        for item, score, last_id in first.filter(F.col("rank") == k).select("item", "score", "doc_id").collect():
            threshold[item], last[item] = score, NO_ID if last_id is None else last_id
        reach = scratch_path(spark, "reaching")
        sketched.mapInArrow(_reaching(query, threshold, last), WANTED).write.parquet(reach)
        names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
        ranked = _score(texts, spark.read.schema(WANTED).parquet(reach), query, k)
        found = scratch_path(spark, "ranked")
        ranked.join(names, "item").select("item_id", "rank", "doc_id", "score").write.parquet(found)
        results.append(found)
    schema = "item_id long, rank int, doc_id long, score long"
    return spark.read.schema(schema).parquet(*results) if results else spark.createDataFrame([], schema)
