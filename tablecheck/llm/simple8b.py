"""Token ids as Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 bits shared equally by as many ids as
fit: 120 ids that are all zero, 60 ids of one bit, and so on to one id of 60
bits. Selector zero is an escape: the word after it is one id of 64 bits. A
table ``skips`` tells how many ids stand before every ``STRIDE``-th word, so any
part of a block can be decoded without what stands before it.

A file is a Parquet file of blocks. A block holds whole documents in ascending
order: their ids, their numbers of token ids, the words and the skips.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import ship
from .tokens import encoded

#: Ids per word and bits per id of selectors 1 to 15.
COUNTS = (120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
STRIDE = 256
BLOCK_IDS = 1 << 16
JUMPS = 5
TEXT_BYTES = 24 << 20
PIECES = 250_000
BLOCK = "shard int, block int, first long, n long, escapes int, doc_ids array<long>, counts array<long>, words binary, skips binary"

_COUNT_OF = np.array((1, *COUNTS), np.int64)


def chain_from_zero(step: np.ndarray) -> np.ndarray:
    """The places 0, ``step[0]``, and so on, each a step of the last place further, below the number of steps."""
    n = len(step)
    after = np.append(np.minimum(np.arange(n) + step, n), n)
    # Places after 1, 2, 4, ... steps; only every 2 ** JUMPS-th place is looked up by itself.
    jumps = [after]
    for _ in range(JUMPS):
        jumps.append(jumps[-1][jumps[-1]])
    at, far = 0, []
    while at < n:
        far.append(at)
        at = jumps[-1].item(at)
    places = np.array(far, np.int64)[:, None]
    for jump in jumps[-2::-1]:
        places = np.stack([places, jump[places]], axis=2).reshape(len(far), 2 * places.shape[1])
    places = places.ravel()
    return places[places < n]


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The words, the skips, and the number of escapes."""
    n = len(ids)
    ids = ids.astype(np.uint64)
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    large = ids >= np.uint64(1) << np.uint64(60)
    bits[~large & (bits > 60)] = 60
    bits[large] = 64
    chosen, beyond = np.zeros(n, np.uint8), np.ones(120, bool)
    # For each place the last selector, from few wide to many narrow ids, whose ids all fit; beyond the end anything does.
    for selector in range(15, 0, -1):
        count = COUNTS[selector - 1]
        fits, have = np.concatenate([bits <= WIDTHS[selector - 1], beyond]), 1
        while have < count:
            more = min(have, count - have)
            fits, have = fits[:-more] & fits[more:], have + more
        chosen[fits[:n]] = selector
    starts = chain_from_zero(_COUNT_OF[chosen])
    selector = chosen[starts] if n else np.zeros(0, np.uint8)
    target = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(selector == 0)])[: len(starts)]
    words = np.zeros(len(starts) + int((selector == 0).sum()), np.uint64)
    padded = np.concatenate([ids, np.zeros(120, np.uint64)])
    for s in np.unique(selector).tolist():
        own = np.flatnonzero(selector == s)
        if s == 0:
            words[target[own] + 1] = ids[starts[own]]
            continue
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        lanes = np.arange(count)
        values = padded[starts[own][:, None] + lanes] << (lanes * width).astype(np.uint64)
        words[target[own]] = np.bitwise_or.reduce(values, axis=1) | np.uint64(s << 60)
    before = np.full(len(words) + 1, n, np.int64)
    before[target] = starts
    before[target[selector == 0] + 1] = starts[selector == 0] + 1
    return words, before[: len(words) : STRIDE], int((selector == 0).sum())


def unpack(words: np.ndarray, n: int, escapes: int = 0) -> np.ndarray:
    """The ``n`` ids of a block."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(words), bool)
    if escapes:
        last = -2
        for k in np.flatnonzero(selector == 0).tolist():
            if k != last + 1:  # else it is the id that an escape announced
                last = k
                head[k + 1] = False
        # An announced id may have any leading bits.
    at = np.flatnonzero(head)
    selector = selector[at]
    starts = np.cumsum(_COUNT_OF[selector]) - _COUNT_OF[selector]
    ids = np.zeros(n + 120, np.uint64)
    for s in np.unique(selector).tolist():
        own = np.flatnonzero(selector == s)
        if s == 0:
            ids[starts[own]] = words[at[own] + 1]
            continue
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        lanes = np.arange(count)
        values = (words[at[own]][:, None] >> (lanes * width).astype(np.uint64)) & np.uint64((1 << width) - 1)
        ids[starts[own][:, None] + lanes] = values
    return ids[:n]


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, text: str = "text", doc_id: str = "doc_id", end: int = 0, spaced: bool = True
) -> None:
    """Encode whole texts and write their ids, each document followed by ``end``, in ascending document order.

    A null text counts as empty. Documents without id come first; rows that
    share an id are all kept, in the order of a hash of their texts. Every task
    writes one file; files are numbered in document order by ``shard``.
    """
    ship(docs.sparkSession)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            owners = batch.column(0).to_pylist()
            for before, found in encoded(batch.column(1), tokenizer, spaced, end, TEXT_BYTES, PIECES):
                sizes, low = np.diff(found.starts), 0
                while low < len(sizes):
                    high = max(int(np.searchsorted(found.starts, found.starts[low] + BLOCK_IDS, side="right")) - 1, low + 1)
                    ids = found.ids[found.starts[low] : found.starts[high]]
                    words, skips, escapes = pack(ids)
                    row = {
                        "shard": shard, "block": block, "first": first, "n": len(ids), "escapes": escapes,
                        "doc_ids": owners[before + low : before + high], "counts": sizes[low:high].tolist(),
                        "words": words.astype("<u8").tobytes(), "skips": skips.astype("<u4").tobytes(),
                    }
                    yield pa.RecordBatch.from_pylist([row], schema=schema)
                    low, block, first = high, block + 1, first + len(ids)

    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int64()), ("escapes", pa.int32()),
         ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("words", pa.binary()), ("skips", pa.binary())]
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(of_batches, BLOCK).write.option("compression", "none").parquet(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files with its token ids: ``shard``, ``at`` (ids of the shard before it), ``doc_id``, ``ids``."""
    ship(spark)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, first, row, ids, ends in _decoded(batches):
            out = [ids[a:b].astype(np.int64) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(out), pa.int32()), pa.array(first + ends[:-1], pa.int64()),
                 pa.array(row["doc_ids"], pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                ["shard", "at", "doc_id", "ids"],
            )

    return spark.read.schema(BLOCK).parquet(path).mapInArrow(of_batches, "shard int, at long, doc_id long, ids array<long>")


def _decoded(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8"), row["n"], row["escapes"])
            yield row["shard"], row["first"], row, ids, np.concatenate([[0], np.cumsum(row["counts"])]).astype(np.int64)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` over all files, ``n_tokens`` and ``ids_crc32`` of its decoded ids."""
    ship(spark)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, first, row, ids, ends in _decoded(batches):
            raw = ids.astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(crc), pa.int32()), pa.array(first + ends[:-1], pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                 pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                ["shard", "at", "doc_id", "n_tokens", "ids_crc32"],
            )

    blocks = spark.read.schema(BLOCK).parquet(path)
    # One row per file, so this window is small at any size.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("shard").agg(F.sum("n").alias("total"))
    bases = files.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    found = blocks.mapInArrow(of_batches, "shard int, at long, doc_id long, n_tokens long, ids_crc32 long")
    return found.join(bases, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
