"""Best-fit packing of documents into sequences, certified by lower bounds.

Every partition packs its pieces by best-fit decreasing and computes a lower
bound of its number of sequences from dual feasible functions. A partition that
meets its bound is certified and keeps its sequences, but for one that may be
less than half full. Partitions with a gap release their emptier sequences.
Released sequences are dealt anew over groups of bounded size and packed again,
until nothing is released or an exchange saves nothing.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .batches import ship
from .tokens import encoded

LENGTH = 2048
PART_PIECES = 60_000
GROUP_PARTS = 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, part long, sequence long, offset long, filled long, bins long, bound long, released boolean"


def tokenized(docs: DataFrame, tokenizer: str, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id", spaced: bool = False) -> DataFrame:
    """The pieces of every document: its ids and an end id 0, cut only where longer than ``length``."""
    ship(docs.sparkSession)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_of = batch.column(0).to_numpy(zero_copy_only=False) if not batch.column(0).null_count else batch.column(0).to_pylist()
            for before, found in encoded(batch.column(1), tokenizer, spaced):
                rows = []
                for k in range(len(found.starts) - 1):
                    ids = found.ids[found.starts[k] : found.starts[k + 1]]
                    for piece, at in enumerate(range(0, len(ids), length)):
                        part = ids[at : at + length]
                        rows.append((ids_of[before + k], piece, at, len(part), zlib.crc32(part.astype("<u4").tobytes())))
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(of_batches, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of the dual feasible function bounds on the number of bins."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    total = int((count * size).sum())
    best = -(-total // capacity)
    # Sizes above capacity - e count as whole bins, sizes below e not at all.
    from_low = np.concatenate([[0], np.cumsum(count * size)])
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    for e in range(1, capacity // 2 + 1):
        inner = int(from_low[capacity - e + 1] - from_low[e])
        best = max(best, int(above[capacity - e + 1]) - (-inner // capacity))
    # Sizes rounded to multiples of 1 / k where (k + 1) * size is no multiple of the capacity.
    for k in range(1, 21):
        stretched = (k + 1) * size
        exact = stretched % capacity == 0
        value = np.where(exact, size * k, (stretched // capacity) * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece by best-fit decreasing; ties in length keep their order."""
    bins, rooms, open_sizes, used = np.zeros(len(lengths), np.int64), [[] for _ in range(capacity + 1)], 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = open_sizes >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                open_sizes ^= 1 << room
        else:
            room, chosen = capacity, used
            used += 1
        left = room - need
        if left:
            if not rooms[left]:
                open_sizes |= 1 << left
            rooms[left].append(chosen)
        bins[i] = chosen
    return bins


def _packer(capacity: int, last: bool):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32", "length"], kind="stable").reset_index(drop=True)
        part, length = int(rows["part"].iloc[0]), rows["length"].to_numpy()
        chosen, bound = best_fit(length, capacity), lower_bound(length, capacity)
        before = rows["sequence"].nunique(dropna=False) if rows["sequence"].notna().all() else None
        used = int(chosen.max()) + 1
        if before is not None and before < used:  # the packing it came with is better
            chosen, used = pd.factorize(rows["sequence"])[0], before
        filled = np.bincount(chosen, weights=length, minlength=used).astype(np.int64)
        order = np.argsort(chosen, kind="stable")
        ends = np.cumsum(length[order])
        first = np.concatenate([[True], chosen[order][1:] != chosen[order][:-1]])
        base = np.maximum.accumulate(np.where(first, ends - length[order], 0))
        offset = np.empty(len(rows), np.int64)
        offset[order] = ends - length[order] - base
        gap = used - bound
        # Sequences less than half full may still meet those of another partition.
        released = filled < (0 if last else capacity // 2)
        if gap > 0 and not last:
            several = max(8 * gap, used // 10)
            released[np.argsort(filled, kind="stable")[:several]] = True
            released &= filled < capacity
        return rows.assign(
            sequence=(part << 32) + chosen, offset=offset, filled=filled[chosen], bins=used, bound=bound, released=released[chosen]
        )

    return pack


def pack(pieces: DataFrame, capacity: int = LENGTH, part_pieces: int = PART_PIECES) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``, and the certificate of the partition that packed them.

    ``pieces`` has the columns of ``tokenized``; lengths are from 1 to ``capacity``.
    Each partition holds about ``part_pieces`` pieces, dealt out by a hash of
    the piece and its place in the input files, so repeated rows spread too.
    Sequences that partitions with gaps give back are packed again in groups of
    about ``GROUP_PARTS * part_pieces`` pieces, from partitions all over, until an
    exchange saves nothing or none is given back. ``bins`` and ``bound`` are the
    number of sequences and its lower bound where the piece was last packed.
    Repeated rows are packed as often as they occur; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    parts = max(1, math.ceil(pieces.count() / part_pieces))
    spread = F.xxhash64(F.col("doc_id"), F.col("piece"), F.monotonically_increasing_id())
    state = pieces.select("*", F.pmod(spread, F.lit(parts)).alias("part"), F.lit(None).cast("long").alias("sequence"))
    done, level, came = [], 0, None
    while True:
        path = scratch_path(spark, f"packed-{level}")
        state.groupBy("part").applyInPandas(_packer(capacity, parts == 1), PACKED).write.parquet(path)
        packed = spark.read.schema(PACKED).parquet(path)
        released = packed.filter("released")
        n, sequences = released.agg(F.count(F.lit(1)), F.count_distinct("sequence")).first()
        used = packed.select("part", "bins").distinct().agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]
        # An exchange that saved nothing is the last one.
        if parts == 1 or n == 0 or (came is not None and used >= came):
            done.append(packed)
            break
        done.append(packed.filter("not released"))
        level, came, parts = level + 1, sequences, max(1, math.ceil(n / (GROUP_PARTS * part_pieces)))
        # Whole sequences of all partitions are dealt anew; partition numbers of a level are above those of all levels before it.
        state = released.select(
            *[c.split()[0] for c in PIECES.split(", ")],
            (F.pmod(F.xxhash64("sequence", F.lit(level)), F.lit(parts)) + (level << 24)).cast("long").alias("part"), "sequence",
        )
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return whole.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), "offset", "filled", "bins", "bound"
    )


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Tokenize and pack whole documents; see ``tokenized`` and ``pack``.

    A null text counts as empty: its document is the end id alone. Documents of
    equal or no id keep their own pieces.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    tokenized(docs, tokenizer, length, text, doc_id).write.parquet(path)
    return pack(spark.read.schema(PIECES).parquet(path), length)
