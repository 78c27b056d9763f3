"""Near-duplicates by SimHash fingerprints and pivot distance tables.

Fingerprints within ``bits`` differing bits are linked. Equal fingerprints are
merged first, so copies cost one row. Of the 64 bits, cut into ``2 * bits``
blocks, linked fingerprints share at least ``bits`` whole blocks; those shared
blocks are the key that brings candidates together. Within a key the pivot
table decides: Hamming distance is a metric, so a pair whose distances to some
reference fingerprint differ by more than ``bits`` is no link. Survivors are
verified. No pairs of a group are emitted, only a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .batches import mix, ship, text_blocks
from .components import components

PIVOTS = 24
GROUP_LIMIT = 40_000
PIECE = 1 << 18


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The signed 64-bit SimHash of one text; zero without words."""
    parts = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(parts))
    starts, ends = starts[: len(parts) - size + 1], ends[size - 1 :]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), PIECE):
        found = [digest(joined[s:e], seed) for s, e in zip(starts[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist())]
        bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<i8")[0])


def fingerprint_column(text: str | Column, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint of a text column as a long; null counts as empty."""

    @F.arrow_udf("long")
    def of_texts(texts: pa.Array) -> pa.Array:
        return pa.array(
            [fingerprint(t, shingle, seed) for block in text_blocks(texts) for t in block.cast(pa.binary()).to_pylist()],
            pa.int64(),
        )

    return of_texts(text)


def block_keys(bits: int) -> list[int]:
    """Masks of which two fingerprints within ``bits`` bits agree on at least one."""
    cuts = np.linspace(0, 64, 2 * bits + 1).astype(int) if bits else np.array([0, 64])
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    return [sum(some) for some in combinations(blocks, max(bits, 1))]


def pivot_table(prints: np.ndarray, pivots: int) -> np.ndarray:
    """Hamming distances to the reference fingerprints, one row per reference."""
    references = mix(np.arange(pivots, dtype=np.uint64) + np.uint64(77))
    return np.bitwise_count(prints[None, :] ^ references[:, None]).astype(np.int8)


def forest(prints: np.ndarray, table: np.ndarray, bits: int) -> tuple[list, list]:
    """Links that span the groups of one key, found by growing each group from its first member."""
    left, parents, children = np.arange(len(prints)), [], []
    while len(left):
        grow, left = [left[0]], left[1:]
        while grow and len(left):
            x = grow.pop()
            near = left
            for row in table:
                near = near[np.abs(row[near] - row[x]) <= bits]
                if not len(near):
                    break
            near = near[np.bitwise_count(prints[near] ^ prints[x]) <= bits]
            if len(near):
                parents.append(np.full(len(near), x))
                children.append(near)
                grow.extend(near.tolist())
                left = np.setdiff1d(left, near, assume_unique=True)
    return parents, children


def group_links(group: np.ndarray, prints: np.ndarray, bits: int, pivots: int, small: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal ``group`` numbers."""
    table = pivot_table(prints, pivots)
    firsts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(firsts, len(group)))
    size_of = np.repeat(sizes, sizes)
    one, two = [], []
    for lag in range(1, min(small, int(sizes.max(initial=0)))):
        a = np.flatnonzero((size_of[:-lag] <= small) & (group[:-lag] == group[lag:]))
        a = a[np.abs(table[:, a] - table[:, a + lag]).max(axis=0, initial=0) <= bits]
        a = a[np.bitwise_count(prints[a] ^ prints[a + lag]) <= bits]
        one.append(a)
        two.append(a + lag)
    for at, size in zip(firsts[sizes > small].tolist(), sizes[sizes > small].tolist()):
        parents, children = forest(prints[at : at + size], table[:, at : at + size], bits)
        one += [p + at for p in parents]
        two += [c + at for c in children]
    if not one:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return prints[np.concatenate(one)].view(np.int64), prints[np.concatenate(two)].view(np.int64)


def _links(bits: int, pivots: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_group, kept_prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def found(group: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            u, v = group_links(group, prints, bits, pivots) if len(group) else (group, group)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            kept_group = np.concatenate([kept_group, batch.column(0).to_numpy(zero_copy_only=False)])
            kept_prints = np.concatenate([kept_prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(kept_group):
                continue
            cut = int(np.searchsorted(kept_group != kept_group[-1], False)) if kept_group[0] == kept_group[-1] else int(
                np.flatnonzero(kept_group != kept_group[-1])[-1] + 1
            )
            if cut:
                yield found(kept_group[:cut], kept_prints[:cut])
                kept_group, kept_prints = kept_group[cut:], kept_prints[cut:]
        yield found(kept_group, kept_prints)

    return of_batches


def links(prints: DataFrame, bits: int = 3, pivots: int = PIVOTS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (``u``, ``v``) that connect all fingerprints within ``bits`` bits.

    ``prints`` holds distinct fingerprints in column ``print``. A key shared by
    more than ``group_limit`` fingerprints is dealt out as pairs of chunks, so a
    task holds at most two chunks; every pair still meets in one of them.
    """
    ship(prints.sparkSession)
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in block_keys(bits)])
    # The number of the mask and the masked bits make one 64-bit key; a chance clash only adds a candidate.
    keyed = prints.select(
        F.explode(F.transform(masks, lambda m, i: F.xxhash64(i, F.col("print").bitwiseAND(m)))).alias("key"), "print"
    )
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / group_limit).cast("int")
    dealt = (
        keyed.join(shared, "key")
        .withColumn("chunk", F.pmod(F.xxhash64("print"), chunks.cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(
            F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("group"), "print"
        )
    )
    return dealt.repartition("group").sortWithinPartitions("group").mapInArrow(_links(bits, pivots), "u long, v long")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, bits: int = 3, pivots: int = PIVOTS
) -> DataFrame:
    """Fingerprint and group of every document: ``doc_id``, ``fingerprint``, ``component_id``.

    A group is all documents reachable over links; its id is its smallest
    document id. Null texts count as empty; texts without words have
    fingerprint zero and link like any other. A null document id keeps its row;
    it never names a group unless the group has no other id. Repeated ids and
    rows keep their rows. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    path = scratch_path(spark, "fingerprints")
    docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), fingerprint_column(F.col(text), shingle).alias("print")
    ).write.parquet(path)
    marked = spark.read.schema("doc_id long, print long").parquet(path)
    distinct = marked.groupBy("print").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct.select("print"), bits, pivots))
    rooted = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(named, "root").select("print", "component_id")
    return marked.join(classes, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    Of rows that repeat an id the one with the least hash of its columns stays, so
    every run keeps the same. Rows without an id cannot be named by a group and
    stay. The document rows are shuffled once, by their id.
    """
    groups = near_duplicates(docs, text, doc_id, **options)
    chosen = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("__kept_id")).distinct()
    names = [F.col(f"`{c}`") for c in docs.columns]
    # Maps have no hash.
    hashed = [c for c, f in zip(names, docs.schema.fields) if "map<" not in f.dataType.simpleString()]
    kept = docs.join(chosen, docs[doc_id] == F.col("__kept_id"), "left_semi").groupBy(F.col(doc_id).alias("__id")).agg(
        F.min_by(F.struct(*names), F.xxhash64(*hashed)).alias("__row")
    )
    return kept.select("__row.*").unionByName(docs.filter(F.col(doc_id).isNull()))
