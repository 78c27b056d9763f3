"""Near-duplicates by MinHash signatures and sequential Bayesian verification.

Documents whose sets of word shingles have a Jaccard similarity of at least the
threshold are linked. Equal sets are merged first, so copies cost one row. Bands
of signature values bring candidates together. Within a band's group the
signatures are compared batch by batch: the number of equal values so far gives
a posterior of the similarity, and a pair goes as soon as the probability that it
reaches the threshold falls below the chosen miss probability. What survives is
gathered into clusters, the texts of a cluster meet, and links are decided on the
full sets. Groups and clusters give spanning forests of their links, not their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .batches import Words, hash_words, mix, ship, sum_runs, text_blocks, words
from .components import components

#: Similarity of linked sets, in percent.
THRESHOLD = 80
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Signature values compared at once, and the probability at which a pair is given up.
BATCH = 16
MISS = 1e-6
#: Documents of one group, and shingles of one cluster, that a task takes at once; a task holds two such chunks.
GROUP_LIMIT = 20_000
CLUSTER_LIMIT = 2_000_000
SMALL = 8

MARKED = "row long, doc_id long, n long, d1 long, d2 long, sig binary, bands array<long>"
LINKS = "u long, v long"


def shingle_sets(found: Words, shingle: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles of each text, and where each text's begin.

    A text with fewer words has its whole sequence as its only shingle, one without words none.
    """
    of_word = hash_words(found.vocab)[found.codes] if len(found.codes) else np.zeros(0, np.uint64)
    count = np.diff(found.starts)
    size = np.minimum(count, shingle)
    number = np.where(count > 0, count - size + 1, 0)
    starts = np.concatenate([[0], np.cumsum(number)])
    text = np.repeat(np.arange(len(count)), number)
    first = np.arange(starts[-1]) - starts[text] + found.starts[text]
    value = np.full(len(first), 0x9E37, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(shingle):
            inside = k < size[text]
            step = mix(value * np.uint64(0xD6E8FEB86659FD93) + of_word[np.where(inside, first + k, 0)]) if len(value) else value
            value = np.where(inside, step, value)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    kept = np.concatenate([[0], np.cumsum(new)])
    return value[new], kept[starts]


def signatures(values: np.ndarray, starts: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """MinHash values of each set, one row per set; an empty set has zeros."""
    found = np.zeros((len(starts) - 1, hashes), np.uint32)
    full = np.flatnonzero(np.diff(starts) > 0)
    if len(full):
        top = (values >> np.uint64(32)).astype(np.uint32)
        seeds = mix(np.arange(2 * hashes, dtype=np.uint64) + np.uint64(4242)).astype(np.uint32)
        for j in range(hashes):
            found[full, j] = np.minimum.reduceat((top ^ seeds[j]) * (seeds[hashes + j] | np.uint32(1)), starts[full])
    return found


def band_keys(found: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key per band of each signature; the band's number is part of it."""
    bands = found.shape[1] // rows
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + np.uint64(99)), (len(found), bands))
    for r in range(rows):
        key = mix(key ^ found[:, r::rows][:, :bands].astype(np.uint64))
    return key.view(np.int64)


def set_digests(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart: two sums over differently scrambled members."""
    return sum_runs(mix(values), starts).view(np.int64), sum_runs(mix(values ^ np.uint64(0xABCDEF)), starts).view(np.int64)


def least_matches(hashes: int = HASHES, batch: int = BATCH, threshold: float = THRESHOLD / 100, miss: float = MISS) -> list[tuple[int, int]]:
    """After so many compared values, the matches with which a pair stays.

    With a uniform prior, ``m`` matches of ``k`` leave a Beta(m+1, k-m+1) posterior;
    its mass above ``t`` is the probability that at most ``m`` of ``k+1`` draws of
    chance ``t`` hit. Signature values are compared by their last byte, so ``t``
    includes one chance match in 256.
    """
    t = threshold + (1 - threshold) / 256
    table = []
    for k in range(batch, hashes + 1, batch):
        mass = 0.0
        for m in range(k + 1):
            mass += math.comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
            if mass >= miss:
                table.append((k, m))
                break
    return table


def survivors(sigs: np.ndarray, a: int | np.ndarray, b: np.ndarray, table: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs (``a``, a number or as many as ``b``) that no batch gives up."""
    left = np.arange(len(b))
    matches, before = np.zeros(len(left), np.int64), 0
    for k, least in table:
        if not len(left):
            break
        x = a if np.ndim(a) == 0 else a[left]
        matches = matches + (sigs[x, before:k] == sigs[b[left], before:k]).sum(axis=-1)
        stay = matches >= least
        left, matches, before = left[stay], matches[stay], k
    return left


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list, list]:
    """Links that span the groups of ``n`` members; ``near`` gives those of some members that link with one."""
    left, parents, children = np.arange(n), [], []
    while len(left):
        grow, left = [int(left[0])], left[1:]
        while grow and len(left):
            x = grow.pop()
            found = near(x, left)
            if len(found):
                parents.append(np.full(len(found), x))
                children.append(found)
                grow.extend(found.tolist())
                left = np.setdiff1d(left, found, assume_unique=True)
    return parents, children


def candidate_links(group: np.ndarray, nodes: np.ndarray, sigs: np.ndarray, table: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside runs of equal ``group`` numbers that survive; larger runs give a spanning forest of them."""
    firsts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(firsts, len(group)))
    size_of = np.repeat(sizes, sizes)
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lag in range(1, min(SMALL, int(sizes.max(initial=0)))):
        a = np.flatnonzero((size_of[:-lag] <= SMALL) & (group[:-lag] == group[lag:]))
        a = a[survivors(sigs, a, a + lag, table)]
        one.append(a)
        two.append(a + lag)
    for at, size in zip(firsts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        own = sigs[at : at + size]
        parents, children = forest(size, lambda x, left, own=own: left[survivors(own, x, left, table)])
        one += [p + at for p in parents]
        two += [c + at for c in children]
    u, v = nodes[np.concatenate(one)], nodes[np.concatenate(two)]
    return u, v


def exact_links(nodes: np.ndarray, sets: list[np.ndarray], sigs: np.ndarray, table: list[tuple[int, int]], percent: int = THRESHOLD):
    """Spanning links of one cluster, decided on the full sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    members, code = np.unique(np.concatenate(sets), return_inverse=True)
    marks = np.zeros(len(members), bool)

    def near(x: int, left: np.ndarray) -> np.ndarray:
        left = left[(100 * np.minimum(sizes[left], sizes[x])) >= percent * np.maximum(sizes[left], sizes[x])]
        left = left[survivors(sigs, x, left, table)]
        if not len(left):
            return left
        own = code[starts[x] : starts[x + 1]]
        marks[own] = True
        places = np.arange(sizes[left].sum()) + np.repeat(starts[left] - np.cumsum(sizes[left]) + sizes[left], sizes[left])
        shared = np.add.reduceat(marks[code[places]].astype(np.int64), np.cumsum(sizes[left]) - sizes[left])
        marks[own] = False
        return left[100 * shared >= percent * (sizes[x] + sizes[left] - shared)]

    parents, children = forest(len(sets), near)
    none = [np.zeros(0, np.int64)]
    return nodes[np.concatenate(none + parents)], nodes[np.concatenate(none + children)]


def _mark(shingle: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in MARKED.split(", ")]
        for batch in batches:
            done = 0
            for block in text_blocks(batch.column(2)):
                values, starts = shingle_sets(words(block, lower=True), shingle)
                found = signatures(values, starts)
                d1, d2 = set_digests(values, starts)
                size, n = np.diff(starts), len(block)
                some = pa.array(size == 0)
                raw = pa.py_buffer(np.ascontiguousarray(found.astype(np.uint8)))
                sig = pa.FixedSizeBinaryArray.from_buffers(pa.binary(HASHES), n, [None, raw]).cast(pa.binary())
                offsets = pa.array((np.arange(n + 1) * BANDS).astype(np.int32))
                bands = pa.ListArray.from_arrays(offsets, pa.array(band_keys(found).reshape(-1)), mask=some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, n), batch.column(1).slice(done, n), pa.array(size), pa.array(d1), pa.array(d2), sig, bands], names
                )
                done += n

    return of_batches


def _runs(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], int]) -> Iterator[pa.Table]:
    """Whole groups (first column, sorted) of several batches at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        group = batch.column(0).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(group != group[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if not cut and held and held[-1].column(0)[-1].as_py() != group[-1]:
            yield pa.Table.from_batches(held)
            held = []
        elif cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(binary: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(binary.to_pylist()), np.uint8).reshape(-1, HASHES)


def _pairs(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _candidates(table: list[tuple[int, int]]):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, len):
            yield _pairs(*candidate_links(run.column(0).to_numpy(), run.column(1).to_numpy(), _matrix(run.column(2)), table))

    return of_batches


def _verified(table: list[tuple[int, int]], shingle: int, percent: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, sets, sigs = None, [], [], []
        seen: set[int] = set()

        def links() -> pa.RecordBatch:
            if len(nodes) < 2:
                return _pairs(np.zeros(0, np.int64), np.zeros(0, np.int64))
            return _pairs(*exact_links(np.array(nodes), sets, _matrix(pa.chunked_array([pa.array(sigs, pa.binary())])), table, percent))

        for batch in batches:
            done = 0
            for block in text_blocks(batch.column(5)):
                values, starts = shingle_sets(words(block, lower=True), shingle)
                d1, d2 = set_digests(values, starts)
                own = [c.slice(done, len(block)) for c in batch.columns[:5]]
                done += len(block)
                # Rows of a repeated id that hold another text do not belong here.
                right = (d1 == own[2].to_numpy()) & (d2 == own[3].to_numpy())
                groups, classes, sig = own[0].to_pylist(), own[1].to_pylist(), own[4].to_pylist()
                for i in np.flatnonzero(right).tolist():
                    if groups[i] != group:
                        yield links()
                        group, nodes, sets, sigs, seen = groups[i], [], [], [], set()
                    if classes[i] not in seen:
                        seen.add(classes[i])
                        nodes.append(classes[i])
                        sets.append(values[starts[i] : starts[i + 1]].copy())
                        sigs.append(sig[i])
        yield links()

    return of_batches


def _dealt(rows: DataFrame, key: Column, chunk_by: Column, chunks: Column) -> DataFrame:
    """Rows with a ``group``: a key with several chunks is dealt out as all pairs of them."""
    return (
        rows.withColumn("__n", chunks.cast("int"))
        .withColumn("__chunk", F.pmod(F.xxhash64(chunk_by), F.col("__n").cast("long")).cast("int"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
        .withColumn("group", F.xxhash64(key, F.least("__chunk", "__other"), F.greatest("__chunk", "__other")))
        .drop("__n", "__chunk", "__other")
    )


def candidates(reps: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links ``u``, ``v`` that span the surviving candidates among ``reps`` (``cls, sig, bands``)."""
    keyed = reps.select(F.explode("bands").alias("key"), "cls")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    dealt = _dealt(keyed.join(shared, "key"), F.col("key"), F.col("cls"), F.ceil(F.col("n") / group_limit)).select("group", "cls")
    rows = dealt.join(reps.select("cls", "sig"), "cls").select("group", "cls", "sig")
    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(_candidates(least_matches()), LINKS)


def verified(
    docs: DataFrame, reps: DataFrame, clusters: DataFrame, shingle: int = 2, percent: int = THRESHOLD, limit: int = CLUSTER_LIMIT
) -> DataFrame:
    """Links ``u``, ``v`` that span the documents of each cluster whose full sets are similar.

    ``docs`` has ``doc_id`` and ``text``, ``reps`` their classes (``cls, doc_id, n, d1, d2, sig``) and
    ``clusters`` the clusters (``node, root``) of :func:`~tablecheck.llm.components.components`.
    """
    members = clusters.select(F.col("node").alias("cls"), "root").union(clusters.select(F.col("root").alias("cls"), "root").distinct())
    own = members.join(reps.select("cls", F.col("doc_id").alias("__id"), "n", "d1", "d2", "sig"), "cls")
    total = own.groupBy("root").agg(F.sum("n").alias("__total"))
    with_text = docs.join(own, docs["doc_id"].eqNullSafe(own["__id"])).join(total, "root")
    dealt = _dealt(with_text, F.col("root"), F.col("cls"), F.ceil(F.col("__total") / limit))
    rows = dealt.select("group", "cls", "d1", "d2", "sig", "text").repartition("group").sortWithinPartitions("group")
    return rows.mapInArrow(_verified(least_matches(), shingle, percent), LINKS)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 2) -> DataFrame:
    """Size of the set and group of every document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    A group is all documents reachable over links; its id is its smallest document
    id, and that document is kept. A null text counts as empty; a document without
    words has an empty set and is a group of its own. A null document id keeps its
    row, is not kept, and never names a group unless the group has no other id.
    Repeated ids and rows keep their rows; an id that is repeated with other texts
    links all of them as separate documents. An empty table gives an empty result.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    path = scratch_path(spark, "sets")
    plain.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(_mark(shingle), MARKED).write.parquet(path)
    marked = spark.read.schema(MARKED).parquet(path)
    named = F.when(F.col("doc_id").isNotNull(), F.col("row"))
    classes = (
        marked.filter("n > 0").groupBy("d1", "d2")
        .agg(F.coalesce(F.min(named), F.min("row")).alias("cls"), F.min("doc_id").alias("first"))
    )
    path = scratch_path(spark, "classes")
    marked.join(classes.select("cls"), F.col("row") == F.col("cls")).drop("row").write.parquet(path)
    reps = spark.read.schema("doc_id long, n long, d1 long, d2 long, sig binary, bands array<long>, cls long").parquet(path)
    clusters = components(candidates(reps))
    roots = components(verified(plain, reps, clusters, shingle))
    rooted = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("d1", "d2", "first", F.coalesce("root", "cls").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("__component"))
    of_class = rooted.join(least, "root").select("d1", "d2", "__component")
    joined = marked.filter("n > 0").select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"])
    alone = marked.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("__component"))
    return joined.select("doc_id", "n", "__component").union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("__component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("__component"), F.lit(False)).alias("kept"),
    )
