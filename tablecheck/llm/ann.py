"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more dimension that gives all of them the same length, so the
largest inner product is the smallest distance; then a random rotation spreads
every vector evenly over its dimensions. Each vector belongs to the list of its
nearest centre. A query goes to its nearest lists and reads them in blocks of
dimensions: after each block the partial distance, scaled up to all dimensions,
is tested against a distance within which enough neighbours are known to lie,
and candidates that are farther with high confidence are left. Survivors are
scored exactly on the original vectors.

How many lists a query probes is measured: held against brute force on the
sample that the index is fitted on, it is the smallest share of the lists that
reaches the wanted recall. Well clustered vectors need few; for vectors without
any structure it is about half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..sources.scratch import scratch_path
from .batches import ship, sum_runs

SAMPLE = 20_000
LISTS = 4096
SEEDS = 4096
TRIED = 300
RECALL = 0.95
COLUMNS = 16
CONFIDENCE = 2.8
CHUNK = 20_000
#: Pairs of a query and a vector that are held at once, and the share of them from which on all are multiplied.
CELLS = 2_000_000
DENSE = 0.2
CENTRE_ROUNDS = 8


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (``vec_id``, ``vector``) that take part: no null, zero or non-finite vectors, no null id."""
    vector = F.col(embedding).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)
    )


def closest_of_each(far: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least distance of each id along the last axis, where rows of an id stand together."""
    return np.minimum.reduceat(far, np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])), axis=-1)


class Index(NamedTuple):
    """Rotation, the common length, centres, the lists to probe, and some rotated vectors with their ids in order."""

    rotation: np.ndarray
    length: float
    centres: np.ndarray
    probes: int
    seed_ids: np.ndarray
    seeds: np.ndarray

    def rotated(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Vectors in the rotated space; a query has nothing in the extra dimension."""
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.length**2 - np.square(x).sum(axis=1), 0))
        return np.concatenate([x, extra[:, None]], axis=1) @ self.rotation

    def distances(self, rotated: np.ndarray) -> np.ndarray:
        return np.square(self.centres).sum(axis=1) - 2 * rotated @ self.centres.T


    def limits(self, ids: np.ndarray, rotated: np.ndarray, probed: np.ndarray, k: int) -> np.ndarray:
        """A squared distance within which each query has ``k`` neighbours of different ids in its probed lists, from the seeds there;
        infinite where they are too few. ``probed`` has a row per query and a column per list."""
        if len(np.unique(self.seed_ids)) <= k:
            return np.full(len(rotated), np.inf)
        far = np.square(self.seeds).sum(axis=1) - 2 * rotated @ self.seeds.T + np.square(rotated).sum(axis=1)[:, None]
        far[(ids[:, None] == self.seed_ids) | ~probed[:, self.distances(self.seeds).argmin(axis=1)]] = np.inf
        return np.partition(closest_of_each(far, self.seed_ids), k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 1e-9


def probes_needed(index: Index, ids: np.ndarray, points: np.ndarray, plain: np.ndarray, k: int, recall: float, seed: int) -> int:
    """The fewest lists in which ``recall`` of the ``k`` nearest of some points lie; ``ids`` are in order.

    Each id counts once for a point, with its nearest row.
    """
    tried = np.random.default_rng(seed).permutation(len(points))[:TRIED]
    asked = index.rotated(plain[tried], True)
    far = np.square(points).sum(axis=1) - 2 * asked @ points.T
    far[ids[tried][:, None] == ids] = np.inf
    least, others = closest_of_each(far, ids), len(np.unique(ids)) - 1
    group = np.cumsum(np.concatenate([[True], ids[1:] != ids[:-1]])) - 1
    if len(least[0]) < len(ids):
        for row, best in zip(far, least):
            # Only the first of an id's nearest rows remains.
            at = np.flatnonzero(row == best[group])
            keep = at[np.unique(group[at], return_index=True)[1]]
            rest = np.full(len(row), np.inf)
            rest[keep] = row[keep]
            row[:] = rest
    near = np.argsort(far, axis=1, kind="stable")[:, : min(k, others)]
    of_list = index.distances(points).argmin(axis=1)
    place = np.argsort(np.argsort(index.distances(asked), axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.sort(place[np.arange(len(tried))[:, None], of_list[near]].ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) + 1 if len(needed) else 1


def build(
    rows: DataFrame, dimension: int, k: int, sample: int = SAMPLE, lists: int = LISTS, recall: float = RECALL, seed: int = 9
) -> Index:
    """Centres by k-means on about ``sample`` vectors chosen by a hash of the row; the lengths of all count."""
    n, total, longest = rows.agg(
        F.count_distinct("vec_id"), F.count(F.lit(1)), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    ).first()
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dimension + 1, dimension + 1)))[0]
    index = Index(rotation, math.sqrt(longest), np.zeros((1, dimension + 1)), 1, np.zeros(0), np.zeros((0, dimension + 1)))
    # By id and vector, so an id with very many vectors does not fill the sample.
    share = int((1 << 30) * min(1.0, sample / total)) + 1
    got = rows.filter(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30)) < share).distinct().collect()
    got.sort(key=lambda r: (r["vec_id"], r["vector"]))
    plain = np.array([r["vector"] for r in got], float).reshape(-1, dimension)
    points = index.rotated(plain, False)
    distinct = np.unique(points, axis=0)
    if not len(points):
        return index
    count = max(1, min(lists, int(math.sqrt(n) / 2), len(distinct)))
    centres = distinct[rng.choice(len(distinct), count, replace=False)]
    for _ in range(CENTRE_ROUNDS):
        near = (np.square(centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        order = np.argsort(near, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(near, minlength=count))])
        size = np.diff(starts)
        centres = np.where(size[:, None] > 0, sum_runs(points[order], starts) / np.maximum(size, 1)[:, None], centres)
    ids, chosen = np.array([r["vec_id"] for r in got]), np.sort(rng.permutation(len(points))[:SEEDS])
    index = index._replace(centres=centres, seed_ids=ids[chosen], seeds=points[chosen])
    return index._replace(probes=probes_needed(index, ids, points, plain, k, recall, seed))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _least_of_ids(query: np.ndarray, ids: np.ndarray, value: np.ndarray, k: int, among: int) -> np.ndarray:
    """For each of ``among`` queries the ``k``-th least value over different ids; infinite where there are fewer."""
    order = np.lexsort((value, ids, query))
    q, i = query[order], ids[order]
    first = np.ones(len(order), bool)
    first[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1])
    order = order[first]
    order = order[np.lexsort((value[order], query[order]))]
    starts = np.searchsorted(query[order], np.arange(among + 1))
    bound = np.full(among, np.inf)
    full = np.diff(starts) >= k
    bound[full] = value[order][starts[:-1][full] + k - 1]
    return bound


def scan(
    asked: np.ndarray, ids: np.ndarray, near: np.ndarray, columns: int, k: int, limits: np.ndarray, confidence: float = CONFIDENCE
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) where the row of ``near`` may be of the ``k`` ids closest to the query (rotated vectors), within its limit.

    ``ids`` are those of the rows, in order; an id is as close as its closest row.
    Blocks of columns are multiplied for all pairs while most of them are left,
    then for those that are.
    """
    total, n = near.shape[1], len(near)
    limits = limits.copy()
    open_ended = np.flatnonzero(np.isinf(limits))
    if len(open_ended) and n > 4 * k:
        some = near[: 4 * k]
        far = np.square(asked[open_ended]).sum(axis=1)[:, None] - 2 * asked[open_ended] @ some.T + np.square(some).sum(axis=1)
        least = closest_of_each(far, ids[: 4 * k])
        if least.shape[1] >= k:
            limits[open_ended] = np.partition(least, k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 1e-9
    partial = np.zeros((len(asked), n))
    q = r = p = None
    for at in range(0, total, columns):
        part = slice(at, min(at + columns, total))
        seen = part.stop
        # The partial distance of a rotated vector is its share of the whole up to a deviation of about 1 / sqrt(seen).
        slack = (1 + confidence / math.sqrt(seen)) ** 2 if seen < total else 1 + 1e-9
        allowed = limits * min(1.0, seen / total * slack) * (1 + 1e-9) + 1e-9
        if q is None:
            partial += np.square(asked[:, part]).sum(axis=1)[:, None] - 2 * asked[:, part] @ near[:, part].T + np.square(near[:, part]).sum(axis=1)
            keep = partial <= allowed[:, None]
            if keep.mean() < DENSE or seen == total:
                q, r = np.nonzero(keep)
                p = partial[q, r]
        else:
            p = p + np.square(near[r, part] - asked[q, part]).sum(axis=1)
            keep = p <= allowed[q]
            q, r, p = q[keep], r[keep], p[keep]
    bound = _least_of_ids(q, ids[r], p, k, len(asked))
    keep = p <= bound[q] * (1 + 1e-9) + 1e-9
    return q[keep], r[keep]


def _searcher(index: Index, dimension: int, k: int, columns: int):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            ids, original = right["vec_id"].to_numpy(), np.array(right["vector"].tolist(), float).reshape(-1, dimension)
            rotated = index.rotated(original, False)
            plain = np.array(left["vector"].tolist(), float).reshape(-1, dimension)
            turned, limits, query_ids = index.rotated(plain, True), left["limit"].to_numpy(), left["vec_id"].to_numpy()
            step = max(1, CELLS // len(ids))
            for at in range(0, len(plain), step):
                own = slice(at, at + step)
                # One more than asked for, as the query may meet itself.
                q, r = scan(turned[own], ids, rotated, columns, k + 1, limits[own])
                other = ids[r] != query_ids[own][q]
                q, r = q[other], r[other]
                score = (original[r] * plain[own][q]).sum(axis=1)
                # The best row of each id, then the best ids.
                order = np.lexsort((-score, ids[r], q))
                first = np.ones(len(order), bool)
                first[1:] = (q[order][1:] != q[order][:-1]) | (ids[r][order][1:] != ids[r][order][:-1])
                order = order[first]
                order = order[np.lexsort((ids[r][order], -score[order], q[order]))]
                place = np.arange(len(order)) - np.searchsorted(q[order], q[order])
                order = order[place < k]
                out.append(pd.DataFrame({"query_id": query_ids[own][q[order]], "vec_id": ids[r[order]], "score": score[order]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return search


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = RECALL, columns: int = COLUMNS, lists: int = LISTS,
    sample: int = SAMPLE, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found of each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Ties go to the smaller id; a query's own row is no candidate. Null or zero
    vectors, vectors with null or non-finite components and rows without id take no part,
    and all others must have the length of the first. Rows that share an id count as
    one with its best score. A query probes more lists where its own hold too
    few vectors, so it gets ``k`` results wherever there are as many candidates. Lists of more than
    ``CHUNK`` vectors are searched in chunks. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows, asked = usable(vectors, vec_id, embedding), usable(queries, vec_id, embedding)
    first = rows.select(F.size("vector").alias("d")).first()
    empty = spark.sql("select cast(null as long) query_id, 0 rank, cast(null as long) vec_id, cast(0 as double) score where false")
    if first is None:
        return empty
    dimension = int(first["d"])
    index = build(rows, dimension, k, sample, lists, recall)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = index.rotated(_matrix(batch.column(1), dimension), False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(index.distances(x).argmin(axis=1), pa.int32())], ["vec_id", "vector", "list"]
            )

    path = scratch_path(spark, "lists")
    rows.mapInArrow(assign, "vec_id long, vector array<double>, list int").write.parquet(path)
    placed = spark.read.schema("vec_id long, vector array<double>, list int").parquet(path)
    # As many counts as there are centres, which a parameter bounds.
    sizes = np.zeros(len(index.centres), np.int64)
    for row in placed.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    # Ids that have rows in several lists count in one of them only, so lists that hold enough by this count do.
    own = np.zeros(len(index.centres), np.int64)
    for row in placed.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        own[row["list"]] = row["count"]
    enough = 4 * (k + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = index.rotated(_matrix(batch.column(1), dimension), True)
            order = index.distances(turned).argsort(axis=1, kind="stable")
            held = own[order].cumsum(axis=1)
            need = np.maximum((held < enough).sum(axis=1) + 1, index.probes)
            probed = np.zeros(order.shape, bool)
            np.put_along_axis(probed, order, np.arange(order.shape[1]) < need[:, None], axis=1)
            limit = pa.array(index.limits(batch.column(0).to_numpy(), turned, probed, k + 1))
            pairs = [(i, c) for i in range(len(order)) for c in order[i, : need[i]].tolist() if sizes[c]]
            at = pa.array([i for i, _ in pairs], pa.int64())
            lists_of = pa.array([c for _, c in pairs], pa.int32())
            columns_of = [c.take(at) for c in [*batch.columns, limit]]
            yield pa.RecordBatch.from_arrays([*columns_of, lists_of], ["vec_id", "vector", "limit", "list"])

    chunks = F.element_at(F.array(*[F.lit(max(1, math.ceil(int(n) / CHUNK))) for n in sizes]), F.col("list") + 1)
    chunked = placed.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), chunks.cast("long")).cast("int"))
    probing = asked.mapInArrow(probe, "vec_id long, vector array<double>, limit double, list int").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), chunks - 1))
    )
    found = (
        probing.groupBy("list", "chunk").cogroup(chunked.groupBy("list", "chunk"))
        .applyInPandas(_searcher(index, dimension, k, columns), "query_id long, vec_id long, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
