"""JSON array files of any size, read by many tasks.

A file is cut at closing braces by Spark's text reader, which splits large files.
Whether a brace closes an element depends on all text before it: an odd number of
quotes means that it stands inside a string, and other braces may still be open.
So a first pass sums up, for each split, what it does to either state at its
start; a fold over these sums, one small row per split, gives every split its
true state. The second pass then knows each element's bounds without guessing.
An element that crosses splits leaves a piece in each, and the pieces are joined.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import scratch_path

# The functions below go to the workers themselves, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ESCAPE = re.compile(r"\\.", re.S)
_STRING_OR_BRACE = re.compile(r'"(?:[^"\\]|\\.)*"?|\{', re.S)
_WHOLE, _PIECE = 0, 1
_SUMS = "file string, start long, quotes int, out_delta long, out_least long, in_delta long, in_least long"
_OUT = "kind int, value string"


def _braces(chunk: str) -> tuple[list[int], int]:
    """Opening braces of a chunk outside strings, if it starts outside or inside of one, and its quotes."""
    plain = _ESCAPE.sub("", chunk) if "\\" in chunk else chunk
    parts = plain.split('"')
    return [sum(p.count("{") for p in parts[0::2]), sum(p.count("{") for p in parts[1::2])], len(parts) - 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        # Paths are long and the same in most rows, so each is made a text once.
        files = batch.column(0).dictionary_encode()
        names = files.dictionary.to_pylist()
        for file, start, chunk in zip(files.indices.to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            yield names[file], start, chunk


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does: the quotes in it, and the change and the least of the open braces, for either state at its start."""
    kinds = [pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
    names = [c.split()[0] for c in _SUMS.split(", ")]

    def row(at, quotes, delta, least) -> pa.RecordBatch:
        values = [*at, quotes % 2, delta[0], least[0], delta[1], least[1]]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    at, quotes, delta, least = None, 0, [0, 0], [0, 0]
    for file, start, chunk in _chunks(batches):
        if (file, start) != at:
            if at is not None:
                yield row(at, quotes, delta, least)
            at, quotes, delta, least = (file, start), 0, [0, 0], [1 << 60, 1 << 60]
        opened, more = _braces(chunk)
        for first in (0, 1):
            inside = (first + quotes) % 2
            delta[first] += opened[inside]
            if (inside + more) % 2 == 0:
                delta[first] -= 1
            least[first] = min(least[first], delta[first])
        quotes += more
    if at is not None:
        yield row(at, quotes, delta, least)


def _states(sums: list) -> dict[tuple[str, int], tuple[int, int, int]]:
    """For each split whether it starts inside a string, the braces open there, and the split in which the open element began."""
    states, file = {}, None
    for s in sorted(sums):
        if s.file != file:
            file, inside, depth, owner = s.file, 0, 0, s.start
        states[s.file, s.start] = (inside, depth, owner)
        delta, least = (s.in_delta, s.in_least) if inside else (s.out_delta, s.out_least)
        if depth + min(least, 0) <= 0:
            owner = s.start
        depth, inside = max(depth + delta, 0), (inside + s.quotes) % 2
    return states


def _first_brace(chunk: str, inside: int) -> int:
    """Where the first brace outside a string stands, or -1."""
    at = chunk.find("{")
    if at < 0 or (not inside and '"' not in chunk[:at]):
        return at
    # A string that is open gets a quote to start with.
    return next((m.start() - inside for m in _STRING_OR_BRACE.finditer('"' * inside + chunk) if m[0] == "{"), -1)


def _elements(states: Broadcast):
    """``states`` are those of all splits, loaded once per worker and not once per split."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, str]] = []
        at, inside, depth, owner = None, 0, 0, 0
        parts: list[str] = []
        size = 0

        def piece() -> None:
            if parts:
                found.append((_PIECE, json.dumps({"file": at[0], "owner": owner, "start": at[1], "text": "".join(parts)})))
                parts.clear()

        def out() -> pa.RecordBatch:
            kind, text = [k for k, _ in found], [t for _, t in found]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(text, pa.string())], ["kind", "value"])

        for file, start, chunk in _chunks(batches):
            if (file, start) != at:
                piece()
                at = (file, start)
                inside, depth, owner = states.value[at]
            size += len(chunk)
            if depth == 0:
                # Between elements, or in one that is no object.
                first = _first_brace(chunk, inside)
                if first < 0:
                    inside = (inside + _braces(chunk)[1]) % 2
                    continue
                chunk, owner, inside = chunk[first:], start, 0
            # Line breaks stand between tokens only; within strings they are escaped.
            parts.append(chunk.replace("\n", " ").replace("\r", " ") + "}")
            opened, quotes = _braces(chunk)
            depth += opened[inside]
            inside = (inside + quotes) % 2
            if not inside:
                depth -= 1
                if depth == 0:
                    if owner == start:
                        found.append((_WHOLE, "".join(parts)))
                        parts.clear()
                    else:
                        piece()
            if size > 1 << 22:
                yield out()
                size = 0
        piece()
        yield out()

    return of_batches


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, split_bytes: int | None = None
) -> DataFrame:
    """The objects of JSON array files as rows, each file read by as many tasks as it has splits.

    Also a file that holds one object, or objects one after another, is read.
    Elements that are no objects have no row; an empty array has none. The files
    are read twice, at once; the elements are left as JSON Lines in the shared
    folder, from which Spark reads them with ``schema`` or finds one. The driver
    folds one row of seven numbers per split. ``split_bytes`` sets the size of
    the splits for this read. Compressed files are one split each.
    """
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split_bytes is not None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        cut = spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
        )
        states = _states(cut.mapInArrow(_sums, _SUMS).collect())
        target = scratch_path(spark, "elements")
        cut.mapInArrow(_elements(spark.sparkContext.broadcast(states)), _OUT).write.partitionBy("kind").text(target)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    places = []
    if any(depth for _, depth, _ in states.values()):
        pieces = spark.read.schema("file string, owner long, start long, text string").json(f"{target}/kind={_PIECE}")
        ordered = F.array_sort(F.collect_list(F.struct("start", "text")))
        whole = pieces.groupBy("file", "owner").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("value"))
        whole.select("value").write.text(f"{target}/joined")
        places.append(f"{target}/joined")
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.json([f"{target}/kind={_WHOLE}", *places])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    if places:
        return reader.json(places)
    return spark.createDataFrame([], schema or T.StructType([]))
