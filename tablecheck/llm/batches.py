"""Arrow helpers that the operators of this folder share.

Texts reach Python as Arrow arrays. They are worked on in blocks of bounded
size, and words are dictionary-encoded per block, so that work done for a word
(hashing, features, sub-word ids) is done once per distinct word of a block.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK_BYTES = 8 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tablecheck-py-")), "tablecheck_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


class Words(NamedTuple):
    """Words of a block: one code per word, the first word of each text, and the distinct words."""

    codes: np.ndarray
    starts: np.ndarray
    vocab: pa.Array

    def of_text(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of at most ``limit`` bytes (one text may be larger); null becomes empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first, base = 0, 0
    while first < len(texts):
        last = max(int(np.searchsorted(ends, base + limit, side="right")), first + 1)
        yield texts.slice(first, last - first)
        # What a block needed goes back to the system before the next one; workers live long.
        pa.default_memory_pool().release_unused()
        first, base = last, int(ends[last - 1])


def encode(flat: pa.Array, starts: np.ndarray) -> Words:
    """Code the flattened pieces of each text; empty pieces are left out."""
    coded = flat.dictionary_encode()
    codes, vocab = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = pc.index(vocab, pa.scalar("", vocab.type)).as_py()
    if empty >= 0:
        keep = codes != empty
        kept = np.concatenate([[0], np.cumsum(keep)])
        codes, starts = codes[keep], kept[starts]
    return Words(codes, starts.astype(np.int64), vocab)


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Runs of characters other than ASCII white space; ``lower`` folds A-Z only."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy()
    return encode(lists.flatten(), offsets - offsets[0])


def bytes_of(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the strings, and where each string starts (one more entry than strings)."""
    if not len(vocab):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = vocab.buffers()
    at = np.frombuffer(offsets, np.int32)[vocab.offset : vocab.offset + len(vocab) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return raw, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sum_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each run ``starts[i]:starts[i+1]``; an empty run gives zero."""
    total = np.zeros((len(starts) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(starts) > 0)
    if len(full):
        total[full] = np.add.reduceat(values, starts[full], axis=0)
    return total


def hash_words(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash per string: each byte times a random weight of its place, summed and scrambled."""
    raw, at = bytes_of(vocab)
    length = np.diff(at)
    place = np.arange(len(raw)) - np.repeat(at[:-1], length)
    weights = mix(np.arange(int(length.max(initial=0)) + 1, dtype=np.uint64) + np.uint64(seed * 7919 + 1))
    with np.errstate(over="ignore"):
        return mix(sum_runs((raw.astype(np.uint64) + np.uint64(1)) * weights[place], at) + np.uint64(seed))
