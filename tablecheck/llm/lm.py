"""Scores of a hashed maximum-entropy language model with a class-factored softmax.

The probability of a word given its history is that of its class times that of
the word within its class. Class logits are sums of weights of hashed features:
the word before (a bigram), the word before that (a skip), and both (a trigram).
The most frequent words form classes of ``SLOTS`` words, within which a second
softmax over bigram and skip features chooses. All other words are classed by
the end of the word, and the digits of a hash of the word lead through a tree below
the class: at each branching a softmax over ``SLOTS`` branches with bigram and skip
features, hashed together with the branching, chooses. The tree is so deep that most
leaves hold one word, and the tables of weights grow with the counted words up to
fixed bounds. Words that share a leaf are told apart by smoothed relative frequency.
Words never seen in training share one event, whose probability is that of the words seen once.

Weights are trained by distributed gradient updates: in each round every task
takes gradient steps over its share of one slice of the training documents, and
the changes of each row of weights are averaged over tasks by how often each task
met the row. Scoring runs in numpy batches; counts of rare words are joined.
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

from ..sources.scratch import scratch_path
from .batches import Words, hash_words, mix, ship, text_blocks, words

HEAD_CLASSES = 16
SLOTS = 16
TAIL_CLASSES = 48
CLASSES = HEAD_CLASSES + TAIL_CLASSES
#: Rows per feature of the tables of weights: the least, and the most that a large vocabulary gets.
BUCKETS = (4096, 16384)
SLOT_BUCKETS = (1024, 2048)
TREE_BUCKETS = (4096, 32768)
MAX_DEPTH = 4
HOT_WORDS = 1 << 16
ROUNDS = 3
STEP_TOKENS = 1 << 14
RATE = 0.35
DECAY = 1e-5
PIECES = 16
SUMMED_TASKS = 256
EMPTY = -39.0
END = "\n"  # no word holds white space
BLOCK_BYTES = 4 << 20
COUNTED = "word string, n long"
CHANGES = "piece int, weights binary, met binary"
SCORED = "row long, word string, n long, s double, whole struct<doc_id: long, tokens: long, known: long, base: double>"


class Tokens(NamedTuple):
    """The words of a block in order, each text closed by the end: word numbers, where texts start, features, and the hash of each word number."""

    codes: np.ndarray
    starts: np.ndarray
    one: np.ndarray
    two: np.ndarray
    both: np.ndarray
    own: np.ndarray


def read_tokens(found: Words) -> Tokens:
    """Tokens of a block; code ``len(vocab)`` is the end, and the history of a first word is the start of text."""
    end = len(found.vocab)
    hashes = np.append(hash_words(found.vocab, 21), [np.uint64(1), np.uint64(2)])
    codes = np.insert(found.codes.astype(np.int64), found.starts[1:], end)
    starts = found.starts + np.arange(len(found.starts))
    one, two = np.full(len(codes), end + 1, np.int64), np.full(len(codes), end + 1, np.int64)
    one[1:], two[2:] = codes[:-1], codes[:-2]
    first = starts[:-1]
    one[first] = end + 1
    two[first] = end + 1
    second = first[np.diff(starts) > 1] + 1
    two[second] = end + 1
    h1, h2 = hashes[one], hashes[two]
    return Tokens(codes, starts, h1, h2, mix(h1 ^ (h2 << np.uint64(1))), hashes[:-1])


def tail_classes(vocab: pa.Array) -> np.ndarray:
    """The class of each word that has no place among the frequent ones: by its last two letters and its closing mark."""
    bare = pc.utf8_rtrim(vocab, ".,;:!?*$&%#|\"'()-")
    marked = pc.not_equal(pc.binary_length(bare), pc.binary_length(vocab)).to_numpy(zero_copy_only=False)
    ends = hash_words(pc.utf8_slice_codeunits(bare, start=-2), 22)
    return (HEAD_CLASSES + mix(ends ^ marked.astype(np.uint64)) % np.uint64(TAIL_CLASSES)).astype(np.int64)


def tree_leaves(of_class: np.ndarray, hashes: np.ndarray, depth: int) -> np.ndarray:
    """The leaf of each word at that depth of the tree below its tail class."""
    return (of_class - HEAD_CLASSES) * SLOTS**depth + (hashes >> np.uint64(64 - 4 * depth)).astype(np.int64)


def depth_for(distinct: int) -> int:
    """The least depth with four leaves a word, within ``MAX_DEPTH``."""
    return next((d for d in range(1, MAX_DEPTH) if TAIL_CLASSES * SLOTS**d >= 4 * distinct), MAX_DEPTH)


def rows_for(total: int, bounds: tuple[int, int], share: int) -> int:
    """A power of two of about one row for ``share`` words of the training text, within bounds.

    Every task sends its changes of all rows, so tables have to stay small beside the text.
    """
    return min(max(bounds[0], 1 << (max(total // share, 1) - 1).bit_length()), bounds[1])


class Model(NamedTuple):
    """Counts that the model is built on, the frequent words, and the weights as one table of rows.

    Rows of ``classes`` are the buckets of the three features; rows of ``slots``
    the buckets of two features for each frequent class; rows of ``tree`` the
    buckets of two features at the branchings below the tail classes. ``tree_bias``
    has the logarithms of the shares of the branches, one table per depth, and
    ``tree_forks`` which branchings have more than one branch with words.
    """

    total: int
    distinct: int
    ends: int
    unseen: float
    head: list[str]
    hot: pa.Array
    hot_counts: np.ndarray
    class_bias: np.ndarray
    slot_bias: np.ndarray
    tail_size: np.ndarray
    classes: np.ndarray
    slots: np.ndarray
    tree: np.ndarray
    tree_bias: list[np.ndarray]
    tree_forks: list[np.ndarray]

    def places(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Class and slot of each word and of the end; slot -1 outside the frequent classes."""
        rank = {w: k for k, w in enumerate(self.head)}
        found = pc.index_in(vocab, value_set=pa.array(self.head, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
        found = np.append(found, rank.get(END, -1)).astype(np.int64)
        of_class = np.append(tail_classes(vocab), HEAD_CLASSES)
        return np.where(found >= 0, found // SLOTS, of_class), np.where(found >= 0, found % SLOTS, -1)


#: Rows of logits that are worked on at once, so that they stay in the cache of a core.
ROWS = 2048


def _logits(
    table: np.ndarray, features: tuple[np.ndarray, ...], bias: np.ndarray, of_row: np.ndarray | None = None
) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of rows with their logits: the sum of a row of the table for each feature and of the bias, or its row ``of_row``."""
    for low in range(0, len(features[0]), ROWS):
        part = slice(low, low + ROWS)
        # Rows are known to exist, so "clip" spares a check of each.
        total = table.take(features[0][part], axis=0, mode="clip")
        for feature in features[1:]:
            total += table.take(feature[part], axis=0, mode="clip")
        total += bias if of_row is None else bias.take(of_row[part], axis=0, mode="clip")
        yield part, total


#: Sums of exponentials beyond these may have lost their terms to underflow, or overflown.
SUMS = (1e-25, 1e30)


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of the logits less a level, their sum per row, and the level of each row."""
    ones = np.ones(logits.shape[1], logits.dtype)
    # Most rows need no level, which spares their maximum and a subtraction.
    with np.errstate(over="ignore"):
        raised = np.exp(logits)
    total, level = raised @ ones, np.zeros(len(logits), logits.dtype)
    odd = np.flatnonzero(~((total > SUMS[0]) & (total < SUMS[1])))
    if len(odd):
        level[odd] = logits[odd].max(axis=1)
        raised[odd] = np.exp(logits[odd] - level[odd, None])
        total[odd] = raised[odd] @ ones
    return raised, total, level


def _softmax(logits: Iterator[tuple[slice, np.ndarray]], n: int, width: int) -> np.ndarray:
    """Probabilities of all ``n`` rows."""
    out = np.empty((n, width), np.float32)
    for part, some in logits:
        raised, total, _ = _exponentials(some)
        np.multiply(raised, (1 / total)[:, None], out=out[part])
    return out


class Raised(NamedTuple):
    """A table of weights and one of biases, with their exponentials, whose products need no exponential of each row."""

    table: np.ndarray
    bias: np.ndarray
    of_table: np.ndarray
    of_bias: np.ndarray

    @classmethod
    def of(cls, table: np.ndarray, bias: np.ndarray) -> Raised:
        with np.errstate(over="ignore"):
            return cls(table, bias, np.exp(table), np.exp(bias))

    def log_sums(self, features: tuple[np.ndarray, ...], of_row: np.ndarray | None = None) -> np.ndarray:
        """The logarithm of the sum of the exponentials of each row's logits; see ``_logits``."""
        out = np.empty(len(features[0]))
        for low in range(0, len(out), ROWS):
            part = slice(low, low + ROWS)
            with np.errstate(all="ignore"):
                product = self.of_table.take(features[0][part], axis=0, mode="clip")
                for feature in features[1:]:
                    product *= self.of_table.take(feature[part], axis=0, mode="clip")
                if of_row is None:
                    total = product @ self.of_bias
                else:
                    total = np.einsum("ij,ij->i", product, self.of_bias.take(of_row[part], axis=0, mode="clip"))
                out[part] = np.log(total)
            odd = low + np.flatnonzero(~((total > SUMS[0]) & (total < SUMS[1])))
            if len(odd):
                for some, logits in _logits(self.table, tuple(f[odd] for f in features), self.bias, None if of_row is None else of_row[odd]):
                    _, total, level = _exponentials(logits)
                    out[odd[some]] = np.log(total) + level
        return out

    def weights(self, features: tuple[np.ndarray, ...], column: np.ndarray) -> np.ndarray:
        """The sum of the weights of each row in its column."""
        flat, width = self.table.ravel(), self.table.shape[1]
        return sum(flat.take(f * width + column, mode="clip") for f in features)


def raised_tables(model: Model) -> tuple[Raised, Raised, Raised]:
    """Of the classes, the slots and the tree, whose biases are numbered through all depths."""
    return (
        Raised.of(model.classes, model.class_bias), Raised.of(model.slots, model.slot_bias),
        Raised.of(model.tree, np.concatenate(model.tree_bias)),
    )


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    """One of ``n`` rows, a power of two."""
    return (hashes & np.uint64(n - 1)).astype(np.int64)


def _features(tokens: Tokens, part: slice, table: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(table) // 3
    return tuple(_bucket(h[part], n) + k * n for k, h in enumerate((tokens.one, tokens.two, tokens.both)))


def _slot_features(tokens: Tokens, part: np.ndarray, of_class: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(table) // (2 * HEAD_CLASSES)
    return tuple(
        _bucket(h[part] >> np.uint64(32), n) * HEAD_CLASSES + of_class + k * n * HEAD_CLASSES
        for k, h in enumerate((tokens.one, tokens.two))
    )


class Paths(NamedTuple):
    """The branchings that the words of a block pass, one word behind another: where each word's start, biases, hashes and branches.

    Where at most one branch holds words there is nothing to choose.
    """

    starts: np.ndarray
    bias: np.ndarray
    place: np.ndarray
    branch: np.ndarray


def _paths(model: Model, own: np.ndarray, of_class: np.ndarray, slot: np.ndarray) -> Paths:
    """Rows of biases are numbered through all depths."""
    tail, depth = np.flatnonzero(slot < 0), len(model.tree_forks)
    # Sixteen slots are four bits, so the branches on the way to a leaf are its digits.
    leaf, up = tree_leaves(of_class[tail], own[tail], depth)[:, None], 4 * np.arange(depth, 0, -1)
    nodes, before = leaf >> up, np.cumsum([0, *map(len, model.tree_forks[:-1])])
    rows = nodes + before
    passes = np.concatenate(model.tree_forks)[rows]
    size = np.zeros(len(own), np.int64)
    size[tail] = passes.sum(axis=1)
    places = nodes.astype(np.uint64) + (np.arange(1, depth + 1, dtype=np.uint64) << np.uint64(40))
    return Paths(np.concatenate([[0], np.cumsum(size)]), rows[passes], mix(places[passes]), (leaf >> (up - 4) & (SLOTS - 1))[passes])


def _branchings(
    paths: Paths, tokens: Tokens, part: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...], np.ndarray]:
    """Where the tokens of ``part`` pass a branching: their places in ``part``, rows of biases, features and branches."""
    n, code = len(table) // 2, tokens.codes[part]
    first = paths.starts[code]
    size = paths.starts[code + 1] - first
    ends = np.cumsum(size)
    at = np.repeat(np.arange(len(part)), size)
    path = np.repeat(first - (ends - size), size) + np.arange(len(at))
    token, place = part[at], paths.place[path]
    features = tuple(
        _bucket(mix(h[token] ^ place), n) + k * n for k, h in enumerate((tokens.one, tokens.two))
    )
    return at, paths.bias[path], features, paths.branch[path]


def log_probabilities(
    model: Model, tokens: Tokens, of_class: np.ndarray, slot: np.ndarray, raised: tuple[Raised, Raised, Raised] | None = None
) -> np.ndarray:
    """Natural logarithm of the class probability of each token, and of the word within a frequent class.

    For a tail word it has what the features change in the share of its leaf, so that
    its smoothed count divided by the size of its class completes it. ``raised`` are
    the tables of the model, if they are at hand.
    """
    out = np.empty(len(tokens.codes))
    classes, slots, tree = raised or raised_tables(model)
    paths = _paths(model, tokens.own, of_class, slot)
    for low in range(0, len(out), STEP_TOKENS):
        part = slice(low, min(low + STEP_TOKENS, len(out)))
        c, s = of_class[tokens.codes[part]], slot[tokens.codes[part]]
        features = _features(tokens, part, model.classes)
        out[part] = classes.weights(features, c) + model.class_bias[c] - classes.log_sums(features)
        inside = np.flatnonzero(s >= 0)
        if len(inside):
            own, place = c[inside], s[inside]
            features = _slot_features(tokens, inside + low, own, model.slots)
            out[inside + low] += slots.weights(features, place) + model.slot_bias[own, place] - slots.log_sums(features, own)
        tail = np.flatnonzero(s < 0)
        at, bias, features, branch = _branchings(paths, tokens, tail + low, model.tree)
        if len(at):
            # The bias of the branch is in the share already.
            out[tail + low] += np.bincount(at, tree.weights(features, branch) - tree.log_sums(features, bias), minlength=len(tail))
    return out


LONG_RUN = 24


def sum_rows(values: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct keys (below 65,536), the sum of the rows of each, and their number; ``ROWS`` keys at a time, so that sums stay in the cache.

    There may be several keys a row: the first of all rows, then the second of all, and so on.
    Keys with many rows are summed one by one as products, the others together,
    first rows first, then all second rows, and so on.
    """
    order = np.argsort(key.astype(np.uint16), kind="stable")
    ordered = key[order]
    order = np.tile(np.arange(len(values)), len(key) // len(values))[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.append(starts, len(key)))
    # Sixteen bits are sorted by their digits; which of the longest keys comes first does not matter.
    longest_first = np.argsort((0xFFFF - np.minimum(size, 0xFFFF)).astype(np.uint16), kind="stable")
    starts, size = starts[longest_first], size[longest_first]
    # How many keys have more than so many rows.
    more = len(size) - np.cumsum(np.bincount(np.minimum(size, LONG_RUN), minlength=LONG_RUN + 1))
    long = int(more[LONG_RUN - 1])
    more = more[: LONG_RUN - 1].tolist()
    ones = np.ones(int(size[:long].max(initial=0)), values.dtype)
    for low in range(0, len(starts), ROWS):
        first = starts[low : low + ROWS]
        # The first row of each, then all second rows, and so on.
        total = values.take(order[first], axis=0, mode="clip")
        inside = max(long - low, 0)
        for k in range(min(inside, len(first))):
            total[k] = ones[: size[low + k]] @ values.take(order[first[k] : first[k] + size[low + k]], axis=0, mode="clip")
        for lane in range(1, len(more)):
            some = min(more[lane] - low, len(first))
            if some <= inside:
                break
            total[inside:some] += values.take(order[first[inside:some] + lane], axis=0, mode="clip")
        yield ordered[first], total, size[low : low + ROWS]


class Trainer:
    """Gradient steps of one task, with steps adapted to how much each row of weights has moved."""

    def __init__(self, model: Model):
        self.model = model
        self.tables = [model.classes.copy(), model.slots.copy(), model.tree.copy()]
        self.tree_bias = np.concatenate(model.tree_bias)
        self.moved = [np.full(len(t), 1.0, np.float32) for t in self.tables]
        self.met = [np.zeros(len(t), np.float32) for t in self.tables]

    def _step(self, which: int, features: tuple[np.ndarray, ...], gradient: np.ndarray) -> None:
        table, moved, met = self.tables[which], self.moved[which], self.met[which]
        # The features have rows of their own, so one step serves all.
        for rows, change, size in sum_rows(gradient, np.concatenate(features)):
            weights = table.take(rows, axis=0, mode="clip")
            change += np.float32(DECAY) * weights
            met[rows] += size
            way = moved[rows] + np.einsum("ij,ij->i", change, change) / change.shape[1]
            moved[rows] = way
            change *= (RATE / np.sqrt(way)).astype(np.float32)[:, None]
            weights -= change
            table[rows] = weights

    def learn(self, tokens: Tokens, of_class: np.ndarray, slot: np.ndarray) -> None:
        model, (classes, slots, tree) = self.model, self.tables
        paths = _paths(model, tokens.own, of_class, slot)
        for low in range(0, len(tokens.codes), STEP_TOKENS):
            part = slice(low, min(low + STEP_TOKENS, len(tokens.codes)))
            c, s = of_class[tokens.codes[part]], slot[tokens.codes[part]]
            self._follow(0, _features(tokens, part, classes), model.class_bias, None, c)
            inside = np.flatnonzero(s >= 0)
            if len(inside):
                own = c[inside]
                self._follow(1, _slot_features(tokens, inside + low, own, slots), model.slot_bias, own, s[inside])
            at, bias, features, branch = _branchings(paths, tokens, np.flatnonzero(s < 0) + low, tree)
            if len(at):
                self._follow(2, features, self.tree_bias, bias, branch)

    def _follow(self, which: int, features: tuple[np.ndarray, ...], bias: np.ndarray, of_row: np.ndarray | None, chosen: np.ndarray) -> None:
        """A step towards the chosen column of each row."""
        table = self.tables[which]
        gradient = _softmax(_logits(table, features, bias, of_row), len(chosen), table.shape[1])
        gradient.ravel()[np.arange(0, gradient.size, table.shape[1]) + chosen] -= 1
        self._step(which, features, gradient)

    def changes(self) -> Iterator[tuple[int, bytes, bytes]]:
        """Changes of all rows, at half precision as every task sends them, and how often they were met, in ``PIECES`` pieces per table."""
        for which, (table, before) in enumerate(zip(self.tables, (self.model.classes, self.model.slots, self.model.tree))):
            for k, rows in enumerate(np.array_split(np.arange(len(table)), PIECES)):
                met = self.met[which][rows]
                yield which * PIECES + k, (table[rows] - before[rows]).astype("<f2").tobytes(), met.astype("<f4").tobytes()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_blocks(batch.column(0), BLOCK_BYTES):
            found = words(block, lower=True)
            n = np.bincount(found.codes, minlength=len(found.vocab))
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([found.vocab.take(pa.array(seen)), pa.array([END], pa.string())]),
                 pa.array(np.append(n[seen], len(block)), pa.int64())], ["word", "n"],
            )


def _tail_sizes(head: list[str], depth: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column(0)
            tail = ~pc.is_in(word, value_set=pa.array(head, pa.string())).to_numpy(zero_copy_only=False)
            leaf = tree_leaves(tail_classes(word), hash_words(word, 21), depth)[tail]
            found, where = np.unique(leaf, return_inverse=True)
            size = np.bincount(where, batch.column(1).to_numpy()[tail] + 0.1, minlength=len(found))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(size, pa.float64())], ["leaf", "size"])

    return of_batches


def tree_biases(leaf_sizes: np.ndarray, depth: int) -> list[np.ndarray]:
    """Logarithms of the shares of the branches at each depth; empty branches have -40."""
    sizes, biases = leaf_sizes.reshape(-1, SLOTS), []
    for _ in range(depth):
        whole = sizes.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            biases.insert(0, np.where(sizes > 0, np.maximum(np.log(sizes / whole), EMPTY + 1), EMPTY - 1).astype(np.float32))
        sizes = whole.reshape(-1, SLOTS)
    return biases


def _train_round(model: Model):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, any_text = Trainer(model), False
        for batch in batches:
            for block in text_blocks(batch.column(0), BLOCK_BYTES):
                found = words(block, lower=True)
                trainer.learn(read_tokens(found), *model.places(found.vocab))
                any_text = True
        if any_text:
            piece, weights, met = zip(*trainer.changes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(weights, pa.binary()), pa.array(met, pa.binary())], ["piece", "weights", "met"]
            )

    return of_batches


def _sum_changes(averaged: bool):
    """The sums of all changes of each piece; a task's own changes are averages, those of several tasks are sums."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                met = np.frombuffer(row["met"], "<f4").astype(np.float64)
                weights = np.frombuffer(row["weights"], "<f2" if averaged else "<f4").reshape(len(met), -1)
                got = [weights * met[:, None] if averaged else weights.astype(np.float64), met]
                old = totals.get(row["piece"])
                totals[row["piece"]] = got if old is None else [old[0] + got[0], old[1] + got[1]]
        if totals:
            pieces = sorted(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pieces, pa.int32()), *[pa.array([totals[p][k].astype("<f4").tobytes() for p in pieces], pa.binary()) for k in (0, 1)]],
                ["piece", "weights", "met"],
            )

    return of_batches


def _apply(model: Model, rows: list) -> Model:
    tables = [model.classes.copy(), model.slots.copy(), model.tree.copy()]
    for row in rows:
        table = tables[row["piece"] // PIECES]
        own = np.array_split(np.arange(len(table)), PIECES)[row["piece"] % PIECES]
        met = np.frombuffer(row["met"], "<f4")
        change = np.frombuffer(row["weights"], "<f4").reshape(len(own), -1)
        table[own] += change / np.maximum(met, 1)[:, None]
    return model._replace(classes=tables[0], slots=tables[1], tree=tables[2])


def count_words(train: DataFrame, text: str = "text") -> DataFrame:
    """How often each word and the end of text occurs in the training documents, over all of them; saved in the shared folder."""
    spark = train.sparkSession
    ship(spark)
    path = scratch_path(spark, "word-counts")
    counted = train.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(_count_words, COUNTED)
    counted.groupBy("word").agg(F.sum("n").alias("n")).write.parquet(path)
    return spark.read.schema(COUNTED).parquet(path)


def frequent(counts: DataFrame, limit: int = HOT_WORDS) -> list[tuple[str, int]]:
    """The words above the lowest count that at most ``limit`` words reach, most frequent first.

    The count is found on a histogram in steps of five percent, so only the
    words themselves, whose number is bounded, reach the driver.
    """
    step = F.floor(F.log("n") * 20).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    lowest, reached = None, 0
    for value, size in sizes:
        reached += size
        if reached > limit:
            break
        lowest = value
    if lowest is None:
        return []
    found = counts.filter(step >= lowest).toArrow()
    return sorted(zip(found["word"].to_pylist(), found["n"].to_pylist()), key=lambda x: (-x[1], x[0]))


def fit(train: DataFrame, counts: DataFrame, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS) -> Model:
    """Train on all documents of ``train``, each in one round; ``counts`` are their word counts.

    What reaches the driver is bounded by parameters: the most frequent words,
    sizes of leaves, and the changes of the weights.
    """
    total, distinct, once = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum((F.col("n") == 1).cast("long")), F.lit(0))
    ).first()
    top = frequent(counts)
    ends = [r["n"] for r in counts.filter(F.col("word") == END).collect()]
    head = [w for w, _ in top if w != END][: HEAD_CLASSES * SLOTS - 1]
    head.insert(0, END)
    count_of = dict(top) | ({END: ends[0]} if ends else {})
    depth = depth_for(distinct)
    leaves = counts.mapInArrow(_tail_sizes(head, depth), "leaf long, size double").groupBy("leaf").agg(F.sum("size").alias("size")).toArrow()
    leaf_sizes = np.zeros(TAIL_CLASSES * SLOTS**depth)
    leaf_sizes[leaves["leaf"].to_numpy()] = leaves["size"].to_numpy()
    slot_size = np.full(HEAD_CLASSES * SLOTS, 1e-9)
    slot_size[: len(head)] = [count_of.get(w, 0) + 0.1 for w in head]
    slot_size = slot_size.reshape(HEAD_CLASSES, SLOTS)
    tail_size = np.append(np.zeros(HEAD_CLASSES), leaf_sizes.reshape(TAIL_CLASSES, -1).sum(axis=1))
    class_size = tail_size + np.append(slot_size.sum(axis=1), np.zeros(TAIL_CLASSES))
    with np.errstate(divide="ignore"):
        class_bias = np.maximum(np.log(class_size / max(class_size.sum(), 1e-9)), -40)
    biases = tree_biases(leaf_sizes, depth)
    known = [(w, n) for w, n in top if w != END]
    model = Model(
        total, distinct, ends[0] if ends else 0, (once + 1) / (total + 2) if total else 1.0, head,
        pa.array([w for w, _ in known], pa.string()), np.array([n for _, n in known], np.float64),
        class_bias.astype(np.float32), np.log(slot_size / slot_size.sum(axis=1, keepdims=True)).astype(np.float32), np.maximum(tail_size, 1e-9),
        np.zeros((3 * rows_for(total, BUCKETS, 1 << 15), CLASSES), np.float32),
        np.zeros((2 * rows_for(total, SLOT_BUCKETS, 1 << 17) * HEAD_CLASSES, SLOTS), np.float32),
        np.zeros((2 * rows_for(total, TREE_BUCKETS, 1 << 12), SLOTS), np.float32),
        biases, [(b > EMPTY).sum(axis=1) > 1 for b in biases],
    )
    for k in range(rounds if total else 0):
        own = train.filter(F.pmod(F.xxhash64(F.lit(5), doc_id), F.lit(rounds)) == k)
        changes = (
            own.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(_train_round(model), CHANGES)
            # First among some tasks, then among the sums, so that no task reads the changes of all.
            .withColumn("tasks", F.floor(F.spark_partition_id() / SUMMED_TASKS)).repartition("piece", "tasks").drop("tasks")
            .mapInArrow(_sum_changes(True), CHANGES)
            .repartition(PIECES, "piece").mapInArrow(_sum_changes(False), CHANGES)
        )
        model = _apply(model, changes.collect())
    return model


def _scorer(model: Model):
    """Rows of the word ``\\t`` and the row number for a document as a whole, and of each of its rare words.

    The former carry what frequent words add; the latter, which are most, wait for the count of the word.
    """
    ln10, seen, end_count = math.log(10), math.log10(max(1 - model.unseen, 1e-300)), float(model.ends)
    names = [c.split()[0] for c in SCORED.split(", ")[:5]]
    fields = [("doc_id", pa.int64()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64())]
    whole = lambda v: pa.array(np.asarray(v).astype(np.int64))
    real = lambda v: pa.array(np.asarray(v).astype(np.float64))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raised = raised_tables(model)
        for batch in batches:
            row_of, doc_of = batch.column(0).to_numpy(), batch.column(1)
            before = 0
            for block in text_blocks(batch.column(2), BLOCK_BYTES):
                found = words(block, lower=True)
                tokens, (of_class, slot) = read_tokens(found), model.places(found.vocab)
                got = log_probabilities(model, tokens, of_class, slot, raised) / ln10 + seen
                hot = pc.index_in(found.vocab, value_set=model.hot).fill_null(-1).to_numpy(zero_copy_only=False)
                hot = np.append(hot, -1)
                count = np.where(hot >= 0, model.hot_counts[hot] if len(model.hot_counts) else 0.0, 0.0)
                count[-1] = end_count
                # Every frequent word is also a hot one; the end of text is known if there was any training document.
                sure = hot >= 0
                sure[-1] = end_count > 0
                got -= np.where(slot < 0, np.log10(model.tail_size[of_class]), 0.0)[tokens.codes]
                log_count = np.log10(count + 0.1)
                text_of = np.repeat(np.arange(len(block)), np.diff(tokens.starts))
                fixed = sure[tokens.codes]
                sum_of = got + np.where(slot < 0, log_count, 0.0)[tokens.codes]
                add = lambda v: np.bincount(text_of[fixed], v[fixed], minlength=len(block))
                score, base, known = add(sum_of), add(log_count[tokens.codes]), add(np.ones(len(sum_of)))
                owner = row_of[before : before + len(block)]
                about = [doc_of.slice(before, len(block)), whole(np.diff(tokens.starts)), whole(known), real(base)]
                yield pa.RecordBatch.from_arrays(
                    [whole(owner), pa.array([f"\t{r}" for r in owner.tolist()], pa.string()), whole(np.zeros(len(block))), real(score),
                     pa.StructArray.from_arrays(about, fields=[pa.field(*f) for f in fields])], names,
                )
                rare = np.flatnonzero(~fixed)
                pair, where = np.unique(text_of[rare] * (len(found.vocab) + 1) + tokens.codes[rare], return_inverse=True)
                if len(pair):
                    text, code = pair // (len(found.vocab) + 1), pair % (len(found.vocab) + 1)
                    word = pa.concat_arrays([found.vocab, pa.array([END], pa.string())]).take(pa.array(code))
                    yield pa.RecordBatch.from_arrays(
                        [whole(owner[text]), word, whole(np.bincount(where)), real(np.bincount(where, got[rare])),
                         pa.nulls(len(pair), pa.struct(fields))], names,
                    )
                before += len(block)

    return of_batches


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document row: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    A null text counts as empty: one token, the end. Rows that share an id or
    text are scored each for itself. An empty table gives an empty result;
    without training documents every token is unknown and both scores are zero.
    """
    ship(docs.sparkSession)
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    parts = numbered.mapInArrow(_scorer(model), SCORED).join(counts.select("word", F.col("n").alias("c")), "word", "left")
    log_count = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    rare, seen = F.col("n") > 0, F.col("c").isNotNull()
    value = F.when(~rare, F.col("s")).when(seen, F.col("s") + F.col("n") * log_count).otherwise(F.col("n") * F.lit(math.log10(model.unseen)))
    totals = parts.groupBy("row").agg(
        F.max("whole.doc_id").alias("doc_id"),
        F.sum("whole.tokens").alias("n_tokens"),
        F.sum(F.when(~rare, F.col("whole.known")).when(seen, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.when(~rare, F.col("whole.base")).otherwise(F.col("n") * log_count)).alias("base"),
        F.sum(value).alias("score"),
    )
    norm = math.log10(model.total + 0.1 * (model.distinct + 1))
    return totals.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * norm).alias("base_score"), "score",
    )
