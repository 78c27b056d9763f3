"""Benchmark passages inside documents, found by CGK embedding and bit sampling.

Words are compared without case and surrounding marks. An item occurs in a
document where some run of words is within ``1 - similarity`` of the item's
words in edit distance (insertions, deletions and substitutions of words).

The CGK random walk maps a window of words to a longer string in which edit
distance becomes Hamming distance: at step ``j`` the walk writes down its word
and goes on to the next one if a random bit of ``j`` and that word says so. Two
sequences with few edits fall into step again soon. The walk of every window
starts at another word but uses the same bits, so all windows walk at once. Bit
sampling then takes a few steps of the walk as a key; each of several
independent walks gives every item and every window one key. Windows sharing a
key with an item are verified by exact edit distance.

Before the walks a lossless test leaves out most windows: ``d`` edits spoil at most
``q * d`` of the ``n - q + 1`` runs of ``q`` words of an item, so only windows that
hold at least the other ``n - q + 1 - q * d`` runs of some item need to walk.

Walks fall out of step in long items with many edits, so the number of walks of a band
follows from its items' allowed edits and a target recall. To leave nothing to chance
the runs are also counted for each item by itself: places where enough runs of three words of one item lie close
together are verified too. For items that share at least two such runs with every
occurrence (seven words or more, and four) this loses nothing; items of five or six
words rest on the walks, shorter ones must occur unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import hash_words, mix, ship, text_blocks, words

SIMILARITY = 0.8
#: The chance with which walks alone are to find an occurrence with all allowed edits, and the fewest walks.
TARGET_RECALL = 0.99
WALKS = 24
SAMPLES = 3
BAND = 1.4
BLOCK_CHARS = 32 << 20
FILTER_BITS = 22
PIECE_BYTES = 6 << 20
COUNTED_RUN = 3
COUNTED_LEAST = 2
COUNTED_HITS = 1 << 21
#: Fixed value: marks that do not count at either end of a word.
MARKS = ".,;:!?*$&%#|\"'()[]{}<>«»“”‘’…-–—_=+~^/\\`@¿¡"
FOUND = "item_id long, first_word long, n_words long, edits int"


def edits_allowed(n: int, similarity: float) -> int:
    """Edits that an item of ``n`` words may show; below five words none."""
    return 0 if n < 5 else int(math.floor((1 - similarity) * n + 1e-9))


def sure_runs(n: int, similarity: float) -> tuple[int, int]:
    """The longest run length ``q`` up to three, and how many runs of ``q`` words any occurrence shares with the item."""
    d = edits_allowed(n, similarity)
    return max((q, n - q + 1 - q * d) for q in (1, 2, 3) if n - q + 1 - q * d > 0)


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words without case and marks, the first word of each text, and each word's place among all words."""
    found = words(pc.utf8_lower(texts))
    bare = pc.utf8_trim(found.vocab, MARKS)
    hashes, empty = hash_words(bare, 9), pc.equal(pc.binary_length(bare), 0).to_numpy(zero_copy_only=False)
    place = np.arange(len(found.codes)) - np.repeat(found.starts[:-1], np.diff(found.starts))
    starts, symbols = found.starts, hashes[found.codes]
    if empty.any():
        keep = ~empty[found.codes]
        starts = np.concatenate([[0], np.cumsum(keep)])[starts]
        symbols, place = symbols[keep], place[keep]
    return symbols, starts, place


def _runs(symbols: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, at its first word."""
    n = max(len(symbols) - size + 1, 0)
    code = np.full(n, size, np.uint64)
    for k in range(size):
        code = mix(code ^ symbols[k : k + n])
    return code


def last_row_edits(item: list[int], window: list[int]) -> list[int]:
    """Edits between the item and the best run ending at each word of the window (bit-parallel)."""
    n, places = len(item), {}
    for k, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << k
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, scores = full, 0, n, []
    for word in window:
        equal = places.get(word, 0)
        across = ((((equal & up) + up) ^ up) | equal) & full
        plus = (down | ~(across | up)) & full
        minus = up & across
        score += bool(plus & top) - bool(minus & top)
        scores.append(score)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        side = equal | down
        up = (minus | ~(side | plus)) & full
        down = plus & side
    return scores


class Band(NamedTuple):
    """Items of similar length: their filter of runs, the samples of each walk, and their sorted keys per walk."""

    run: int
    seen: np.ndarray
    needed: int
    reach: int
    steps: list[np.ndarray]
    keys: list[np.ndarray]
    owners: list[np.ndarray]


def walks_for(edits: int, recall: float = TARGET_RECALL) -> int:
    """Walks with which an occurrence with that many edits shares a key with that chance.

    One walk of ``SAMPLES`` samples meets with a chance that falls by the same factor
    with each edit; 0.17 and 0.027 are fitted to trials with edits spread evenly, the
    hardest case, in items of 100 to 400 words.
    """
    met = 0.17 * math.exp(-0.027 * edits)
    return max(WALKS, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _samples(shortest: int, seed: int, walks: int) -> list[np.ndarray]:
    """The sampled steps of each walk of a band.

    Walks sample ever later parts in turn, so edits that crowd in one part leave others alone.
    """
    rng, steps = np.random.default_rng(seed), []
    for walk in range(walks):
        share = (walk % 4) / 4
        low = int(share * 1.5 * shortest)
        high = max(low + SAMPLES, int((share + 0.4) * 1.5 * shortest))
        steps.append(np.sort(rng.choice(np.arange(low, high), SAMPLES, replace=False)))
    return steps


def _walk_keys(padded: np.ndarray, begin: np.ndarray, stop: np.ndarray, walk: int, steps: np.ndarray) -> np.ndarray:
    """The key of each starting place: the words that one walk writes down at the sampled steps.

    ``padded`` holds the words and one more entry; beyond ``stop`` a walk writes zeros.
    """
    keys, wanted = np.full(len(begin), 1 + walk, np.uint64), set(steps.tolist())
    at = begin.copy()
    for step in range(int(steps[-1]) + 1):
        here = np.where(at < stop, padded[np.minimum(at, stop)], np.uint64(0))
        if step in wanted:
            keys = mix(keys ^ here)
        bits = mix(here ^ np.uint64(walk * 1_000_003 + step + 17))
        at += (bits & np.uint64(1)).astype(np.int64)
    return keys


class Counted(NamedTuple):
    """The distinct runs of each counted item: sorted codes with their items; per item the runs needed and an occurrence's most words."""

    codes: np.ndarray
    owners: np.ndarray
    needed: np.ndarray
    reach: np.ndarray


class Items(NamedTuple):
    """A block of benchmark items ready to be searched for."""

    ids: list
    symbols: list[np.ndarray]
    allowed: np.ndarray
    bands: list[Band]
    counted: Counted


def _band(own: np.ndarray, each: list[np.ndarray], similarity: float, seed: int) -> Band:
    """The band of some items: ``own`` are their numbers among ``each``."""
    symbols = [each[k] for k in own.tolist()]
    lengths = np.array([len(s) for s in symbols])
    sure = [sure_runs(n, similarity) for n in lengths.tolist()]
    run = min(q for q, _ in sure)
    spare = [n - run + 1 - run * edits_allowed(n, similarity) for n in lengths.tolist()]
    seen = np.zeros(1 << FILTER_BITS, bool)
    for s in symbols:
        seen[_runs(s, run) >> np.uint64(64 - FILTER_BITS)] = True
    walks = walks_for(max(edits_allowed(n, similarity) for n in lengths.tolist()))
    steps = _samples(int(lengths.min()), seed, walks)
    joined, begin = np.append(np.concatenate(symbols), np.uint64(0)), np.cumsum(lengths) - lengths
    keys, owners = [], []
    for walk in range(walks):
        key = _walk_keys(joined, begin, begin + lengths, walk, steps[walk])
        order = np.argsort(key, kind="stable")
        keys.append(key[order])
        owners.append(own[order])
    reach = max(n + edits_allowed(n, similarity) for n in lengths.tolist())
    return Band(run, seen, min(spare), reach, steps, keys, owners)


def index(ids: list, texts: list[str | None], similarity: float) -> Items:
    """Keys and shared runs of the items; items without words are left out as they can occur nowhere."""
    symbols, starts, _ = plain_words(pa.array([t or "" for t in texts], pa.string()))
    each = [symbols[a:b] for a, b in zip(starts[:-1], starts[1:])]
    kept = [k for k, s in enumerate(each) if len(s)]
    ids, each = [ids[k] for k in kept], [each[k] for k in kept]
    lengths = np.array([len(s) for s in each], np.int64)
    allowed = np.array([edits_allowed(n, similarity) for n in lengths.tolist()], np.int64)
    bands, left = [], np.argsort(lengths, kind="stable")
    while len(left):
        shortest = lengths[left[0]]
        # Items of fewer words than a band's runs need stay apart from longer ones.
        inside = (lengths[left] <= shortest * BAND) & ((lengths[left] < 6) == (shortest < 6))
        bands.append(_band(left[inside], each, similarity, seed=int(shortest)))
        left = left[~inside]
    return Items(ids, each, allowed, bands, _counted(each, allowed))


def _counted(each: list[np.ndarray], allowed: np.ndarray) -> Counted:
    lengths = np.array([len(s) for s in each], np.int64)
    needed = lengths - COUNTED_RUN + 1 - COUNTED_RUN * allowed
    codes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k in np.flatnonzero(needed >= COUNTED_LEAST).tolist():
        codes.append(np.unique(_runs(each[k], COUNTED_RUN)))
        owners.append(np.full(len(codes[-1]), k))
    code, owner = np.concatenate(codes), np.concatenate(owners)
    order = np.argsort(code, kind="stable")
    return Counted(code[order], owner[order], needed, lengths + allowed)


def _dense_places(symbols: np.ndarray, text_of: np.ndarray, starts: np.ndarray, counted: Counted) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of words (text, item, first, end) that hold all occurrences of the counted items, ascending for a text and item."""
    if not len(counted.codes):
        return
    code = _runs(symbols, COUNTED_RUN)
    low = np.searchsorted(counted.codes, code)
    at = np.flatnonzero(counted.codes[np.minimum(low, len(counted.codes) - 1)] == code)
    # Runs across the border of two texts belong to none.
    at = at[text_of[at] == text_of[at + COUNTED_RUN - 1]]
    low = low[at]
    n = np.searchsorted(counted.codes, code[at], side="right") - low
    # Whole texts at a time, so that runs shared by many items do not take much memory at once.
    upto, first = np.cumsum(n), 0
    while first < len(at):
        last = max(int(np.searchsorted(upto, (upto[first - 1] if first else 0) + COUNTED_HITS, side="right")), first + 1)
        last = int(np.searchsorted(text_of[at], text_of[at[last - 1]], side="right"))
        m = n[first:last]
        item = counted.owners[np.repeat(low[first:last] - np.cumsum(m) + m, m) + np.arange(m.sum())]
        place = np.repeat(at[first:last], m)
        order = np.lexsort((place, item))
        item, place = item[order], place[order]
        text, needed, reach = text_of[place], counted.needed[item], counted.reach[item]
        end = np.arange(len(item)) + needed - 1
        inside = np.minimum(end, len(item) - 1)
        near = (end < len(item)) & (item[inside] == item) & (text[inside] == text) & (place[inside] + COUNTED_RUN - place <= reach)
        item, text, reach = item[near], text[near], reach[near]
        begin = np.maximum(place[inside][near] + COUNTED_RUN - reach, starts[text])
        stop = np.minimum(place[near] + reach, starts[text + 1])
        if len(item):
            # Overlapping ranges of one item become one.
            apart = np.flatnonzero((item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (begin[1:] > stop[:-1])) + 1
            heads = np.concatenate([[0], apart])
            tails = np.append(apart, len(item)) - 1
            yield from zip(*(a.tolist() for a in (text[heads], item[heads], begin[heads], stop[tails])))
        first = last


def _candidates(symbols: np.ndarray, text_of: np.ndarray, starts: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a window's first word and an item that share a key."""
    first, item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    codes = {run: _runs(symbols, run) >> np.uint64(64 - FILTER_BITS) for run in {band.run for band in items.bands}}
    padded = np.append(symbols, np.uint64(0))
    for band in items.bands:
        hit = band.seen[codes[band.run]]
        if not hit.any():
            continue
        before = np.concatenate([[0], np.cumsum(hit), np.full(band.run, hit.sum())])[: len(symbols) + 1]
        hits = np.flatnonzero(hit)
        # Only places up to a window's length before some hit can hold any.
        near = np.zeros(len(symbols) + 1, np.int32)
        np.add.at(near, np.maximum(hits - band.reach, 0), 1)
        np.add.at(near, hits + 1, -1)
        begin = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        stop = starts[1:][text_of[begin]]
        enough = before[np.minimum(begin + band.reach, stop)] - before[begin] >= band.needed
        begin, stop = begin[enough], stop[enough]
        for walk in range(len(band.steps) if len(begin) else 0):
            key, known = _walk_keys(padded, begin, stop, walk, band.steps[walk]), band.keys[walk]
            low = np.searchsorted(known, key)
            met = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == key)
            if len(met):
                low, high = low[met], np.searchsorted(known, key[met], side="right")
                n = high - low
                first.append(np.repeat(begin[met], n))
                item.append(band.owners[walk][np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())])
    pairs = np.unique(np.concatenate(first) * (len(items.ids) + 1) + np.concatenate(item))
    return pairs // (len(items.ids) + 1), pairs % (len(items.ids) + 1)


def occurrences(texts: pa.Array, items: Items, complete: bool = True) -> list[list[tuple]]:
    """For each text its items as (item id, first word, words, edits): the closest, then the first place of each item.

    Without ``complete`` only the walks search. ``first_word`` and ``words`` count white-space separated words of the text.
    """
    results: list[list[tuple]] = []
    for block in text_blocks(texts, PIECE_BYTES):
        symbols, starts, place = plain_words(block)
        text_of = np.repeat(np.arange(len(block)), np.diff(starts))
        found: list[dict[int, tuple]] = [{} for _ in range(len(block))]
        if len(items.ids) and len(symbols):
            def verify(text: int, k: int, low: int, high: int) -> None:
                own, allowed = items.symbols[k].tolist(), int(items.allowed[k])
                window = symbols[low:high].tolist()
                scores = last_row_edits(own, window)
                least = min(scores)
                if least > allowed:
                    return
                last = scores.index(least)
                # The same search backwards from the last word gives the first word.
                back = last_row_edits(own[::-1], window[: last + 1][::-1])
                begin = low + last - back.index(least)
                hit = (least, int(place[begin]), int(place[low + last] - place[begin] + 1))
                found[text][k] = min(found[text].get(k, hit), hit)

            seen: dict[tuple[int, int], int] = {}
            for first, k in zip(*(a.tolist() for a in _candidates(symbols, text_of, starts, items))):
                text = int(text_of[first])
                if seen.get((text, k), -1) > first or found[text].get(k, (1,))[0] == 0:
                    continue
                own, allowed = len(items.symbols[k]), int(items.allowed[k])
                # Windows that begin inside this one, up to a few words, would be verified on the same words.
                seen[text, k] = first + max(1, allowed // 2)
                verify(text, k, max(int(starts[text]), first - allowed - 2), min(int(starts[text + 1]), first + own + 2 * allowed + 2))
            # What the walks missed, or found at a place farther from the item.
            for text, k, low, high in _dense_places(symbols, text_of, starts, items.counted) if complete else ():
                if found[text].get(k, (1,))[0] > 0:
                    verify(text, k, low, high)
        results += [sorted((items.ids[k], at, n, e) for k, (e, at, n) in f.items()) for f in found]
    return results


def item_blocks(benchmark: DataFrame, similarity: float, text: str, item_id: str) -> Iterator[Items]:
    """The benchmark in blocks of about ``BLOCK_CHARS`` characters, each indexed and sent to the tasks.

    The blocks bound what a task holds; a benchmark of any size is searched block after block.
    """
    rows = benchmark.select(F.col(item_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    for k in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else rows
        got = sorted(own.distinct().collect(), key=lambda r: (r["id"] is not None, r["id"], r["text"]))
        yield index([r["id"] for r in got], [r["text"] for r in got], similarity)


def found_column(items: Items, text: str | Column, complete: bool = True) -> Column:
    """The items that occur in a text column, as an array of (item_id, first_word, n_words, edits)."""

    @F.arrow_udf(f"array<struct<{', '.join(':'.join(c.split()) for c in FOUND.split(', '))}>>")
    def of_texts(texts: pa.Array) -> pa.Array:
        rows = occurrences(texts, items, complete)
        kinds = (("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32()))
        flat = [hit for row in rows for hit in row]
        columns = [pa.array([hit[c] for hit in flat], kind) for c, (_, kind) in enumerate(kinds)]
        at = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
        return pa.ListArray.from_arrays(at, pa.StructArray.from_arrays(columns, [n for n, _ in kinds]))

    return of_texts(text)


def contaminations(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
    complete: bool = True,
) -> DataFrame:
    """One row per document row and item that occurs in it: ``doc_id``, ``item_id``, ``first_word``, ``n_words``, ``edits``.

    Null texts count as empty and match nothing, as do items without words;
    items below five words must occur unchanged. Ids may be null or repeat;
    equal items under one id count once. Empty tables give an empty result.
    ``complete`` also counts runs, which finds what the walks may miss.
    """
    ship(docs.sparkSession)
    parts = None
    for items in item_blocks(benchmark, similarity, text="text" if text not in benchmark.columns else text, item_id=item_id):
        hits = docs.select(F.col(doc_id).cast("long").alias("doc_id"), found_column(items, F.col(text), complete).alias("found"))
        hits = hits.select("doc_id", F.inline("found"))
        parts = hits if parts is None else parts.union(hits)
    return parts


def keep_clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents in which no item occurs, with all their columns."""
    ship(docs.sparkSession)
    for items in item_blocks(benchmark, similarity, "text", item_id):
        docs = docs.filter(F.size(found_column(items, F.col(text))) == 0)
    return docs
