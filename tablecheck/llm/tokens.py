"""Token ids of whole texts with a public tokenizer, encoded once per distinct piece.

Both kinds of pre-tokenization used here never let a token cross a single space
between two other characters, so a text may be cut there, its distinct pieces
encoded by the tokenizer, and their ids strung together again: the result
equals that of the whole text. The same holds between a letter and a mark other
than an apostrophe. Pieces of plain letters and marks are cut further into their
pre-tokens; all others go to the tokenizer as they are.
"""

from __future__ import annotations

import os
import re
from itertools import chain, compress, islice, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .batches import encode, text_blocks, words

CACHE = 150_000
BLOCK_BYTES = 16 << 20
STEP = 20_000
JOINED = 256

#: Any character that some engine may take for white space.
_SPACE = "\t-\r\x1c-\x20\x85\xa0 ᠎ -​    　﻿"
_LOOSE = re.compile(f"(?<![^{_SPACE}]) | (?![^{_SPACE}])")
_RE2_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{180e}\x{200b}\x{feff}\pZ]"
_RE2_LOOSE = f"^ | $|{_RE2_SPACE} | {_RE2_SPACE}"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r".,;:!?*$&%#|()\"-"
_PLAIN = re.compile(rf" ?[{_LETTERS}]+|[{_MARKS}]+|\n")

_LOADED: dict[tuple[str, bool], "Encoder"] = {}


class Ids(NamedTuple):
    """All ids of a block, the end id of each text included, and where each text starts."""

    ids: np.ndarray
    starts: np.ndarray


class Encoder:
    """A tokenizer with the ids of the pieces that came first.

    ``spaced`` tells whether a word's token takes the space before it (byte-level
    vocabularies); otherwise white space only separates words and case is folded.
    """

    def __init__(self, path: str, spaced: bool, cache: int = CACHE):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Their strings inside a text are ordinary text, as the vocabularies' own notes have it: a document must
        # not be able to write a control token.
        self.tokenizer.encode_special_tokens = True
        self.spaced = spaced
        self.cache = cache
        # Units (pieces or their pre-tokens) by number, and the ids of each behind one another.
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units behind one another, and the number of each."""
        if not self.spaced:
            return self._alone(units)
        # A space and letters are one pre-token wherever they stand, so many go to the tokenizer as one text.
        plain = np.fromiter((u[:1] == " " and u[1:].isalpha() for u in units), bool, len(units))
        where, odd = np.flatnonzero(plain), np.flatnonzero(~plain)
        words = list(compress(units, plain.tolist()))
        flat, sizes = self._joined(words)
        ids, rest = self._alone([units[k] for k in odd.tolist()])
        size = np.zeros(len(units), np.int64)
        size[where], size[odd] = sizes, rest
        of_plain = np.repeat(plain, size)
        out = np.empty(len(of_plain), np.uint32)
        out[of_plain], out[~of_plain] = flat, ids
        return out, size

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_alone``, of words that each begin with a space; the fast way does not tell which word an id belongs to."""
        groups = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first in range(0, len(groups), STEP // JOINED):
            some = groups[first : first + STEP // JOINED]
            for group, found in zip(some, self.tokenizer.encode_batch(list(map("".join, some)), add_special_tokens=False)):
                ids, size = np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(group))
                # A letter that the tokenizer does not know as one would cut its word in two.
                if len(size) != len(group):
                    ids, size = self._alone(group)
                flat.append(ids)
                sizes.append(size)
        return np.concatenate(flat), np.concatenate(sizes)

    def _alone(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first in range(0, len(units), STEP):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(units[first : first + STEP], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            flat.append(np.fromiter(chain.from_iterable(got), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(flat), np.concatenate(sizes)

    def _parts(self, piece: str) -> list[str]:
        # How a run of line breaks is cut depends on what follows it.
        parts = [] if "\n\n" in piece else _PLAIN.findall(piece)
        return parts if "".join(parts) == piece and not piece[-1:].isspace() else [piece]

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces behind one another, and where each piece's begin."""
        found = list(map(self.known.get, pieces, repeat(-1)))
        fresh: dict[str, int] = {}
        base, units, parts_of = len(self.known), [], np.ones(len(pieces), np.int64)
        number = lambda unit: fresh.setdefault(unit, base + len(fresh))
        for k, unit in enumerate(found):
            if unit >= 0:
                units.append(unit)
                continue
            piece = pieces[k]
            # A single word is a pre-token of its own; most pieces are.
            if piece[1:].isalpha():
                units.append(number(piece))
                continue
            parts = self._parts(piece)
            parts_of[k] = len(parts)
            for part in parts:
                unit = self.known.get(part, -1)
                units.append(unit if unit >= 0 else number(part))
        ids, sizes = self._encode(list(fresh))
        flat = np.concatenate([self.flat, ids])
        starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        units = np.array(units, np.int64)
        each = starts[units + 1] - starts[units]
        ends = np.cumsum(each)
        out = flat[np.repeat(starts[units] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        piece_ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(parts_of)])]
        room = self.cache - base
        if room > 0 and fresh:
            kept = min(room, len(fresh))
            self.known.update(islice(fresh.items(), kept))
            self.starts = starts[: base + kept + 1]
            self.flat = flat[: self.starts[-1]]
        return out, piece_ends

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Piece codes, the first piece of each text, and the pieces."""
        if not self.spaced:
            found = words(texts, lower=True)
            return found.codes, found.starts, found.vocab.to_pylist()
        loose = pc.match_substring_regex(texts, _RE2_LOOSE)
        # Marks for a cut and for loose spaces; neither may occur in a text of the block.
        free = (c for c in map(chr, range(0xE000, 0xF8FF)) if not pc.any(pc.match_substring(texts, c)).as_py())
        cut, mark = next(free), ""
        if pc.any(loose).as_py():
            rows, odd, mark = texts.to_pylist(), loose.to_pylist(), next(free)
            texts = pa.array([_LOOSE.sub(mark, t) if o else t for t, o in zip(rows, odd)], pa.string())
        # A piece keeps the space before it; a word and the marks behind it are pieces of their own.
        texts = pc.replace_substring(texts, " ", cut + " ")
        texts = pc.replace_substring_regex(texts, f"([{_LETTERS}])([{_MARKS}])", f"\\1{cut}\\2")
        lists = pc.split_pattern(texts, cut)
        offsets = lists.offsets.to_numpy()
        codes, starts, vocab = encode(lists.flatten(), offsets - offsets[0])
        plain = vocab.to_pylist()
        return codes, starts, [p.replace(mark, " ") for p in plain] if mark else plain

    def block(self, texts: pa.Array, end: int = 0) -> Ids:
        """Ids of all texts of a block, each followed by ``end``."""
        codes, starts, vocab = self._split(texts)
        flat, place = self.pieces(vocab)
        flat = np.append(flat, np.uint32(end))
        size = np.append(np.diff(place), 1)
        codes = np.insert(codes.astype(np.int64), starts[1:], len(vocab))
        starts = starts + np.arange(len(starts))
        each = size[codes]
        at = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(place[codes] - at[:-1], each) + np.arange(at[-1])]
        return Ids(ids, at[starts])


def encoder(path: str, spaced: bool, cache: int = CACHE) -> Encoder:
    """The encoder of this Python worker, which keeps the ids of at most ``cache`` pieces."""
    if (path, spaced) not in _LOADED:
        _LOADED[path, spaced] = Encoder(path, spaced, cache)
    return _LOADED[path, spaced]


def encoded(texts: pa.Array, path: str, spaced: bool, end: int = 0, block_bytes: int = BLOCK_BYTES, cache: int = CACHE):
    """For each block of the texts: its ids and how many texts came before it."""
    before = 0
    for block in text_blocks(texts, block_bytes):
        yield before, encoder(path, spaced, cache).block(block, end)
        before += len(block)
