"""Language identification by averaged hashed sub-word embeddings and a linear softmax.

A word is the mean of the embeddings of its hashed byte n-grams and of itself, a
text the mean of its words. Embeddings and the softmax are trained together by
stochastic gradient descent in numpy on a bounded labelled sample. As everything
is linear up to the softmax, the trained embeddings times the softmax weights
make one table of scores per n-gram, which is all that scoring needs. A
temperature fitted on held-back rows calibrates the scores, and a text whose
score is below the calibrated threshold is rejected.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import Words, bytes_of, hash_words, ship, sum_runs, text_blocks, words
from .sampling import bounded

SAMPLE = 500
BUCKET_BITS = 15
DIMENSION = 10
SIZES = (2, 3, 4)
EPOCHS = 12
KEEP = 0.998
UNKNOWN = "und"
VOCAB_STEP = 60_000


def ngram_buckets(vocab: pa.Array, bits: int = BUCKET_BITS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each n-gram size the bucket at each place of the framed words (``2**bits`` where none starts),
    where each framed word starts, and the bucket of each whole word."""
    raw, at = bytes_of(vocab)
    n = len(at) - 1
    starts = at + 2 * np.arange(n + 1)
    framed = np.zeros(int(starts[-1]) + max(SIZES), np.uint32)
    framed[np.arange(len(raw)) + 2 * np.repeat(np.arange(n), np.diff(at)) + 1] = raw
    framed[starts[:-1]], framed[starts[1:] - 1] = 60, 62
    places = np.arange(int(starts[-1]))
    room = np.repeat(starts[1:], np.diff(starts)) - places
    found = []
    with np.errstate(over="ignore"):
        for size in SIZES:
            code = np.full(len(places), size, np.uint32) * np.uint32(0x85EBCA6B)
            for k in range(size):
                code = (code ^ framed[k : k + len(places)]) * np.uint32(0x01000193)
            bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)
            found.append(np.where(room >= size, bucket, 1 << bits))
    return found, starts, (hash_words(vocab, 5) >> np.uint64(64 - bits)).astype(np.int64)


def word_scores(vocab: pa.Array, table: np.ndarray, bits: int = BUCKET_BITS) -> np.ndarray:
    """The mean of the table's rows over the n-grams of each word and the word itself."""
    scores = []
    for first in range(0, len(vocab), VOCAB_STEP):
        grams, starts, whole = ngram_buckets(vocab.slice(first, VOCAB_STEP), bits)
        total, count = table[whole].copy(), np.ones(len(whole))
        for bucket in grams:
            total += sum_runs(table[bucket], starts)
            count += sum_runs((bucket < 1 << bits).astype(np.int32), starts)
        scores.append(total / count[:, None].astype(np.float32))
    return np.concatenate(scores) if scores else np.zeros((0, table.shape[1]), np.float32)


def bags(found: Words, bits: int = BUCKET_BITS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Buckets of each text with their weights, which add up to one."""
    grams, starts, whole = ngram_buckets(found.vocab, bits)
    word_of = np.repeat(np.arange(len(whole)), np.diff(starts))
    buckets, owner = [whole], [np.arange(len(whole))]
    for bucket in grams:
        real = bucket < 1 << bits
        buckets.append(bucket[real])
        owner.append(word_of[real])
    buckets, owner = np.concatenate(buckets), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    buckets, per_word = buckets[order], np.bincount(owner, minlength=len(whole))
    first = np.concatenate([[0], np.cumsum(per_word)])
    kept, weights = [], []
    for text in range(len(found.starts) - 1):
        codes, n = np.unique(found.codes[found.starts[text] : found.starts[text + 1]], return_counts=True)
        if not len(codes):
            kept.append(np.zeros(0, np.int64))
            weights.append(np.zeros(0, np.float32))
            continue
        sizes = per_word[codes]
        places = np.arange(sizes.sum()) + np.repeat(first[codes] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        each = np.bincount(buckets[places], np.repeat(n / sizes, sizes), minlength=1 << bits)
        some = np.flatnonzero(each)
        kept.append(some)
        weights.append((each[some] / each.sum()).astype(np.float32))
    return kept, weights


class Model(NamedTuple):
    """Languages, the table of scores per bucket (last row zero), the bias, the temperature and the threshold."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and calibrated score of each text; ``und`` and zero where it has no letter."""
        names, scores = [], []
        for block in text_blocks(texts):
            letters = pc.match_substring_regex(block, r"\pL").to_numpy(zero_copy_only=False)
            if not self.langs:
                names += [UNKNOWN] * len(block)
                scores.append(np.zeros(len(block)))
                continue
            found = words(block, lower=True)
            total = sum_runs(word_scores(found.vocab, self.table)[found.codes], found.starts)
            p = self.probabilities(total / np.maximum(np.diff(found.starts), 1)[:, None])
            best = p.argmax(axis=1)
            names += [self.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist())]
            scores.append(np.where(letters, p[np.arange(len(p)), best], 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def train(
    buckets: list[np.ndarray], weights: list[np.ndarray], label: np.ndarray, langs: list[str], held: np.ndarray, seed: int = 3
) -> Model:
    """Embeddings and softmax by stochastic gradient descent on the rows not held back; the rest calibrate."""
    size, rng = 1 << BUCKET_BITS, np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (size, DIMENSION)).astype(np.float32)
    softmax = np.zeros((DIMENSION, len(langs)), np.float32)
    softmax += rng.normal(0, 0.1, softmax.shape)
    bias = np.zeros(len(langs), np.float32)
    usable = np.array([len(b) > 0 for b in buckets], bool)
    known = np.flatnonzero(~held & usable)
    known = known if len(known) else np.flatnonzero(usable)
    steps, total = 0, EPOCHS * len(known)
    for _ in range(EPOCHS):
        for i in rng.permutation(known):
            rate = 0.5 * (1 - steps / total) + 0.01
            steps += 1
            rows = embedding[buckets[i]]
            x = weights[i] @ rows
            z = x @ softmax + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            back = softmax @ p
            softmax -= rate * np.outer(x, p)
            bias -= 0.1 * rate * p
            # weights are small (they add up to one), so the rows' step is scaled up by their number
            embedding[buckets[i]] = rows - rate * np.minimum(weights[i] * 50, 1)[:, None] * back
    table = np.concatenate([embedding @ softmax, np.zeros((1, len(langs)), np.float32)]).astype(np.float32)
    model = Model(langs, table, bias, 1.0, 0.0)
    tried = np.flatnonzero(held & usable)
    tried = tried if len(tried) else known
    logits = np.stack([weights[i] @ table[buckets[i]] for i in tried]) if len(tried) else np.zeros((0, len(langs)))
    if not len(tried):
        return model
    choices = [2.0**k for k in np.arange(-3, 3.01, 0.25)]
    loss = [-np.log(model._replace(temperature=t).probabilities(logits)[np.arange(len(tried)), label[tried]] + 1e-9).mean() for t in choices]
    model = model._replace(temperature=choices[int(np.argmin(loss))])
    p = model.probabilities(logits)
    right = p.argmax(axis=1) == label[tried]
    threshold = float(np.quantile(p.max(axis=1)[right], 1 - KEEP)) if right.any() else 0.0
    return model._replace(threshold=min(0.9, 0.8 * threshold))


def fit(docs: DataFrame, sample: int = SAMPLE, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Learn from about ``sample`` documents of each language at most, chosen by a hash of their ids.

    The caller leaves out rows that must not be learned. Rows without language,
    id or text are ignored. Without any row the model knows no language and
    answers ``und``. Only weighted buckets of the sample reach the driver.
    """
    ship(docs.sparkSession)
    known = docs.filter(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )

    @F.arrow_udf("struct<bucket:array<int>,weight:array<float>>")
    def bag(texts: pa.Array) -> pa.Array:
        kept, weights = [], []
        for block in text_blocks(texts):
            found = bags(words(block, lower=True))
            kept += found[0]
            weights += found[1]
        at = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32))
        join = lambda parts, kind: pa.array(np.concatenate([*parts, np.zeros(0)]).astype(kind))
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(at, join(kept, np.int32)), pa.ListArray.from_arrays(at, join(weights, np.float32))],
            ["bucket", "weight"],
        )

    got = (
        bounded(known, "id", sample, by="lang")
        .select("id", "lang", bag("text").alias("bag"), (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).alias("held"))
        .toArrow()
        .combine_chunks()
    )
    if not got.num_rows:
        return Model([], np.zeros((0, 0)), np.zeros(0), 1.0, 0.0)
    names, held = got["lang"].to_pylist(), got["held"].to_numpy()
    parts = [pc.struct_field(got["bag"].combine_chunks(), k) for k in ("bucket", "weight")]
    parts = [p.combine_chunks() if isinstance(p, pa.ChunkedArray) else p for p in parts]
    at, bucket, weight = parts[0].offsets.to_numpy(), parts[0].values.to_numpy(), parts[1].values.to_numpy()
    langs = sorted(set(names))
    order = sorted(range(len(names)), key=lambda k: (got["id"][k].as_py(), names[k], at[k + 1] - at[k]))
    # Slices of what came from Spark, not copies: the driver holds the sample once.
    return train(
        [bucket[at[k] : at[k + 1]] for k in order],
        [weight[at[k] : at[k + 1]] for k in order],
        np.array([langs.index(names[k]) for k in order]),
        langs,
        held[order],
    )


def language_column(model: Model, text: str | Column) -> Column:
    """A struct of the predicted language, its calibrated score, and whether the prediction is accepted.

    A null text or one without a letter gives ``und``, zero and false. Every
    other text gives a learned language; ``accepted`` is the rejection rule.
    """

    @F.arrow_udf("struct<lang:string,score:double,accepted:boolean>")
    def of_texts(texts: pa.Array) -> pa.Array:
        names, scores = model.predict(texts)
        accepted = (scores >= model.threshold) & np.array([n != UNKNOWN for n in names], bool)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
            ["lang", "score", "accepted"],
        )

    return of_texts(text)


def keep_identified(docs: DataFrame, sample: int = SAMPLE, text: str = "text") -> DataFrame:
    """The documents whose language is identified with an accepted score; all where nothing can be learned."""
    model = fit(docs, sample, text)
    return docs.filter(language_column(model, F.col(text))["accepted"]) if model.langs else docs
