"""Document quality by a regularised quadratic discriminant.

Every text becomes a vector of transformed statistics. Each class is a Gaussian
whose covariance is shrunk towards its own diagonal; the Cholesky factors are
computed once and kept in the model. The score is the calibrated difference of
the two Mahalanobis log-densities.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bytes_of, ship, sum_runs, text_blocks, words
from .sampling import bounded

SAMPLE = 4_000
ACCEPT = 0.7
N_STATISTICS = 14
SHRINKAGES = (0.02, 0.1, 0.3, 0.6)

#: RE2 patterns of word kinds.
ODD_MARK = r"[^\pL\pN\pM\s.,;:?!'\"’“”«»¿¡()\[\]-]"
DOUBLED_MARK = r"[.,;:?!]{2}"


def _byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for low, high in ranges:
        table[low : high + 1] = 1
    return table


BYTE_CLASSES = (
    _byte_class((65, 90)),
    _byte_class((48, 57)),
    _byte_class((33, 47), (58, 64), (91, 96), (123, 126)),
    _byte_class((10, 10)),
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    ratio = part / np.maximum(whole, 1)
    return np.log((ratio + 2e-3) / (1 - ratio + 2e-3))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    rows = [_block_statistics(block) for block in text_blocks(texts)]
    return np.concatenate(rows) if rows else np.zeros((0, N_STATISTICS))


def _block_statistics(texts: pa.Array) -> np.ndarray:
    raw, at = bytes_of(texts)
    n_bytes = np.diff(at)
    columns = [_share(sum_runs(kind[raw].astype(np.int32), at), n_bytes) for kind in BYTE_CLASSES]
    found = words(texts)
    codes, starts, vocab = found
    n_words = np.diff(starts)
    has = lambda pattern: pc.match_substring_regex(vocab, pattern).to_numpy(zero_copy_only=False)
    letters, upper, lower = has(r"\pL"), has(r"\p{Lu}"), has(r"\p{Ll}")
    length = pc.utf8_length(vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    for flag in (has(ODD_MARK), has(DOUBLED_MARK), upper & ~lower & (length > 1), ~letters):
        columns.append(_share(sum_runs(flag[codes].astype(np.int32), starts), n_words))
    columns.append(np.log1p(sum_runs(length[codes], starts) / np.maximum(n_words, 1)))
    text_of = found.of_text()
    again = np.zeros(len(codes), np.int32)
    again[1:] = (codes[1:] == codes[:-1]) & (text_of[1:] == text_of[:-1])
    columns.append(_share(sum_runs(again, starts), n_words))
    pairs = np.sort(text_of * max(len(vocab), 1) + codes)
    new = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    repeats, owner = np.diff(np.append(new, len(pairs))), text_of[new]
    distinct = np.bincount(owner, minlength=len(n_words))
    most = np.zeros(len(n_words), np.int64)
    np.maximum.at(most, owner, repeats)
    columns.append(np.log1p(distinct) / np.log1p(np.maximum(n_words, 1)))
    columns.append(_share(most, n_words))
    columns.append(_share(distinct, n_words))
    columns.append(np.log1p(n_words))
    return np.stack(columns, axis=1)


class Gaussian(NamedTuple):
    """A class density: mean, Cholesky factor inverse and log-determinant term."""

    mean: np.ndarray
    whiten: np.ndarray
    offset: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        return self.offset - 0.5 * np.square((x - self.mean) @ self.whiten.T).sum(axis=1)


def gaussian(x: np.ndarray, shrinkage: float, spread: np.ndarray) -> Gaussian:
    """The class density with its covariance shrunk towards its diagonal.

    ``spread``, the variances over all classes, counts like as many rows as there
    are statistics, so a class of few rows is not taken for a narrow one.
    """
    n, k = x.shape
    covariance = (n * np.cov(x, rowvar=False, bias=True) + k * np.diag(spread)) / (n + k)
    covariance = (1 - shrinkage) * covariance + shrinkage * np.diag(np.diag(covariance)) + 1e-2 * np.diag(spread)
    factor = np.linalg.cholesky(covariance)
    return Gaussian(x.mean(axis=0), np.linalg.inv(factor), float(-np.log(np.diag(factor)).sum()))


class Model(NamedTuple):
    """Both class densities and the calibration of their difference; without both classes a constant."""

    good: Gaussian | None
    bad: Gaussian | None
    slope: float
    shift: float

    @property
    def trained(self) -> bool:
        return self.good is not None

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(x), self.shift)
        margin = np.clip(self.good.log_density(x) - self.bad.log_density(x), -60, 60)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, by Newton steps with a weak prior."""
    margin = np.clip(margin, -60, 60)
    a, b = 0.2, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((p - label) * margin).sum() + 0.5 * (a - 0.2), (p - label).sum() + 0.05 * b])
        hessian = np.array(
            [[(w * margin * margin).sum() + 0.5, (w * margin).sum()], [(w * margin).sum(), w.sum() + 0.05]]
        )
        step = np.linalg.solve(hessian, gradient)
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit_model(x: np.ndarray, label: np.ndarray, fold: np.ndarray) -> Model:
    """Densities from the rows with ``fold`` false; shrinkage and calibration from the others."""
    if not len(label):
        return Model(None, None, 0.0, 0.5)
    if label.min() == label.max():
        return Model(None, None, 0.0, float(label[0]))
    spread = x.var(axis=0) + 1e-3
    best = None
    for shrinkage in SHRINKAGES:
        known, tried = ~fold, fold
        if any(set(label[part].tolist()) != {0, 1} for part in (known, tried)):
            known = tried = np.ones(len(label), bool)
        good = gaussian(x[known & (label == 1)], shrinkage, spread)
        bad = gaussian(x[known & (label == 0)], shrinkage, spread)
        margin = good.log_density(x[tried]) - bad.log_density(x[tried])
        slope, shift = _calibrate(margin, label[tried])
        model = Model(good, bad, slope, shift)
        p = np.clip(model.score(x[tried]), 1e-6, 1 - 1e-6)
        loss = -np.mean(np.where(label[tried] == 1, np.log(p), np.log(1 - p)))
        if best is None or loss < best[0]:
            best = (loss, model)
    return best[1]


def statistics_column(text: str | Column) -> Column:
    @F.arrow_udf("array<double>")
    def of_texts(texts: pa.Array) -> pa.Array:
        x = statistics(texts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))

    return of_texts(text)


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", doc_id: str = "doc_id", quality: str = "quality"
) -> Model:
    """Train on at most about ``sample`` labelled documents of each class, chosen by a hash of their ids.

    The caller leaves out the labels that must not be learned. Null labels and
    ids are ignored; of repeated labels of one document the highest counts.
    Without labels the model scores 0.5 throughout, with one class only that class.
    Only the statistics of the sample reach the driver.
    """
    ship(docs.sparkSession)
    known = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(quality).isin(0, 1))
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(F.max(quality).cast("int").alias("__label"))
    )
    chosen = bounded(known, "__id", sample, by="__label")
    # The sample has a bounded number of rows of an id and a label each.
    rows = (
        docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
        .join(F.broadcast(chosen), "__id")
        .select("__id", "__label", statistics_column("__text").alias("x"), F.pmod(F.xxhash64("__id"), F.lit(4)).alias("fold"))
        .collect()
    )
    rows.sort(key=lambda r: (r["__id"], r["__label"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), N_STATISTICS)
    return fit_model(x, np.array([r["__label"] for r in rows], int), np.array([r["fold"] == 0 for r in rows], bool))


def score_column(model: Model, text: str | Column) -> Column:
    """The calibrated score of a text column between 0 and 1; a null text counts as empty."""

    @F.arrow_udf("double")
    def of_texts(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(texts)), pa.float64())

    return of_texts(text)


def keep_good(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, sample: int = SAMPLE, text: str = "text") -> DataFrame:
    """The documents whose score is ``accept`` or more; all of them where there is nothing to learn from."""
    model = fit(docs, labels, sample, text)
    return docs.filter(score_column(model, F.col(text)) >= accept) if model.trained else docs
