"""Training steps and scores of the language model against plain versions, and what they cost."""

import numpy as np
import pyarrow as pa
import pytest

from tablecheck.llm import lm
from tablecheck.llm.batches import words

TEXTS = ["the river runs and the stone lies", "the rare9 river", "", "stone and stone and rare3 and rare9 stone"] * 5


def small_model(rng: np.random.Generator, depth: int = 2) -> lm.Model:
    head = [lm.END, "the", "and", "river"]
    sizes = rng.integers(0, 3, lm.TAIL_CLASSES * lm.SLOTS**depth).astype(float)
    biases = lm.tree_biases(sizes, depth)
    weights = lambda n, width: rng.normal(0, 0.3, (n, width)).astype(np.float32)
    return lm.Model(
        100, 20, 5, 0.1, head, pa.array(["the", "and", "river"]), np.array([9.0, 8.0, 7.0]),
        np.log(np.full(lm.CLASSES, 1 / lm.CLASSES)).astype(np.float32), np.log(np.full((lm.HEAD_CLASSES, lm.SLOTS), 1 / lm.SLOTS)).astype(np.float32),
        np.ones(lm.CLASSES), weights(3 * 32, lm.CLASSES), weights(2 * 16 * lm.HEAD_CLASSES, lm.SLOTS), weights(2 * 64, lm.SLOTS),
        biases, [(b > lm.EMPTY).sum(axis=1) > 1 for b in biases],
    )


def tokens_of(model: lm.Model):
    found = words(pa.array(TEXTS), lower=True)
    return lm.read_tokens(found), *model.places(found.vocab)


def choices(model: lm.Model, tokens: lm.Tokens, of_class: np.ndarray, slot: np.ndarray):
    """Per token the choices it takes: table, rows of weights, bias and the chosen column, one at a time."""
    tables = (model.classes, model.slots, model.tree)
    mixed = lambda x: int(lm.mix(np.array([x], np.uint64))[0])
    for t, code in enumerate(tokens.codes):
        one, two, both = (int(h[t]) for h in (tokens.one, tokens.two, tokens.both))
        c, s = int(of_class[code]), int(slot[code])
        n = [len(tables[0]) // 3, len(tables[1]) // (2 * lm.HEAD_CLASSES), len(tables[2]) // 2]
        taken = [(0, [h % n[0] + k * n[0] for k, h in enumerate((one, two, both))], model.class_bias, c)]
        if s >= 0:
            rows = [((h >> 32) % n[1] + k * n[1]) * lm.HEAD_CLASSES + c for k, h in enumerate((one, two))]
            taken.append((1, rows, model.slot_bias[c], s))
        else:
            for depth, (bias, fork) in enumerate(zip(model.tree_bias, model.tree_forks)):
                leaf = (c - lm.HEAD_CLASSES) * lm.SLOTS ** (depth + 1) + (int(tokens.own[code]) >> (64 - 4 * (depth + 1)))
                if fork[leaf // lm.SLOTS]:
                    place = mixed(leaf // lm.SLOTS + ((depth + 1) << 40))
                    rows = [mixed(h ^ place) % n[2] + k * n[2] for k, h in enumerate((one, two))]
                    taken.append((2, rows, bias[leaf // lm.SLOTS], leaf % lm.SLOTS))
        yield taken


def probabilities(table, rows, bias):
    raised = np.exp(table[rows].astype(float).sum(axis=0) + bias)
    return raised / raised.sum()


def test_log_probabilities_follow_every_choice():
    model = small_model(np.random.default_rng(1))
    tokens, of_class, slot = tokens_of(model)
    tables, expected, forks = (model.classes, model.slots, model.tree), [], 0
    for taken in choices(model, tokens, of_class, slot):
        total = 0.0
        for which, rows, bias, column in taken:
            total += np.log(probabilities(tables[which], rows, bias)[column]) - (bias[column] if which == 2 else 0)
            forks += which == 2
        expected.append(total)
    assert forks > 20
    np.testing.assert_allclose(lm.log_probabilities(model, tokens, of_class, slot), expected, atol=1e-4)


def test_a_step_moves_every_row_by_its_gradient():
    model = small_model(np.random.default_rng(2))
    tokens, of_class, slot = tokens_of(model)
    before = (model.classes, model.slots, model.tree)
    sums, met = [np.zeros(t.shape) for t in before], [np.zeros(len(t)) for t in before]
    for taken in choices(model, tokens, of_class, slot):
        for which, rows, bias, column in taken:
            gradient = probabilities(before[which], rows, bias)
            gradient[column] -= 1
            for row in rows:
                sums[which][row] += gradient
                met[which][row] += 1
    trainer = lm.Trainer(model)
    trainer.learn(tokens, of_class, slot)
    for which, table in enumerate(before):
        change = sums[which] + np.where(met[which] > 0, lm.DECAY, 0)[:, None] * table
        way = 1 + (change**2).mean(axis=1)
        np.testing.assert_allclose(trainer.tables[which], table - change * (lm.RATE / np.sqrt(way))[:, None], atol=1e-4)
        assert trainer.met[which].tolist() == met[which].tolist()


def test_rows_of_a_table_are_summed_once_per_step(monkeypatch):
    """All features of a table have rows of their own, so one sum serves them; before, each feature took one."""
    calls, plain = [], lm.sum_rows
    monkeypatch.setattr(lm, "sum_rows", lambda values, key: calls.append(len(key) // len(values)) or plain(values, key))
    model = small_model(np.random.default_rng(3))
    lm.Trainer(model).learn(*tokens_of(model))
    assert calls == [3, 2, 2]


@pytest.mark.parametrize("keys", [1, 3])
def test_sums_of_rows_with_several_keys(keys):
    rng = np.random.default_rng(4)
    values = rng.normal(size=(400, 5)).astype(np.float32)
    # Keys with one row, some rows and very many.
    key = np.concatenate([np.where(rng.random(400) < 0.3, 7, rng.integers(0, 90, 400)) + 65_000 + 100 * k for k in range(keys)])
    rows, total, size = (np.concatenate(x) for x in zip(*lm.sum_rows(values, key)))
    assert sorted(rows.tolist()) == sorted(set(key.tolist()))
    for row, got, n in zip(rows, total, size):
        own = np.flatnonzero(key == row) % 400
        assert n == len(own)
        np.testing.assert_allclose(got, values[own].sum(axis=0), atol=1e-4)


def test_exponentials_of_very_large_and_very_small_logits():
    logits = np.array([[0.0, 1.0], [500.0, 499.0], [-500.0, -501.0], [-60.0, 0.0], [88.0, 88.0]], np.float32)
    expected = np.logaddexp(logits[:, 0], logits[:, 1])
    rows = np.arange(len(logits))
    for raised, of_row in ((lm.Raised.of(logits / 2, np.zeros(2, np.float32)), None), (lm.Raised.of(logits / 4, logits / 2), rows)):
        np.testing.assert_allclose(raised.log_sums((rows, rows), of_row), expected, rtol=1e-6, atol=1e-6)
    shares = lm._softmax(iter([(slice(0, len(logits)), logits)]), len(logits), 2)
    np.testing.assert_allclose(shares, np.exp(logits - expected[:, None]), atol=1e-6)


def test_rows_of_rare_words_carry_no_numbers_of_the_document():
    """They are most of what the scores shuffle, sort and join."""
    model = small_model(np.random.default_rng(5))
    batch = pa.RecordBatch.from_arrays([pa.array([3]), pa.array([None], pa.int64()), pa.array(["the rare9 rare9 rare3"])], ["row", "doc_id", "text"])
    rows = [r for b in lm._scorer(model)(iter([batch])) for r in b.to_pylist()]
    document, rare = rows[0], rows[1:]
    assert document["word"] == "\t3" and document["n"] == 0
    assert (document["whole"]["doc_id"], document["whole"]["tokens"], document["whole"]["known"]) == (None, 5, 2)
    assert {(r["row"], r["word"], r["n"], r["whole"]) for r in rare} == {(3, "rare9", 2, None), (3, "rare3", 1, None)}
