"""op1: classes, class scores and gradient steps do little for each token and are those of the plain formulas."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import maxent_lm as lm

WORDS = [b"", b"\n", b"a", b"a.", b"ab", b"ab.", b"ab!", b"abc", b"ab\xc3\xa9", b"\xc3", b"\xff\xfe", b"1", b"1-", b"."]


def test_class_is_asked_once_for_words_that_are_alike(monkeypatch):
    words = WORDS[1:] + [b"ab%dx" % i for i in range(1000)] + [b"ab%d." % i for i in range(1000)]
    want = [lm.class_of(w) for w in words]
    for some in (WORDS, WORDS[:1], [], [b"\n"]):
        assert lm.classes_of(pa.array(some, pa.binary())).tolist() == [lm.class_of(w) for w in some]
    plain, asked = lm.class_of, []
    monkeypatch.setattr(lm, "class_of", lambda w: asked.append(w) or plain(w))
    assert lm.classes_of(pa.array(words, pa.binary())[3:]).tolist() == want[3:]
    assert len(asked) < 20


def _model(rows):
    return lm.ClassModel(np.ones(lm.CLASSES), 1, 1, np.zeros((lm.ROWS, lm.CLASSES), np.float32) + np.array(rows, np.float32))


@pytest.mark.parametrize("far", [0, 200, -300])
def test_class_scores_are_those_of_logarithms(far):
    pick = np.random.default_rng(4)
    model = _model(pick.normal(size=(lm.ROWS, lm.CLASSES)))
    model.weights[: lm.BUCKETS : 2] += far  # exp of these leaves float32's range
    own, rows = pick.integers(0, lm.CLASSES, 9000), pick.integers(0, lm.BUCKETS, (3, 9000)) + np.array([[0], [1], [2]]) * lm.BUCKETS
    z = sum(model.weights[r].astype(np.float64) for r in rows) + model.weights[-1]
    want = z[np.arange(9000), own] - z.max(1) - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1))
    assert np.abs(model.class_scores(own, rows) - want).max() < (1e-4 if far else 1e-5)


def test_a_step_moves_rows_by_the_sums_of_their_gradients():
    pick, draw = np.random.default_rng(5), random.Random(5)
    model = _model(pick.normal(size=(lm.ROWS, lm.CLASSES)) * 0.1)
    n, before = 400, model.weights.astype(np.float64)
    own = pick.integers(0, lm.CLASSES, n)
    rows = np.array([[kind * lm.BUCKETS + draw.choice([1, 1, 2, 3, *range(10, 200)]) for _ in range(n)] for kind in range(3)])
    z = before[rows].sum(0) + before[-1]
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    p[np.arange(n), own] -= 1
    want = before.copy()
    sizes = set()
    for at in {*rows.ravel(), lm.ROWS - 1}:
        own_rows = p if at == lm.ROWS - 1 else p[(rows == at).any(0)]
        sizes.add(min(len(own_rows), 3))
        g = own_rows.sum(0) / np.sqrt(len(own_rows))
        want[at] -= g * 2 * lm.RATE / np.sqrt(1 + (g**2).sum())
    trainer = lm.Trainer(model)
    trainer.learn(own, rows)
    assert sizes == {1, 2, 3} and np.abs(model.weights - want).max() < 1e-5
    assert trainer.used[rows[0]].tolist() == [(rows[0] == r).sum() for r in rows[0]]
