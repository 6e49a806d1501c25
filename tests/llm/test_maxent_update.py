"""Operator 7: gradients summed by sorted buckets are those of sums over the whole flattened table, and take no fresh megabytes for each."""

import tracemalloc

import numpy as np
from quire.llm import maxent


def by_table(w, squares, f, y):
    p = maxent.softmax(maxent.logits(w, f))
    p[np.arange(len(y)), y] -= 1
    n = p.shape[1]
    w[-1] -= maxent.RATE * (g := p.mean(0)) / np.sqrt(squares[-1] + (g * g).sum() + 1e-8)
    squares[-1] += (g * g).sum()
    for k in range(maxent.KINDS):
        own = f[k] - k * maxent.BUCKETS
        active = np.flatnonzero(np.bincount(own, minlength=maxent.BUCKETS))
        cells = ((own * n)[:, None] + np.arange(n)).ravel()
        g = (np.bincount(cells, p.ravel(), maxent.BUCKETS * n).reshape(maxent.BUCKETS, n)[active] / len(y)).astype(np.float32)
        rows = active + k * maxent.BUCKETS
        squares[rows] += (g * g).mean(1)
        w[rows] -= maxent.RATE * 0.5 * g / np.sqrt(squares[rows] + 1e-8)[:, None]


def learnt(fn, size, times):
    """The weights, and the most bytes that the last call held at once."""
    rng = np.random.default_rng(3)
    n = maxent.GROUPS * (maxent.BINS + 1)
    w = (rng.normal(size=(maxent.KINDS * maxent.BUCKETS + 1, n)) * 0.1).astype(np.float32)
    squares = np.full(len(w), 1e-6, np.float32)
    for _ in range(times):
        f = np.minimum((rng.pareto(0.6, (maxent.KINDS, size)) * 3).astype(np.int64), maxent.BUCKETS - 1) + np.arange(maxent.KINDS)[:, None] * maxent.BUCKETS
        y = rng.integers(0, n, size)
        tracemalloc.start()
        fn(w, squares, f, y)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    return w, peak


def test_same_weights():
    for size in (1, 2, 500, maxent.BATCH):
        assert np.array_equal(learnt(maxent.update, size, 3)[0], learnt(by_table, size, 3)[0])


def test_no_fresh_megabytes():
    z = maxent.BATCH * maxent.GROUPS * (maxent.BINS + 1) * 4
    assert learnt(maxent.update, maxent.BATCH, 3)[1] < 2.5 * z
