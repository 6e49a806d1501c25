"""Many texts of one template that are no near copies of one another: what is verified grows with the texts, not with their square."""

import random

import numpy as np
from quire.llm import similar

from tests.llm.test_similar import kept


def test_template_makes_no_square(spark, monkeypatch):
    rnd, seen = random.Random(5), []
    verified = similar.Scan.verified

    def counted(self, pairs):
        seen.append(pairs.count())
        return verified(self, pairs)

    monkeypatch.setattr(similar.Scan, "verified", counted)
    base, rows = [f"t{i}" for i in range(150)], []
    for i in range(400):
        copy = list(base)
        for k in rnd.sample(range(150), rnd.randrange(1, 8)):
            copy[k] = f"e{rnd.randrange(3000)}"
        rows.append((i, " ".join(copy)))
    got = sorted(r.doc_id for r in similar.one_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == kept(rows) and 100 < len(got) < 300
    assert sum(seen) < 8 * len(rows), seen


def test_parities_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 31, 146, 900, 5000):
        for drop in range(0, max(1, n // 4), max(1, n // 40)):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, drop // 2, np.uint64)]))
            pair = similar.near(len(a), len(b), similar.parities(a)[:, None], similar.parities(b)[:, None], 0.8)
            assert pair.all() or not similar.alike(a, b, 0.8)
        other = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        assert n < 31 or n > 900 or not similar.near(len(a), len(other), similar.parities(a)[:, None], similar.parities(other)[:, None], 0.8).any()
