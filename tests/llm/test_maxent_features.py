"""Operator 7 sees three words back, and reaches its held-out score."""

import numpy as np
from pyspark.sql import functions as F

from quire.llm import maxent


def test_three_back():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 2, 3, 4, 5])
    changed = (maxent.features(a, 100) != maxent.features(b, 100)).any(0)
    assert changed.tolist() == [False, True, True, True, False]


def test_held_out(spark, sf):
    base, score = maxent.query(spark, sf).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base + 400  # 290 with the smaller model
