"""Exact selection against sorting."""
import math
import random

import numpy as np
import pytest

from ticketlake.operators import selection as S


@pytest.mark.parametrize("small, splitters", [(10_000, 64), (5, 4)])
def test_quantiles_equal_sorting(spark, monkeypatch, small, splitters):
    monkeypatch.setattr(S, "SMALL", small)
    monkeypatch.setattr(S, "SPLITTERS", splitters)
    rng = random.Random(small)
    rows = [
        (rng.gauss(0, 1e6), 5.0 if rng.random() < 0.99 else rng.uniform(0, 9), rng.randint(0, 3), None if rng.random() < 0.4 else rng.random() * 1e-9, None, float("nan") if k % 7 == 0 else float(k))
        for k in range(700)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c int, d double, e double, f double").repartition(3)
    qs = (0.0, 0.25, 0.5, 0.77, 1.0)
    got = S.exact_quantiles(df, "abcdef", qs)
    for k, c in enumerate("abcdef"):
        values = [r[k] for r in rows if r[k] is not None and not math.isnan(r[k])]
        assert got[c] == ([pytest.approx(x, rel=1e-12) for x in np.quantile(values, qs)] if values else [None] * 5)


def test_equal_values_take_one_round(spark, monkeypatch):
    rounds = []
    narrowed = S._narrowed
    monkeypatch.setattr(S, "SMALL", 1)
    monkeypatch.setattr(S, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    assert S.exact_quantiles(spark.range(500).selectExpr("7 as x"), ["x"], [0.5]) == {"x": [7.0]} and len(rounds) == 1


def test_empty_table(spark):
    assert S.exact_quantiles(spark.range(0).selectExpr("id as x"), ["x"], [0.5, 1.0]) == {"x": [None, None]}
