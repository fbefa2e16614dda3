"""Exact neighbours against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, v string, score int"


def plain(rows, k=5):
    good = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((n, i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, i, v in good:
        if i is None or i % 50:
            continue
        others = [(-sum(a * b for a, b in zip(v, w)), j is None, j) for m, j, w in good if m != n]
        ranked = sorted(others, key=lambda t: (t[0], t[1], t[2] or 0))[:k]
        out += [(i, r, j, -s) for r, (s, _, j) in enumerate(ranked, 1)]
    return sorted(out, key=repr)


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.search(df, F.col("vec_id") % 50 == 0, **more).collect()), key=repr)


def made(seed, n, width):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(0, 0.3, width).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_neighbours_equal_all_products(spark, monkeypatch, lists):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "AT_ONCE", 3)
    rows = made(1, 500, 8)
    assert found(spark, rows, lists=lists) == plain(rows)


def test_copies_ties_and_repeated_rows(spark):
    rows = [(i, [0.5, 0.5, 0.0]) for i in range(300)] + [(i, [0.5, 0.5, 0.1]) for i in range(300, 400)]
    rows += [(50, [0.5, 0.5, 0.0]), (50, [0.5, 0.5, 0.0]), (100, [-1.0, 0.0, 0.25]), (None, [9.0, 9.0, 9.0]), (None, [9.0, 9.0, 9.0])]
    assert found(spark, rows) == plain(rows)


def test_what_takes_no_part(spark):
    rows = [(0, None), (50, [1.0, None]), (100, [1.0, float("nan")]), (150, [float("inf"), 1.0]), (200, [1.0, 2.0]), (7, [3.0]), (8, []), (250, [])]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert found(spark, [(50, [1.0])]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(2.0**19 + 37 * i)), float(np.float32(3.3 * i))]) for i in range(60)]
    assert found(spark, rows) == plain(rows)
    with pytest.raises(ValueError, match="62 bits"):
        found(spark, [(0, [1e30]), (1, [1.0])])

