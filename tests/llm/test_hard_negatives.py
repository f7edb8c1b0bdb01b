"""Threshold algorithm against brute force."""

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from tenure.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, qid string, block int, score double"


def brute(rows, every=5, positives=5, negatives=3, low=50, high=95):
    good = []
    for r in set((r[0], tuple(r[1]) if r[1] is not None else None, r[2]) for r in rows):
        if None not in r and None not in r[1] and all(map(math.isfinite, r[1])):
            good.append((r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]], r[2]))
    out = set()
    for i, a, la in good:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j, lb) for j, b, lb in good if len(b) == len(a)]
        for p, j, _ in sorted(x for x in scored if x[2] == la and x[1] != i)[:positives]:
            inside = sorted(x for x in scored if x[2] != la and low * -p <= 100 * -x[0] <= high * -p)[:negatives]
            out |= {(i, j, k, x[1], -p, -x[0]) for k, x in enumerate(inside, 1)}
    return out


def _rows(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, spread, (max(2, n // 8), dim))
    v = base[rng.integers(0, len(base), n)] + rng.normal(0, 0.3, (n, dim))
    return [(i, v[i].tolist(), int(rng.integers(0, 4)), "a", "b", 1, 0.5) for i in range(n)]


def _mine(df, **kw):
    got = hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **kw)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed, n, dim, block, chunk", [(1, 300, 8, 64, 4096), (2, 250, 3, 8192, 7), (3, 120, 1, 100, 10)])
def test_negatives_equal_brute_force(spark, seed, n, dim, block, chunk):
    rows = _rows(seed, n, dim)
    assert _mine(spark.createDataFrame(rows, SCHEMA), block=block, chunk=chunk) == brute(rows)


def test_negatives_of_odd_rows(spark):
    rows = [r[:7] for r in _rows(4, 60, 4)]
    x = lambda i, v, label: (i, v, label, "a", "b", 1, 0.5)
    rows += [x(100 + i, rows[10][1], 0) for i in range(20)] + [x(200 + i, rows[10][1], 1 + i % 2) for i in range(20)]  # copies
    rows += [x(305, None, 1), x(310, rows[0][1], None), x(315, [0.1, None, 0.2, 0.3], 1), x(320, [0.1, float("nan"), 0.2, 0.3], 1)]
    rows += [x(325, [float("inf"), 0.0, 0.0, 0.0], 1), x(330, [0.0] * 4, 1), x(335, [1.0, 2.0], 1), x(340, [1.0, 2.5], 2), x(345, [], 1), x(350, [], 2)]
    rows += [rows[5], rows[5], x(355, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows + [x(None, rows[0][1], 1)], SCHEMA)
    assert _mine(df) == brute(rows)
    assert _mine(df.limit(0)) == set()
    assert _mine(df.where("vec_id % 5 != 0")) == set()
    big = spark.createDataFrame([x(5, [1e30, 0.0], 1), x(6, [1.0, 1.0], 1), x(10, [1.0, 2.0], 1), x(11, [1.0, 0.0], 2)], SCHEMA)
    assert _mine(big) == {(10, 6, 1, 11, 3 * 65536, 65536)} or _mine(big) == brute([tuple(r) for r in big.where("vec_id != 5").collect()])


def test_threshold_stops_early_and_ties_by_row():
    random.seed(1)
    v = np.zeros((4096, 2), np.int64)
    v[:, 0] = np.arange(4096)[::-1]
    v[:50, 0] = 5000
    lists = hard_negatives.Lists(v)
    ((best),) = lists.search(np.array([3, 0]), np.ones(4096, bool), [(-(2**63), 2**63 - 1)], 3)
    assert best == [(15000, 0), (15000, 1), (15000, 2)]
    wild = np.array([[2**30, -(2**30)], [2**30, 2**30 - 1]])
    ((best),) = hard_negatives.Lists(wild).search(np.array([2**30, 2**30]), np.ones(2, bool), [(-(2**63), 2**63 - 1)], 2)
    assert best == [(2**60 + 2**30 * (2**30 - 1), 1), (0, 0)]
