"""Hard negatives against all pairs in plain Python."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import hard_negatives as H

DDL = "vec_id long, embedding array<float>, label int, score string, k int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(5)


def brute(rows, is_anchor, low=80, n=5):
    good = []
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, va, la in good:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in good if i != a)
        for ps, p, _ in [x for x in scored if x[2] == la][:n]:
            fit = [x for x in scored if x[2] != la and low * -ps <= 100 * -x[0] <= 100 * -ps][:n]
            out += [(a, p, k, i, -ps, -s) for k, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(n, dims=8, labels=3, spread=0.3):
    random.seed(n)
    centres = [[random.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    out = []
    for i in range(n):
        label = random.randrange(labels)
        out.append((i, [x + random.gauss(0, spread) for x in centres[random.choice([label, random.randrange(labels)])]], label))
    return out


@pytest.mark.parametrize("group_bytes", [1 << 23, 2_000])
def test_brute_force(spark, group_bytes):
    rows = vectors(400)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(60)]  # a hot vector: ties by id
    rows += [(2000, [0.0] * 8, 1), (2010, [0.0] * 8, 1), (2020, [-x for x in rows[0][1]], 2)]
    rows += [(None, [1.0] * 8, 1), (3000, None, 1), (3010, [1.0] * 8, None), (3020, [None] * 8, 1), (3030, [math.nan] * 8, 1), (3040, [math.inf] * 8, 2)]
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, group_bytes=group_bytes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 10 == 0)


def test_exact_beyond_doubles(spark):
    random.seed(3)
    rows = [(i, [random.choice([1, 3, 5, 7]) * 2.0**18 + random.randrange(9) for _ in range(4)], i % 2) for i in range(40)]
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 4 == 0)
    want = brute(rows, lambda i: i % 4 == 0)
    assert sorted(tuple(r) for r in got.collect()) == want and max(r[4] for r in want) > 2**53


def test_short_repeated_and_huge_vectors(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0], 0), (2, [0.9, 1.8], 1), (2, [0.9, 1.8], 1), (0, [1.0, 2.0], 0), (5, [], 1), (6, [3e38, 3e38], 1)]
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") == 0)
    low = 256 * 256
    assert [(r.positive_id, r.positive_score) for r in got.collect()] == []
    got = H.hard_negatives(frame(spark, [*rows, (7, [1.0, 2.0], 0)]), F.col("vec_id") == 0).collect()
    assert sorted((r.rank, r.negative_id) for r in got) == [(1, 2), (1, 2), (2, 2), (2, 2)] and got[0].positive_score == 5 * low


def test_no_rows(spark):
    rows = vectors(30)
    assert H.hard_negatives(frame(spark, rows), F.lit(False)).count() == 0
    assert H.hard_negatives(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert H.hard_negatives(frame(spark, [(i, v, 0) for i, v, _ in rows]), F.lit(True)).count() == 0


def test_bounds_hold():
    random.seed(9)
    rng = np.random.default_rng(9)
    for scale in (1, 256, 1e5):
        parts = np.floor(rng.normal(size=(300, 12)) * scale)
        parts[:20] = 0
        parts[20:40] = -parts[40:60]
        refs = H.choose_references(parts[:100])
        norms = H._norms(parts)
        block = H.Block(np.arange(300), np.zeros(300, int), parts, H.angles(parts, norms, refs))
        low, high = H.bounds(block, block, slice(0, 300))
        exact = parts @ parts.T
        assert (low <= exact).all() and (exact <= high).all()
        if scale == 256:
            assert (high - low < 1.9 * norms[:, None] * norms[None, :]).mean() > 0.5
