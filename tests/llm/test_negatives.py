"""Hard negatives against brute force over all rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from florilege.llm import negatives as own

SCHEMA = "vec_id long, embedding array<float>, label int, mark string, slot string"


def brute(rows, is_anchor=lambda i: i % 100 == 0):
    kept = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = Counter()
    for a, (anchor, label, q) in enumerate(kept):
        if anchor is None or not is_anchor(anchor):
            continue
        scored = [(sum(x * y for x, y in zip(q, v)), i, other, k) for k, (i, other, v) in enumerate(kept) if k != a]
        for score, positive, *_ in sorted((x for x in scored if x[2] == label), key=key)[:5]:
            fit = sorted((x for x in scored if x[2] != label and 80 * score <= 100 * x[0] <= 100 * score), key=key)[:5]
            for rank, (s, negative, *_) in enumerate(fit, 1):
                out[anchor, positive, rank, negative, score, s] += 1
    return out


def found(spark, rows, **k):
    out = own.hard_negatives(spark.createDataFrame(rows, SCHEMA), **k)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, out.collect()))


def rows_of(n, seed, dim=6, labels=4):
    r = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in r.normal(size=dim)], int(r.integers(0, labels)), "clash", "clash") for i in range(n)]


@pytest.mark.parametrize("sizes", [(8192, 4096, 96), (40, 3, 4)])
def test_all_blocks_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK_ROWS", "ANCHOR_ROWS", "LEAF"), sizes, strict=True):
        monkeypatch.setattr(own, name, value)
    rows = rows_of(700, 3)
    same = rows[0][1]
    rows += [(k, same, 1, "c", "c") for k in range(2000, 2060)]  # one vector of many, ties
    rows += rows[100:103] + rows[:1]  # repeats, an anchor among them
    rows += [(None, [1.0] * 6, 1, "c", "c"), (3000, None, 1, "c", "c"), (3100, [1.0, None], 1, "c", "c"), (3200, [float("nan")], 1, "c", "c"), (3300, [float("inf")], 1, "c", "c"), (3400, [1.0], None, "c", "c")]
    rows += [(3500, [], 2, "c", "c"), (3600, [1.0, 2.0], 2, "c", "c"), (3700, [0.5] * 9, 3, "c", "c")]
    expected = brute(rows)
    assert len(expected) > 40
    assert found(spark, rows) == expected


def test_large_components_are_exact(spark):
    r = np.random.default_rng(5)
    rows = [(100 * k if k < 4 else k, [float(np.float32(x)) for x in r.normal(size=4) * 3e5], k % 2, "c", "c") for k in range(60)]
    assert found(spark, rows) == brute(rows)


def test_own_anchors(spark):
    rows = rows_of(80, 9)
    assert found(spark, rows, is_anchor=F.col("vec_id") < 5) == brute(rows, lambda i: i < 5)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1, "c", "c")], [(100, [1.0], 1, "c", "c")]])
def test_empty_and_tiny_tables(spark, rows):
    assert not found(spark, rows)


def test_nodes_are_pruned_by_windows_and_by_the_kth():
    r = np.random.default_rng(0)
    centres = r.normal(size=(20, 3)) * 5000
    v = (np.repeat(centres, 100, axis=0) + r.normal(size=(2000, 3)) * 20).astype(np.int64)
    block = own.Block(np.arange(2000), np.arange(2000), np.zeros(2000, np.int64), v)
    asks = own.Block(np.array([9999]), np.array([9999]), np.ones(1, np.int64), v[:1])
    seen = []
    add = own.Best.add
    own.Best.add = lambda self, who, score, *rest: seen.append(score.shape[1]) or add(self, who, score, *rest)
    try:
        top = int((v @ v[0]).max())
        own.search(asks, block, np.array([[top * 0.8]]), np.array([[float(top)]]), False, 5)
    finally:
        own.Best.add = add
    assert 0 < sum(seen) < 1000
