import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from florilege.llm import sharding
from florilege.llm.sharding import assign_shards, place


def run(spark, rows, shards=24):
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, shard int")
    got = assign_shards(df, shards).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    for x in by.values():
        assert sorted(r.slot for r in x) == list(range(len(x)))
    return by


def test_balance_and_groups(spark):
    rng = random.Random(1)
    text = lambda: " ".join("w" * rng.randrange(1, 12) for _ in range(rng.randrange(400)))
    texts = [text() for _ in range(900)]
    rows = list(enumerate(texts + [t for t in texts[:40] for _ in range(3)] + [None, "", None]))
    by = run(spark, rows)
    sizes = [sum(r.size for r in by[s]) for s in range(24)]
    assert max(sizes) / (sum(sizes) / 24) < 1.03
    where = defaultdict(set)
    for s, x in by.items():
        for r in x:
            where[r.text_crc32].add(s)
    assert all(len(x) == 1 for x in where.values())


def test_hot_group_is_split(spark):
    rows = [(i, "the same text everywhere") for i in range(600)] + [(1000 + i, f"own text {i} " * (1 + i % 5)) for i in range(900)]
    by = run(spark, rows)
    sizes = [sum(r.size for r in by[s]) for s in range(24)]
    assert max(sizes) / (sum(sizes) / 24) < 1.1


def test_few_rows_repeats_and_none(spark):
    run(spark, [(1, "a"), (1, "a"), (None, None)])
    run(spark, [])


def test_place_balances_all_dimensions():
    rng = np.random.default_rng(0)
    v = rng.random((4000, 3))
    s = place(v, 24)
    totals = np.array([v[s == k].sum(axis=0) for k in range(24)])
    assert (totals.max(axis=0) / totals.mean(axis=0) < 1.05).all()


@pytest.mark.parametrize("own", [None, 7])
def test_equal_rows_with_equal_ids_spread(spark, own):
    rows = [(own, "the same text in all of these rows")] * 2400 + [(1000 + i, f"own text {i} " * (1 + i % 5)) for i in range(1200)]
    by = run(spark, rows)
    sizes, counts = ([f(by[s]) for s in range(24)] for f in (lambda x: sum(r.size for r in x), len))
    assert max(sizes) / (sum(sizes) / 24) < 1.03 and max(counts) / (sum(counts) / 24) < 1.1


def test_placement_equals_brute_force(spark):
    """Every group goes where the dot product is highest, one after the other by size."""
    rng = random.Random(3)
    rows = [(i, "x y " * rng.randrange(1, 300) + str(i % 350)) for i in range(400)]
    by = run(spark, rows)
    got = {r.doc_id: s for s, x in by.items() for r in x}
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.md5(t.encode()).digest()].append((i, (len(t) + 8, len(t.split(" ")), 1)))
    total = [sum(v[k] for g in groups.values() for _, v in g) for k in range(3)]
    items = []
    for key in sorted(groups):
        items.append(([sum(v[k] for _, v in groups[key]) * 24 / total[k] for k in range(3)], [i for i, _ in groups[key]]))
    left = [[1.0] * 3 for _ in range(24)]
    for share, ids in sorted(items, key=lambda x: -round(sum(w * v for w, v in zip((40, 1, 1), x[0])), 9)):
        best = max(range(24), key=lambda s: (round(sum(a * b * w for a, b, w in zip(left[s], share, (40, 1, 1))), 9), -s))
        left[best] = [a - b for a, b in zip(left[best], share)]
        assert {got[i] for i in ids} == {best}


def test_buckets_balance(spark, monkeypatch):
    """Many small groups in several buckets beside large ones that left unequal room."""
    monkeypatch.setattr(sharding, "BUCKET", 500)
    monkeypatch.setattr(sharding, "PART_ROWS", 20)
    rng = random.Random(5)
    rows = [(i, f"{i} " + "w " * rng.randrange(1, 60)) for i in range(6000)] + [(10_000 + i, "large " * 2000) for i in range(2)] + [(20_000 + i, f"big {i} " + "v " * 2000) for i in range(9)]
    by = run(spark, rows)
    sizes, counts = ([f(by[s]) for s in range(24)] for f in (lambda x: sum(r.size for r in x), len))
    assert max(sizes) / (sum(sizes) / 24) < 1.05 and min(sizes) / (sum(sizes) / 24) > 0.95
