"""Removal of repeated passages against a count of all passages."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from florilege.llm import suffixes as own

SCHEMA = "doc_id long, text string, lo string, ranges string"


def brute(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[k : k + length] for r in raw for k in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone, strict=True) if not g)).hexdigest()))
    return out


def words(r, n):
    return " ".join(r.choice(["alpha", "bé", "gamma", "d", "epsilon", "zeta", "straße", "漢字", "eta"]) + str(r.randrange(99)) for _ in range(n))


def sample(seed):
    r = random.Random(seed)
    passages = [words(r, k) for k in (30, 60, 65, 70, 90, 300)]
    texts = [words(r, r.randrange(1, 200)) for _ in range(40)]
    for _ in range(70):
        texts.append(" ".join(r.choice([r.choice(passages), words(r, r.randrange(1, 60))]) for _ in range(r.randrange(1, 6))))
    near = words(r, 400)
    texts += [near[:k] + "X" + near[k:] for k in range(100, 2000, 150)]
    texts += texts[:3] + [texts[41]] * 4
    texts += ["a" * 399, "b" * 400, "c" * 401, "d" * 400, "d" * 400, "xy" * 500, "line of text\n" * 80, ("0123456789" * 7 + "\n") * 30, "", None, None]
    return texts


def found(spark, texts):
    out = own.remove_repeats(spark.createDataFrame([(k, t, "clash", "clash") for k, t in enumerate(texts)], SCHEMA))
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return [tuple(row)[1:] for row in sorted(out.collect())]


@pytest.mark.parametrize("hot", [own.HOT_BYTES, 3000])
def test_texts_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(own, "HOT_BYTES", hot)
    monkeypatch.setattr(own, "BUCKET_BYTES", min(hot // 2, own.BUCKET_BYTES))
    monkeypatch.setattr(own, "NAMES", 500)
    texts = sample(1)
    expected = brute(texts)
    assert any(x[1] for x in expected) and any(not x[1] for x in expected)
    assert found(spark, texts) == expected


def test_empty_table_and_texts_without_repeats(spark):
    assert found(spark, []) == []
    assert found(spark, ["short", None, "a" * 400]) == brute(["short", None, "a" * 400])


def test_long_text_in_pieces(spark):
    r = random.Random(4)
    long = words(r, 400_000)
    assert len(long) > 2 * own.PIECE
    texts = [long + long[own.PIECE - 700 : own.PIECE + 900], "x" + long[1_900_000:1_900_500]]
    assert found(spark, texts) == brute(texts)


@pytest.mark.parametrize("piece", [900, 5000])
def test_contexts_cover_every_start_once(monkeypatch, piece):
    monkeypatch.setattr(own, "PIECE", piece)
    raw = [(t or "").encode() for t in sample(2)]
    data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw])
    lo, n, anchor, ctx = own.contexts(data, ends)
    starts = sorted(k for a, b in zip(lo.tolist(), n.tolist(), strict=True) for k in range(a, a + b))
    first = ends - [len(x) for x in raw]
    assert starts == [f + k for f, x in zip(first.tolist(), raw, strict=True) for k in range(len(x) - 399)]
    by = {}
    for a, b, h in zip(lo.tolist(), n.tolist(), anchor.tolist(), strict=True):
        for k in range(a, a + b):
            by.setdefault(bytes(data[k : k + 400]), set()).add(h)
    assert all(len(x) == 1 for x in by.values())  # equal passages have one anchor


@pytest.mark.parametrize("shard", [700, 2000, 1 << 20])
def test_merged_transforms_are_the_sorted_suffixes(monkeypatch, shard):
    monkeypatch.setattr(own, "SHARD_BYTES", shard)
    monkeypatch.setattr(own, "SYMBOL", 5)
    r = np.random.default_rng(shard)
    sizes = r.integers(20, 90, 60)
    data = r.integers(97, 99, sizes.sum()).astype(np.uint8)
    t = own.Transforms(data, sizes)
    assert len(t.shards) > 1 or shard > 5000
    slot, common = t.merge(4)

    def symbols(s):
        string, place = t.string[s], t.place[s]
        out = [int(t.symbol[t.first[string] + p]) for p in range(place, sizes[string] + 1, 5)]
        return out[:4]

    seen = [symbols(s) for s in slot]
    assert seen == sorted(seen) and sorted(slot.tolist()) == list(range(len(t.string)))
    for a, b, c in zip(seen[:-1], seen[1:], common[1:].tolist(), strict=True):
        shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert c == (shared if shared < len(a) or shared < len(b) else 4)


def test_query_over_the_whole_table(spark):
    import __spark_entry__

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, __spark_entry__.queries()["op12_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted((row.doc_id, *x) for row, x in zip(rows, brute([row.text for row in rows]), strict=True))
