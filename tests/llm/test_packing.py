import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from florilege.llm import packing
from florilege.llm.packing import cut_lengths, pack

VOCAB = P.path("byte_bpe_50k.json")


def test_cut_lengths():
    for n in range(1, 5000):
        cut = cut_lengths(n, 1024)
        assert sum(cut) == n and all(x in (1024, 512, 256, 128) for x in cut[:-1]) and 0 < cut[-1] <= 1024


def test_pack_is_whole_and_tight(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "x1", "#"]) for _ in range(rng.choice([0, 1, 9, 300, 4000]))), "clash") for i in range(150)]
    rows += [(1000, None, ""), (1000, None, ""), (None, "a <|endoftext|> b", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    got = pack(df, VOCAB, P.PATTERN, with_ids=True).collect()
    library = Tokenizer.from_file(VOCAB)
    want = sorted(str((i, library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, _ in rows)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *r.ids))
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    whole = []
    for i, pieces in docs.items():
        if i == 1000:
            assert [p.ids for p in pieces] == [[0], [0]]
            whole += [str((i, [0]))] * 2
            continue
        pieces.sort(key=lambda r: r.start)
        ids = [x for p in pieces for x in p.ids]
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert all(p.doc_tokens == len(ids) for p in pieces)
        whole.append(str((i, ids)))
    assert sorted(whole) == want
    total = sum(r.length for r in got)
    assert len(sequences) <= total / 1024 + 3


@pytest.mark.parametrize("capacity", [64, 1024])
def test_empty_table(spark, capacity):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pack(df, VOCAB, P.PATTERN, capacity=capacity).collect() == []


def test_rounds_of_workers_and_null_ids(spark, monkeypatch):
    """More workers than one task takes, all rows without id: every id is packed once, with little padding."""
    monkeypatch.setattr(packing, "FAN", 3)
    rows = [(None, " ".join(f"w{(i * j) % 97}" for j in range(1 + i % 300))) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(14)
    got = pack(df, VOCAB, P.PATTERN).collect()
    library = Tokenizer.from_file(VOCAB)
    total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in got) == total
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    assert len(held) <= total / 1024 * 1.06 + 3
    for x in held.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 1024
