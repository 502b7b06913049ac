import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from florilege.llm import lm
from florilege.llm.lm import ORDER, score_documents


def lowered(text):
    return (text or "").encode().lower()


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Trie:
    """Contexts and their symbol counts, scored by walking down with a set of excluded symbols."""

    def __init__(self, texts):
        self.nodes = defaultdict(Counter)
        for t in texts:
            s = b"\0" * ORDER + t + b"\xff"
            for i in range(ORDER, len(s)):
                for k in range(ORDER + 1):
                    self.nodes[s[i - k : i]][s[i]] += 1

    def score(self, text):
        s, total = b"\0" * ORDER + text + b"\xff", 0.0
        for i in range(ORDER, len(s)):
            excluded = set()
            for k in range(ORDER, -1, -1):
                node = {x: n for x, n in self.nodes.get(s[i - k : i], {}).items() if x not in excluded}
                if not node:
                    continue
                t, q = sum(node.values()), len(node)
                if s[i] in node:
                    total += math.log10(node[s[i]] / (t + q))
                    break
                total += math.log10(q / (t + q))
                excluded |= set(node)
            else:
                total -= math.log10(256 - len(excluded))
        return total


def brute(rows):
    tokens = lambda t: [*lowered(t).split(), None]
    train = [t for i, t in rows if not is_held(i)]
    counts = Counter(w for t in train for w in tokens(t))
    n, trie = sum(counts.values()), Trie([lowered(t) for t in train])
    return sorted(
        (
            (i, is_held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in tokens(t)), trie.score(lowered(t)))
            for i, t in rows
        ),
        key=lambda r: str(r[0]) + str(r[2]),
    )


def rows():
    rng = random.Random(2)
    vocabulary = ["sun", "Moon", "étoile", "Rain", "x y", "漢字", "the", "of", "a"]
    out = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", "", chr(rng.randrange(33, 900))]) for _ in range(rng.choice([0, 1, 5, 40])))) for i in range(120)]
    return out + [(500, None), (501, ""), (502, " \n"), (503, "\0\0"), (None, "no id"), (504, "word " * 3000)]


@pytest.mark.parametrize("chunk", [1 << 20, 2000])
def test_equals_brute_force(spark, chunk):
    df = spark.createDataFrame([(*r, "clash") for r in rows()], "doc_id long, text string, score string")
    got = sorted(map(tuple, score_documents(df, chunk_bytes=chunk).collect()), key=lambda r: str(r[0]) + str(r[2]))
    want = brute(rows())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], abs=1e-6)


def test_repeated_rows_and_held_out_gain(spark):
    own = [(i % 90, t) for i, t in enumerate(["the sun and the moon and the rain fall on the plain"] * 180)] + [(9999, "zq#k!v"), (2, "the sun and the moon")]
    got = score_documents(spark.createDataFrame(own, "doc_id long, text string")).collect()
    assert len(got) == len(own)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_only_held_out_and_empty(spark):
    held = next(i for i in range(100) if is_held(i))
    got = score_documents(spark.createDataFrame([(held, "ab")], "doc_id long, text string")).collect()[0]
    assert got.train_tokens == 0 and got.score == pytest.approx(-3 * math.log10(256)) and got.base_score == 0.0
    assert score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeated_rows_stand_for_one_another(spark, monkeypatch):
    """Rows that repeat, id and all, count as often as they are there, and come out as often."""
    monkeypatch.setattr(lm, "COPIES", 7)
    rows = [(None, "the same text once more"), (3, "another one that repeats")] * 40 + [(i, f"text number {i} of its own") for i in range(100, 130)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, score_documents(df).collect()), key=str)
    split = sorted(map(tuple, score_documents(df, chunk_bytes=500).collect()), key=str)
    assert len(whole) == len(split) == len(rows)
    for a, b in zip(whole, split):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)
