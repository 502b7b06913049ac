import random
import re

import pytest

from florilege.llm import near
from florilege.llm.near import BLOCK, Join, least_matches, near_duplicates, one_of_each

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return tuple(WORD.findall((text or "").translate(LOWER)))


def shingles(ws):
    return {ws[i : i + 5] for i in range(max(1, len(ws) - 4))} if ws else set()


def brute(rows):
    """(id, class_id, n_links, n_copies) of each row."""
    keys = [("w", words(t)) if words(t) else ("t", t) for _, t in rows]
    distinct = list(dict.fromkeys(keys))
    sets = {k: shingles(k[1]) if k[0] == "w" else set() for k in distinct}
    links = {k: set() for k in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    least = {}
    comp = {}
    for k in distinct:
        if k not in comp:
            todo, seen = [k], {k}
            while todo:
                for n in links[todo.pop()]:
                    if n not in seen:
                        seen.add(n)
                        todo.append(n)
            ids = [i for (i, _), key in zip(rows, keys) if key in seen and i is not None]
            for n in seen:
                comp[n], least[n] = n, min(ids, default=None)
    return sorted(((i, least[k], len(links[k]), keys.count(k)) for (i, _), k in zip(rows, keys)), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 30, 120]))]
        for _ in range(rng.choice([1, 1, 2, 9])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own) + rng.choice(["", ".", " !"])))
    return rows


def test_equals_brute_force(spark):
    rows = corpus(40, 1) + [(900, None), (901, None), (902, ""), (903, "?!"), (904, "?!"), (905, "one two"), (906, "One, two"), (905, "one two"), (905, "something else entirely here"), (None, "w1 w2 w3"), (None, "no id here at all")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, class_id string")
    assert sorted([tuple(r) for r in near_duplicates(df).collect()], key=str) == brute(rows)


def test_pairs(spark):
    rows = corpus(25, 2)
    join = Join(spark.createDataFrame(rows, "doc_id long, text string"))
    key = {r.key: words(dict(rows)[r.id]) for r in join.classes.collect()}
    got = {frozenset((key[r.a], key[r.b])): r.similarity for r in join.pairs().collect()}
    distinct = sorted(set(key.values()))
    want = {}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            x, y = shingles(a), shingles(b)
            if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                want[frozenset((a, b))] = len(x & y) / len(x | y)
    assert got == pytest.approx(want) and want


def test_blocks_of_a_large_group(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(150):
        own = list(base)
        own[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(near, "BLOCK", 40)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert BLOCK != 40 and sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_least_matches():
    least = least_matches(0.8, 64, 1e-9)
    assert least[0] == 0 and all(0 <= m <= n for n, m in enumerate(least)) and least[64] < 0.8 * 64


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_chain_of_unlike_texts(spark, monkeypatch):
    """Thousands of classes that hang together, each like its neighbours only, are compared bucket by bucket."""
    rng = random.Random(9)
    stream = [f"w{rng.randrange(4000)}" for _ in range(2200 * 6 + 120)]
    rows = [(i, " ".join(stream[i * 6 : i * 6 + 120])) for i in range(2200)]
    compared = []
    placed = Join._placed

    def watched(members, n, kind):
        compared.append((kind, members.agg(near.F.sum(near.F.least("size", near.F.lit(BLOCK)))).first()[0] or 0))
        return placed(members, n, kind)

    monkeypatch.setattr(Join, "_placed", staticmethod(watched))
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    sets = [shingles(words(t)) for _, t in rows]
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i + 1, min(len(rows), i + 20)):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
    assert min(links) >= 1 and got == [(i, 0, links[i], 1) for i in range(len(rows))]
    work = dict(compared)
    assert work["whole"] < BLOCK * len(rows) / 10 and 0 < work["bucket"] < BLOCK * len(rows) / 2


def test_clashing_names_and_very_long_texts(spark):
    long = " ".join(f"w{i % 5000}x{i % 7}" for i in range(150_000))
    rows = [(1, long, "a", b"b"), (2, long + " end", "a", b"b"), (3, "short text of its own here", None, None), (4, None, "x", b"")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, comp string, key binary")).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, 1), (2, 1, 1, 1), (3, 3, 0, 1), (4, 4, 0, 1)]


def test_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text, 1), (None, text + " more", 2), (None, "alone here", 3), (None, "alone here", 3), (5, text + " and more", 4), (5, "another text of that id", 5), (4, text, 6), (4, text, 7), (None, None, 8), (None, None, 9)]
    got = one_of_each(spark.createDataFrame(rows, "doc_id long, text string, first int")).collect()
    kept = sorted(((r.doc_id, r.text) for r in got), key=str)
    assert kept == sorted([(None, "alone here"), (5, "another text of that id"), (4, text), (None, None)], key=str)
    assert one_of_each(spark.createDataFrame([], "doc_id long, text string, first int")).collect() == []


def test_rows_without_id_or_of_one_id_join_nothing(spark):
    """5,000 rows without id and as many of one id, near pairs among them: texts are found by row, not by id."""
    rng = random.Random(11)
    texts = []
    for k in range(2500):
        base = [f"w{rng.randrange(4000)}" for _ in range(40)]
        texts += [" ".join(base), " ".join([*base, "more"])]
    rows = [(None, t) for t in texts] + [(7, "other " + t) for t in texts]
    join = near.Join(spark.createDataFrame(rows, "doc_id long, text string"))
    found = join.documents().collect()
    assert len(found) == 10_000 and {r.n_links for r in found} <= {1, 2, 3} and all(r.n_links for r in found)
    plans = []
    own_text = near.Join._own_text
    near.Join._own_text = lambda self, texts: plans.append(texts.count()) or own_text(self, texts)
    try:
        join._in_units(False).count()
    finally:
        near.Join._own_text = own_text
    assert plans == [10_000]
