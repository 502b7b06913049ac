import hashlib
import random
import re

import pytest

from florilege.llm import decontaminate as module
from florilege.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            ws = words(item)
            n = min(window, len(ws))
            windows = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if n else set()
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def case():
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(12)] + ["é", "the", "of"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 4, 9, 10, 11, 25, 40]))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "!!"), (3, items[3][1]), (3, "Another text of item three"), (None, "an item that has no id")]
    docs = []
    for i in range(60):
        parts = [text(rng.choice([0, 3, 40]))]
        for _ in range(rng.choice([0, 1, 3])):
            item = words(rng.choice(items)[1])
            a = rng.randrange(len(item) + 1)
            parts.append(" - ".join(item[a : a + rng.choice([5, 9, 10, 14, 60])]).upper())
        docs.append((i, ". ".join(parts)))
    docs += [(200, None), (201, ""), (202, "?"), (7, docs[7][1]), (None, docs[9][1]), (203, "say an item, that has NO id!"), (204, text(5000))]
    return docs, items


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_equals_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(module, "BROADCAST_BYTES", bound)
    docs, items = case()
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, item_id string")
    own = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    got = decontaminate(df, own).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = case()
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(no_docs, spark.createDataFrame(items, "item_id long, text string")).collect() == []
    got = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), no_items).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(docs, [])


def test_plan_is_native(spark):
    docs, items = case()
    df = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert not re.search("Python|Pandas|MapInArrow|ArrowEval|Cartesian|NestedLoop", df._jdf.queryExecution().toString())
