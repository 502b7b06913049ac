import random
import re

import pytest

from florilege.llm import licenses as module
from florilege.llm.license_rules import build
from florilege.llm.licenses import BASE, BASE_WEIGHT, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
RULES = [(r.rule, r.label, re.compile(r.pattern), r.weight) for r in build()]


def brute(doc_id, text):
    words = WORD.findall((text or "").translate(LOWER))
    line = " " + " ".join(words) + " "
    place = lambda m: (line[: m.start()].count(" "), line[: m.start()].count(" ") + m[0].count(" ") - 1)
    base = sorted((i, label) for phrase, label in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    found = sorted(((*place(m), rule, label, weight) for rule, label, p, weight in RULES for m in p.finditer(line)), key=lambda x: (x[0], -x[1], x[2]))
    kept, outer = [], -1
    for x in found:
        if x[1] > outer:
            kept.append(x)
        outer = max(outer, x[1])
    left = []
    for x in sorted(kept, key=lambda x: (x[2], x[0])):
        if not any(t[0] <= x[1] and t[1] >= x[0] and t[2] < x[2] for t in left):
            left.append(x)
    labels = {label for _, label in base} | {x[3] for x in left}
    weights = [x[4] for x in left] + [BASE_WEIGHT] * bool(base)
    return (doc_id, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), max(weights, default=0.0))


LINES = [
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: MIT",
    "released under the MIT License", "licensed under CC BY-NC 4.0", "CC, by", "cc. BY sa 3.0", "All rights reserved.", "Copyright (c) 2019-2021 someone", "LGPL v2.1 or later",
    "Redistribution and use in source and binary forms, with or without modification, are permitted", "https://creativecommons.org/licenses/by-sa/4.0/", "released into the public domain",
    "the mpl 2.0", "distributed under the terms of the EUPL 1.2", "mit Licence", "the 3-clause BSD", "WTFPL", "http://www.apache.org/licenses/LICENSE-2.0", "gnu general public license gnu general public license",
]


def case():
    rng = random.Random(9)
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choice(["word", "licensed", "under", "the", "é", "mit", "bsd", "Version", "2.0"]) for _ in range(rng.randrange(30)))]
        parts += [rng.choice(LINES) for _ in range(rng.choice([0, 1, 1, 4]))]
        rng.shuffle(parts)
        rows.append((i, " ".join(parts)))
    rows += [(i + 200, x) for i, x in enumerate(LINES)]
    return rows + [(300, None), (301, ""), (302, "?!"), (303, ". " + LINES[0] + " x" * 3000 + " " + LINES[1]), (5, rows[5][1]), (None, LINES[3])]


@pytest.mark.parametrize("segment", [1024, 70])
def test_equals_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(module, "SEGMENT", segment)
    df = spark.createDataFrame([(*r, "clash", "x") for r in case()], "doc_id long, text string, labels string, key string")
    got = sorted(map(tuple, scan_licenses(df).collect()), key=str)
    assert got == sorted((brute(*r) for r in case()), key=str)


def test_keywords_and_gates_hold():
    for line in LINES:
        words = " " + " ".join(WORD.findall(line.translate(LOWER))) + " "
        for r in build():
            assert not re.search(r.pattern, words) or r.keyword in words
    assert len(build()) > 300


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_plan_is_native(spark):
    plan = scan_licenses(spark.createDataFrame(case(), "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|ArrowEval|Cartesian|NestedLoop", plan)


def test_overlap_beyond_the_neighbour(spark):
    rows = [("k", 0, 9, 1, "a", 1.0), ("k", 2, 11, 3, "b", 1.0), ("k", 4, 13, 2, "c", 1.0), ("k", 12, 15, 4, "d", 1.0), ("k", 40, 41, 9, "e", 1.0), ("j", 2, 11, 3, "b", 1.0)]
    found = spark.createDataFrame(rows, "key string, first int, last int, rule int, label string, weight double")
    assert sorted((r.key, r.label) for r in module.resolve(found).collect()) == [("j", "b"), ("k", "a"), ("k", "d"), ("k", "e")]


def test_what_is_suppressed_suppresses_nothing(spark):
    rows = [("k", 4 * i, 4 * i + 4, i, str(i), 1.0) for i in range(7)] + [("j", 12 - 4 * i, 16 - 4 * i, i, str(i), 1.0) for i in range(4)]
    found = spark.createDataFrame(rows, "key string, first int, last int, rule int, label string, weight double")
    assert sorted((r.key, r.label) for r in module.resolve(found).collect()) == [("j", "0"), ("j", "2"), ("k", "0"), ("k", "2"), ("k", "4"), ("k", "6")]


def test_very_long_text(spark):
    text = ("Licensed under the Apache License, Version 2.0 or CC BY and more words. " * 15_000).strip()
    assert len(text) > 1_000_000
    assert [tuple(r) for r in scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()] == [brute(1, text)]


def sample(parsed, rng):
    """A text that a parsed pattern matches; what looks ahead is left out."""
    out = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "IN":
            kind, value = arg[0]
            if str(kind) == "NEGATE":
                out.append("x")
            else:
                out.append(chr(value if str(kind) == "LITERAL" else value[0]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            out += [sample(inner, rng) for _ in range(rng.choice([low, min(int(high), low + 2)]))]
        elif name == "SUBPATTERN":
            out.append(sample(arg[3], rng))
        elif name == "BRANCH":
            out.append(sample(rng.choice(arg[1]), rng))
        elif name == "NOT_LITERAL":
            out.append("x")
    return "".join(out)


def most_words(parsed):
    """The most spaces that a match can hold."""
    n = 0
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            n += chr(arg) == " "
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            inner = most_words(arg[2])
            assert not inner or int(arg[1]) < 1000, "a match of any length"
            n += inner and inner * int(arg[1])
        elif name == "SUBPATTERN":
            n += most_words(arg[3])
        elif name == "BRANCH":
            n += max(map(most_words, arg[1]))
    return n


def test_every_rule_passes_its_gate_and_keyword(spark):
    rng = random.Random(2)
    rows = []
    for r in build():
        parsed = re._parser.parse(r.pattern)
        assert most_words(parsed) <= module.EDGE, r
        for _ in range(3):
            tries = (sample(parsed, rng).strip() + end for _ in range(60) for end in ("", " 2 0"))  # some look ahead for a version
            text = next(t for t in tries if re.search(r.pattern, f" {t} "))
            assert r.keyword in f" {text} ", (r, text)
            rows.append((r.rule, text))
    df = spark.createDataFrame(rows, "rule int, text string")
    assert df.filter(~module.gate(module.F.col("text"))).collect() == []
    assert df.filter(~module.gate(module.F.upper(module.F.replace("text", module.F.lit(" "), module.F.lit(" - "))))).collect() == []


def test_hundreds_of_rules_are_written():
    from florilege.llm.license_rules import TEXTS, WRITTEN

    assert len(TEXTS) + len(WRITTEN.strip().splitlines()) > 220
