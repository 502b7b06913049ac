"""Phrases in texts, addresses and records against loops and literal cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from florilege.functions import text as tx
from florilege.operators import phrases
from florilege.sources import readers


def brute(texts, given):
    out = []
    for key, text in texts:
        found = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", (text or "").lower())]
        for phrase, said, surface, anchored in given:
            p = re.findall(r"[^\W\d_]+", ((surface or "").strip() or said).lower())
            for k in range(len(found) - len(p) + 1 if p else 0):
                if [x[0] for x in found[k : k + len(p)]] == p and not (anchored and text[: found[k][1]].strip()):
                    out.append((key, phrase, k, len(p), found[k][1], found[k + len(p) - 1][2]))
    return sorted(out)


@pytest.mark.parametrize("most", [phrases.MOST_WORDS, 0])
def test_spans_against_a_loop(spark, monkeypatch, most):
    monkeypatch.setattr(phrases, "MOST_WORDS", most)
    r = random.Random(7)
    vocabulary = "a b c d actus essendi per se é".split()
    given = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 5))), r.choice([None, None, " ", r.choice(vocabulary) + " " + r.choice(vocabulary)]), r.random() < 0.3) for k in range(60)] + [(61, "?!", None, False), (62, "a a a", None, False), (63, "a a a", None, True)]
    texts = [(k, r.choice(["", " ", "\n\t", "«"]) + "".join(r.choice(vocabulary).title() + r.choice([" ", ", ", "  ", "-"]) for _ in range(r.randrange(0, 60)))) for k in range(60)] + [(70, None), (71, ""), (72, "A " * 3000), (73, "word " * 200_000 + "per se")]
    df = spark.createDataFrame([(*t, "clash") for t in texts], "segment_id long, content string, phrase_id string")
    got = phrases.phrase_spans(df, spark.createDataFrame(given, "phrase_id long, phrase string, surface string, anchored boolean"))
    assert sorted(map(tuple, got.collect())) == brute(texts, given)


def test_anchored_formulas_and_surfaces(spark):
    given = spark.createDataFrame([(1, "respondeo", "Respondeo dicendum", True), (2, "sed_contra", "Sed contra", False), (3, "per se", None, False)], "phrase_id long, phrase string, surface string, anchored boolean")
    texts = [(1, "Respondeo dicendum quod"), (2, "Ideo Respondeo dicendum quod"), (3, "Sed contra est"), (4, "sed_contra is a slug"), (5, "Movetur per se."), (6, " \n respondeo  dicendum")]
    got = phrases.phrase_spans(spark.createDataFrame(texts, "segment_id long, content string"), given)
    assert sorted((r.segment_id, r.phrase_id) for r in got.collect()) == [(1, 1), (3, 2), (5, 3), (6, 1)]


def test_no_texts_and_no_phrases(spark):
    texts = spark.createDataFrame([(1, "a b")], "segment_id long, content string")
    none = spark.createDataFrame([], "phrase_id long, phrase string")
    assert not phrases.phrase_spans(texts, none).collect()
    assert not phrases.phrase_spans(texts.limit(0), spark.createDataFrame([(1, "a")], "phrase_id long, phrase string")).collect()


def test_masks_cut_by_offsets(spark):
    texts = spark.createDataFrame([(1, "Actus, essendi et essendi per"), (2, "none"), (3, None), (4, "essendi actus essendi")], "segment_id long, content string")
    given = spark.createDataFrame([(1, "actus essendi"), (2, "essendi"), (3, "essendi actus")], "phrase_id long, phrase string")
    got = phrases.masked(texts, phrases.phrase_spans(texts, given))
    assert sorted(map(tuple, got.select("segment_id", "content").collect()), key=str) == [(1, "  et   per"), (2, "none"), (3, None), (4, " ")]


def test_splitting_counts_depth(spark):
    cases = {"a, b": ["a", "b"], "a (b, c), d": ["a (b, c)", "d"], "a (b, (c, d), e), f": ["a (b, (c, d), e)", "f"], "a (b, c": ["a (b, c"], "a), b": ["a)", "b"], "a), (b, c), d": ["a)", "(b, c)", "d"], "": [""], ",": ["", ""], "((a,b)": ["((a,b)"]}
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", tx.outside_parentheses(F.col("x")).alias("p"))
    assert {r.x: r.p for r in df.collect()} == cases
    assert spark.range(1).select(tx.outside_parentheses(F.lit(None).cast("string")).alias("p")).first().p is None


def test_titles_and_coordinates(spark):
    titles = {
        "I q. 1 a. 2 arg. 3": ("I.q1.a2.arg3", "arg"), " II-II  q. 10 a. 1 s. c. ": ("II_II.q10.a1.sed_contra", "sed_contra"), "I q. 1 a. 1 s. c. 2": ("I.q1.a1.sed_contra", "sed_contra"), "III q. 4 pr.": ("III.q4.preamble", "preamble"),
        "I-II q. 1 a. 1 co.": ("I_II.q1.a1.respondeo", "respondeo"), "I q. 1 a. 1 ad 2": ("I.q1.a1.reply2", "reply"), "I q. 1 a. 1 ad arg.": ("I.q1.a1.reply0", "reply"),
        "I q. 1 a. 1 arg.": None, "I q. 1 a. 1": None, "IV q. 1 a. 1 co.": None, "I q. 1 a. 1 pr.": None, "I q. 1 co.": None, "I q. 1 a. 1 co. 4": None, "I q. 1 a. 1 ad": None, "": None, "I q. 1 a. 1 co. x": None,
    }
    df = spark.createDataFrame([(k,) for k in titles], "t string").select("t", readers.parse_locator(F.col("t")).alias("l"))
    assert {r.t: tuple(r.l) if r.l else None for r in df.collect()} == titles
    lines = {"I ot. 1 čl. 2 arg. 3 Zdá se": "I.q1.a2.arg3", "II-II ot. 3 čl. 1 protiarg. Proti": "II_II.q3.a1.sed_contra", "I ot. 1 čl. 2 odp. 5 text": "I.q1.a2.respondeo", "I ot. 1 čl. 2 k 4": "I.q1.a2.reply4", "III ot. 2 pr. text": "III.q2.preamble", "I ot. 1 čl. 2 k tomu": None, "I ot. 1 čl. 2": None, "x": None, "I ot. 1 čl. 2 pr.": None}
    df = spark.createDataFrame([(k,) for k in lines], "t string").select("t", readers.parse_coordinate(F.col("t")).alias("l"))
    assert {r.t: r.l for r in df.collect()} == lines


def test_a_broken_line_names_its_place_in_files_of_several_splits(spark, tmp_path):
    good = [f'{{"segment_id": {k}, "n": {k}}}' if k % 7 else "" for k in range(300)]
    (tmp_path / "a.jsonl").write_text("\n".join(good) + "\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        assert sorted(r.n for r in readers.jsonl(spark, str(tmp_path), "segment_id long, n int", ["segment_id"]).collect()) == [k for k in range(300) if k % 7]
        for line, said in ((1, "not json"), (201, '{"segment_id": 1'), (300, "[1]")):
            bad = list(good)
            bad[line - 1] = said
            (tmp_path / "b.jsonl").write_text("\n".join(bad) + "\n")
            with pytest.raises(Exception, match=rf"b\.jsonl, line {line}: "):
                readers.jsonl(spark, str(tmp_path), "segment_id long, n int", ["segment_id"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])


def test_casefold_is_that_of_unicode(spark):
    texts = ["Straße", "ΣΊΣΥΦΟΣ ς", "ﬁnal ﬂow", "ŉ", "plain Text", "", "İ"[:0], "µ ſ", "ẞ", "Ǆ ǆ"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert {r.x: r.y for r in df.select("x", tx.casefold(F.col("x")).alias("y")).collect()} == {t: t.casefold() for t in texts}
    assert spark.range(1).select(tx.casefold(F.lit(None).cast("string")).alias("y")).first().y is None


def test_entries_of_a_models_answer(spark):
    cases = {
        '```json\n{"a": {"slovak": " x ", "category": " Term "}, "b": "y", "made up": "z"}\n```': {"a": ("term", "x"), "b": (None, "y")},
        '{"a": {"slovak": "x", "category": "odd"}, "b": {"category": "term"}, "c": {"slovak": "  "}}': {"a": (None, "x")}, '{"a": null, "b": "  "}': {}, "[1]": None, "no": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r.x: r.y and {k: tuple(v) for k, v in r.y.items()} if r.y is not None else None for r in df.select("x", tx.model_entries(F.col("x"), F.array(*map(F.lit, "abc"))).alias("y")).collect()}
    assert got == cases
