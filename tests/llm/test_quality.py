import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from florilege.llm.quality import BANDS, apply_rules, fitted_least, repeated_words, script_of, token_entropy

PATHS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json"), P.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    repeats = len(inside)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeats, len(words) < 50 or 100 * repeats > 50 * len(words))


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t ", "one two three", "a a a a", "<b> # * $ % & | >", "x\ny\nx\n\nx \nx", "long " * 3000]
    for _ in range(60):
        out.append(" ".join(rng.choice(["sun", "moon", "über", "día", "été", "rain\n", "x", "the"]) for _ in range(rng.randrange(200))))
    return out


def test_base_counts_and_rows(spark):
    rows = [(i, t, None if i % 3 else "en", "clash") for i, t in enumerate(texts())] + [(7, "again", "zz", ""), (7, "again", "zz", ""), (None, "x", None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    got = apply_rules(df, *PATHS).collect()
    key = lambda r: str(r)
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], key=key) == sorted([(i, *base(t)) for i, t, _, _ in rows], key=key)
    assert not any(r.kept for r in got if r.base_failed)


def test_measures_equal_direct_ones(spark):
    text = " ".join(f"meadow river{i % 17} stone" for i in range(40))
    got = apply_rules(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), *PATHS).collect()[0]
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[0])
    ids = model.encode(text)
    counts = Counter(ids)
    entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())
    assert math.isclose(got.chars_per_piece, len(text.replace(" ", "")) / len(ids))
    assert math.isclose(got.entropy_share, entropy / math.log2(len(ids)))
    assert got.fallback_share == sum(map(model.is_byte, ids)) / len(ids)


def test_verdict(spark):
    rng = random.Random(1)
    words = "the of and water people year work house school country place question number group problem hand part case week company system program".split()
    good = " ".join(rng.choice(words) for _ in range(300))
    noise = " ".join("".join(rng.choice("qxzjkvw#%0189") for _ in range(12)) for _ in range(200))
    emoji = " ".join("".join(chr(rng.randrange(0x12000, 0x12300)) for _ in range(6)) for _ in range(200))
    df = spark.createDataFrame([(1, good, "en"), (2, noise, "en"), (3, emoji, "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.kept for r in apply_rules(df, *PATHS).collect()} == {1: True, 2: False, 3: False}


def test_helpers():
    assert script_of("мир") == "Cyrillic" and script_of("漢字かな") == "Kana" and script_of("12 34") == "other" and script_of("été") == "Latin"
    assert repeated_words(np.array([1, 2, 3, 1, 2, 3, 1, 2, 3]), np.array([6, 3])).tolist() == [6, 0]
    assert token_entropy(np.array([4, 4, 5, 5, 9]), np.array([4, 0, 1])).tolist() == [1.0, 0.0, 0.0]


def test_empty_table(spark):
    assert apply_rules(spark.createDataFrame([], "doc_id long, text string, lang string"), *PATHS).collect() == []


LABELLED = "/root/testdata/sf0.1"


@pytest.mark.skipif(not Path(LABELLED).exists(), reason="test tables are not here")
def test_bands_are_fitted(spark):
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet").join(spark.read.parquet(f"{LABELLED}/labels.parquet"), "doc_id")
    judged = apply_rules(docs, *PATHS, carry=("lang", "quality")).cache()
    found = fitted_least(judged)
    assert {k: x[:2] for k, x in found.items()} == {k: (BANDS[k].piece_chars[0], BANDS[k].byte_chars[0]) for k in ("de", "en", "es", "fr")}
    assert all(found[k][2] == BANDS[k].entropy_least for k in ("de", "es", "fr")) and BANDS["en"].entropy_least <= found["en"][2]
    n = Counter((r.lang, r.quality, r.kept) for r in judged.collect() if not r.base_failed)
    assert 4 * n["en", 0, True] < n["en", 0, False]
    assert all(n[k, 1, False] <= 0.01 * n[k, 1, True] for k in found)


def test_many_different_words():
    numbers = np.array([1, 2, 2**21 + 3, 11, 12, 13, 1, 3, 3])
    assert repeated_words(numbers, np.array([9])).tolist() == [0]
    assert repeated_words(np.array([2**22, 2**23, 2**24] * 2), np.array([6])).tolist() == [6]


def second_verdict(text, lang, library, model):
    """Base rule and bands, measured word by word with the public libraries."""
    found = base(text)
    if found[5]:
        return False
    words = WORD.findall(text)
    ids = [i for w in words for i in model.encode(w)]
    byte_tokens = sum(len(library.encode(" " + w, add_special_tokens=False).ids) for w in words)
    entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in Counter(ids).values())
    b = BANDS.get(lang) or BANDS[script_of(text)]
    fallback = sum(map(model.is_byte, ids)) / len(ids)
    inside = lambda x, bounds: bounds[0] <= x <= bounds[1]
    return inside(found[1] / len(ids), b.piece_chars) and inside(found[1] / byte_tokens, b.byte_chars) and fallback <= b.fallback_most and entropy / math.log2(len(ids)) >= b.entropy_least


def test_verdicts_equal_a_second_implementation(spark):
    rng = random.Random(8)
    kinds = ["sun moon river stone the of and house water".split(), "qx#%zj kkq7w zzx0 #### $$$".split(), "été où château rivière jour".split(), "мир вода дом река".split(), "水 山 家 日".split(), ["".join(chr(rng.randrange(97, 123)) for _ in range(9)) for _ in range(80)]]
    rows = []
    for i in range(160):
        mixed = rng.sample(kinds, rng.choice([1, 1, 2]))
        rows.append((i, " ".join(rng.choice(rng.choice(mixed)) + rng.choice(["", "", "s", ",", str(rng.randrange(999))]) for _ in range(rng.choice([30, 60, 200]))), rng.choice(["en", "de", "fr", "es", None, "zz"])))
    if Path("/root/testdata/sf0.001").exists():
        rows += [(1000 + r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    library, model = Tokenizer.from_file(PATHS[1]), sentencepiece.SentencePieceProcessor(model_file=PATHS[0])
    got = {r.doc_id: r.kept for r in apply_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), *PATHS).collect()}
    want = {i: second_verdict(t, lang, library, model) for i, t, lang in rows}
    assert got == want and 0.1 < sum(want.values()) / len(want) < 0.9


def test_carried_names_that_clash(spark):
    got = apply_rules(spark.createDataFrame([(1, "a b", "en", 5)], "doc_id long, text string, lang string, n_words long"), *PATHS, carry=("n_words", "text")).collect()[0]
    assert got.n_words == 2 and got.n_words_of_docs == 5 and got.text == "a b"
