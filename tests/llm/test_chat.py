import hashlib
import random
from collections import defaultdict

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from florilege.llm.chat import digests, format_conversations, format_turn, read_turns

PATHS = P.path("byte_bpe_50k.json"), P.PATTERN
ODD = ["\\### Assistant: </turn> ok", "<turn user>", "\\<turn", "\\\\", "</turn>\n", "", "a\\", "<|endoftext|>", "é<b>\n"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        size = sum(len(format_turn(r, t)[0]) for _, _, r, t in turns)
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(learned), sha(learned), size))
    return sorted(out, key=str)


def case(n):
    rng = random.Random(3)
    rows = []
    for c in range(n):
        first = rng.choice(["hello", "hello", "you are kind", f"own {c}"])
        rows.append((c, 0, "system" if c % 3 else "user", first))
        for k in range(1, rng.randrange(1, 6)):
            rows.append((c, k, rng.choice(["user", "assistant"]), rng.choice([*ODD, f"say {rng.randrange(4)}"])))
    rows += [(900, None, None, None), (900, 1, "assistant", None), (901, 1, "b", "tie"), (901, 1, "a", "tie"), (901, 1, "a", "tie"), (None, 0, "user", "no id"), (-7, 0, "user", ODD[0]), (-7, 1, "assistant", ODD[0])]
    return rows


@pytest.mark.parametrize("limit", [4, 128])
def test_digests_equal_brute_force(spark, limit):
    rows = case(120)
    df = spark.createDataFrame([(*r, b"clash") for r in rows], "conv_id long, turn long, role string, text string, leaf binary")
    assert sorted(map(tuple, digests(df, *PATHS, limit=limit).collect()), key=str) == brute(rows)


def test_trees(spark):
    df = spark.createDataFrame(case(120), "conv_id long, turn long, role string, text string")
    trees, members = format_conversations(df, *PATHS, limit=8)
    library = Tokenizer.from_file(PATHS[0])
    rows = trees.collect()
    assert sum(len(t.leaves) for t in rows) == members.select("leaf").distinct().count()
    assert max(len(t.leaves) for t in rows) < 40
    named = {t.tree: t for t in rows}
    assert len(named) == len(rows) and any(t.above for t in rows)
    turns = set()
    for t in rows:
        above = [named[x] for x in t.above]
        assert all(len(x.nodes) == 1 and x.above == t.above[:k] for k, x in enumerate(above)) and t.base == sum(len(x.ids) for x in above)
        prefix = "".join(x.text for x in above)
        assert len(t.ids) == len(t.position_ids) == t.nodes[-1].end and len(t.text) == t.nodes[-1].char_end
        for n in t.nodes:
            assert t.ids[n.start : n.end] == library.encode(t.text[n.char_start : n.char_end], add_special_tokens=False).ids
            path, at = [], n
            while True:
                path.append(at)
                if at.parent < 0:
                    break
                at = t.nodes[at.parent]
            seen = [i for span in n.attend for i in range(span.start, span.end)]
            assert seen == sorted(i for p in path for i in range(p.start, p.end))
            assert [t.position_ids[i] for i in seen] == list(range(t.base, t.base + len(seen)))
            whole = prefix + "".join(t.text[p.char_start : p.char_end] for p in reversed(path))
            assert whole not in turns  # each shared turn is written once, over all rows
            turns.add(whole)


def test_common_first_turn_is_written_once(spark):
    rows = [(c, 0, "system", "the system prompt of all") for c in range(900)] + [(c, 1, "user", f"question {c % 600}") for c in range(900)] + [(c, 2, "assistant", "x " * (c % 7)) for c in range(600)]
    rows += [(5000, 0, "system", "the system prompt of all")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    trees, _ = format_conversations(df, *PATHS, limit=16)
    assert sum(t.text.count("the system prompt of all") for t in trees.collect()) == 1
    assert sorted(map(tuple, digests(df, *PATHS, limit=16).collect()), key=str) == brute(rows)


def test_very_long_texts_and_conversations(spark):
    rows = [(1, 0, "user", "long \\ <turn " * 60_000), (1, 1, "assistant", "é" * 400_000)] + [(2, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, digests(df, *PATHS).collect()), key=str) == brute(rows)


def test_escapes():
    for role in ["user", "a>b", "\\", "<"]:
        for text in ODD:
            whole, a, b = format_turn(role, text)
            assert read_turns(whole + whole) == [(role, text)] * 2
    with pytest.raises(ValueError):
        read_turns("<turn a>b")


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), *PATHS).collect() == []
