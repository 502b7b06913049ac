import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from florilege.llm.bpe import Encoder
from florilege.llm.token_counts import count_tokens

ODD = [
    "", None, " ", "  ", "a  b", "a   b \n c", "a\n \n b", " \n", "x<|endoftext|>y <|endoftext|> z", "<|endoftext|>",
    "aaaaaaaaaaaaaaaaaaaaaaaaaa" * 50, "don't I'll 'S 's", " x  y\x1c z\x85q  \x1f w", "漢字かな交じり文 テスト", "½ ² Ⅷ १२",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def noise(n):
    rng = random.Random(1)
    letters = [chr(c) for c in [*range(0x3000), *range(0x1F300, 0x1F600)]]
    return ["".join(rng.choice(letters if rng.random() < 0.5 else " \n\tab'1<") for _ in range(200)) for _ in range(n)]


def test_encoder_equals_library(library):
    own = Encoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    texts = ODD + noise(200)
    ids, counts = own.encode(texts)
    at = 0
    for text, n in zip(texts, counts):
        assert ids[at : at + n].tolist() == library.encode(text or "", add_special_tokens=False).ids
        at += n


def test_counts_of_rows(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "a b", "x"), (3, "  ", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = count_tokens(df, P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    assert len(got) == len(rows)
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(df, P.path("byte_bpe_50k.json"), P.PATTERN).collect() == []
