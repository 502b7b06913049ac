import random
import sys
from pathlib import Path

import public_tokenizers as P
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline
from test_decontaminate import brute as contaminated
from test_near import brute as near
from test_quality import base


def corpus():
    rng = random.Random(6)
    words = "the of and water people year work house school country place question number group problem hand part case week company system program".split()
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    rows = []
    for i in range(60):
        rows.append((len(rows), text(rng.choice([20, 80, 300])), "en"))
    for i in range(0, 60, 7):
        rows.append((len(rows), rows[i][1], "en"))
        rows.append((len(rows), rows[i][1] + " extra", "en"))
    for i in range(5):
        rows.append((len(rows), text(100) + " " + items[i][1] + " " + text(100), "en"))
    rows += [(len(rows), None, "en"), (len(rows) + 1, "again " * 200, "en"), (len(rows) + 2, "qx#%zj7w " * 99 + "k", None), (3, rows[3][1], "en")]
    return rows, items


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, kept int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        frames.append(spark.read.parquet(f"{tmp_path}/{k}"))
    for frame in frames[1:4]:
        assert tuple(frame.columns) == corpus_pipeline.COLUMNS
    sets = [[(r.doc_id, r.text) for r in f.select("doc_id", "text").collect()] for f in frames[:4]]
    key = lambda x: str(x)
    good = [(i, t) for i, t in sets[0] if not base(t)[5]]
    assert set(sets[1]) == {x for x in good if not (x[1] or "").startswith("qx#")} and len(sets[1]) == len(good) - len(set(good) - set(sets[1]))
    least = {r[0]: r[1] for r in near(sets[1])}
    assert sorted(sets[2], key=key) == sorted({(i, t) for i, t in sets[1] if least[i] == i}, key=key)
    hit = {r[0] for r in contaminated(sets[2], items) if r[5]}
    assert hit and sorted(sets[3], key=key) == sorted([(i, t) for i, t in sets[2] if i not in hit], key=key)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    packed = frames[4].groupBy("doc_id").sum("length").collect()
    assert sorted((r[0], r[1]) for r in packed) == sorted((i, len(library.encode(t, add_special_tokens=False).ids) + 1) for i, t in sets[3])
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == frames[4].columns and got.groupBy().sum("length").first()[0] == frames[4].groupBy().sum("length").first()[0]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
