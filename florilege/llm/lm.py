"""Document scores by prediction by partial matching (PPM), trained on the corpus.

The model is a byte trie of contexts of up to ``ORDER`` bytes with exact counts
over all training texts.  A text is its bytes (A-Z lower-cased) and one end
symbol, 0xFF, which UTF-8 never holds; before it stand ``ORDER`` zero bytes, so
that each symbol has a full context.  In the longest context seen, a symbol
seen there n times of T, among q different ones, has probability n / (T + q);
else the model escapes with q / (T + q) to the context that is a byte shorter
and leaves out the symbols just excluded, down to equal chances for what is
left of 256 symbols.  As every context counts all its text, the symbols of a
context are among those of its suffix; what exclusion takes away thus depends
on the longer context alone, and the log probability of a symbol is a function
of the last ``ORDER + 1`` bytes: one row of a table for each such gram that the
corpus holds.

Texts are dealt by a hash of id and text into chunks of about ``CHUNK`` bytes.
Rows that repeat, id and all, would meet in one chunk: where they hold more
than a quarter of a chunk, one row stands for up to ``COPIES`` of them, with
their number as its weight.  A chunk gives its distinct grams and words with
their training counts; these are summed over the corpus, the gram table is
computed by joins that follow the trie from the longest contexts to the
shortest, and each chunk gets back the rows it asked for by one join, which
adaptive execution may split where a word or gram is in very many chunks.
Nothing is broadcast but the two shortest levels (256 and 65,536 contexts at
most) and a list of repeated rows of checked size, and a task holds one chunk.

Words are told apart by 64-bit hashes; the end of a text is a word of its own.
A null text is empty: one end token.  Rows with a null id are training rows.
An empty table gives no rows; without training texts all symbols are equal.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.llm.shared import give_back, materialize, materialize_table
from florilege.llm.words import Numbering, slices

ORDER = 4
CHUNK = 10 << 20
SLICE = 1 << 20
COPIES, LISTED = 100_000, 100_000
WORD, GRAM = 0, 1


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _lowered(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8").lower() for t in texts]


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all texts, flat, and how many each has (its bytes and the end)."""
    a = np.frombuffer(b"".join(b"\0" * ORDER + t + b"\xff" for t in texts), np.uint8).astype(np.uint64)
    n = len(a) - ORDER
    keys = a[:n].copy()
    for k in range(1, ORDER + 1):
        keys <<= np.uint64(8)
        keys |= a[k : n + k]
    per_text = np.fromiter((len(t) + 1 for t in texts), np.int64, count=len(texts))
    keep = np.ones(n, bool)
    for k in range(ORDER):  # grams that reach into the next text
        keep[np.cumsum(per_text + ORDER)[:-1] - 1 - k] = False
    return keys[keep], per_text


def _hash(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count=len(words)).view(np.int64)


def _features(t: pa.Table) -> pa.Table:
    """kind, key, n (count in training texts) of the distinct words and grams of one chunk."""
    index, counts = Numbering(), np.zeros(0, np.int64)
    grams: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in t.to_batches():
        for part in slices(batch, batch.schema.get_field_index("text"), SLICE):
            texts = _lowered(part.column("text").to_pylist())
            weights = np.array([0 if x else m for x, m in zip(part.column("held").to_pylist(), part.column("m").to_pylist())])
            flat: list[bytes] = []
            per_text = []
            for x in texts:
                ws = x.split()
                flat += ws
                flat.append(b"")
                per_text.append(len(ws) + 1)
            numbers = index.numbers(flat)
            counts = np.concatenate([counts, np.zeros(len(index) - len(counts), np.int64)])
            for weight in np.unique(weights).tolist():
                own = weights == weight
                counts += weight * np.bincount(numbers[np.repeat(own, per_text)], minlength=len(index))
                keys = np.sort(_grams([x for x, keep in zip(texts, own) if keep])[0])
                at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                grams.append((keys[at], weight * np.diff(np.concatenate([at, [len(keys)]]))))
    keys, inverse = np.unique(np.concatenate([k for k, _ in grams]), return_inverse=True)
    n = np.bincount(inverse, weights=np.concatenate([c for _, c in grams]), minlength=len(keys)).astype(np.int64)
    words = _hash(list(index))
    del grams, index
    give_back()
    kinds = np.concatenate([np.full(len(words), WORD, np.int8), np.full(len(keys), GRAM, np.int8)])
    chunk = pa.array(np.full(len(kinds), t.column("chunk")[0].as_py(), np.int32))
    return pa.table([chunk, pa.array(kinds), pa.array(np.concatenate([words, keys.view(np.int64)])), pa.array(np.concatenate([counts, n]))], names=["chunk", "kind", "key", "n"])


def _score(docs: pa.Table, model: pa.Table) -> pa.Table:
    """id, held, m, n_tokens, n_known, logs (sum of log10(count + 1)), score of the texts of one chunk."""
    kind, key, value = (model.column(c).to_numpy() for c in ("kind", "key", "value"))

    def lookup(which: int, dtype) -> tuple[np.ndarray, np.ndarray]:
        keys, values = key[kind == which].view(dtype), value[kind == which]
        order = np.argsort(keys)
        return keys[order], values[order]

    word_keys, word_counts = lookup(WORD, np.int64)
    gram_keys, gram_logs = lookup(GRAM, np.uint64)
    index, known = Numbering(), np.zeros(0)
    out: list[list] = []
    for batch in docs.to_batches():
        for part in slices(batch, batch.schema.get_field_index("text"), SLICE):
            texts = _lowered(part.column("text").to_pylist())
            flat: list[bytes] = []
            per_text = []
            for x in texts:
                ws = x.split()
                flat += ws
                flat.append(b"")
                per_text.append(len(ws) + 1)
            numbers = index.numbers(flat)
            if fresh := index.take():
                known = np.concatenate([known, word_counts[np.searchsorted(word_keys, _hash(fresh))]])
            c = known[numbers]
            begin = np.cumsum(per_text) - per_text
            logs = np.add.reduceat(np.log10(c + 1), begin)
            n_known = np.add.reduceat((c > 0).astype(np.int64), begin)
            scores = np.zeros(len(texts))
            for at, to in _runs(texts):
                grams, n = _grams(texts[at:to])
                packed = np.sort(grams << np.uint64(24) | np.arange(len(grams), dtype=np.uint64)) if len(grams) < 1 << 24 else None
                if packed is None:  # one very long text
                    logp = gram_logs[np.searchsorted(gram_keys, grams)]
                else:
                    own = packed >> np.uint64(24)
                    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    found = gram_logs[np.searchsorted(gram_keys, own[first])]
                    logp = np.empty(len(grams))
                    logp[(packed & np.uint64((1 << 24) - 1)).astype(np.int64)] = np.repeat(found, np.diff(np.concatenate([first, [len(own)]])))
                scores[at:to] = np.add.reduceat(logp, np.cumsum(n) - n)
            out.append([part.column("id"), part.column("held"), part.column("m"), pa.array(np.array(per_text, np.int64)), pa.array(n_known), pa.array(logs), pa.array(scores)])
    del index, known, word_keys, gram_keys
    give_back()
    return pa.Table.from_batches([pa.RecordBatch.from_arrays(x, names=["id", "held", "m", "n_tokens", "n_known", "logs", "score"]) for x in out])


def _runs(texts: list[bytes]) -> list[tuple[int, int]]:
    """Runs of texts of 8 MB at most, or of one longer text."""
    out, at, size = [], 0, 0
    for i, x in enumerate(texts):
        if i > at and size + len(x) > 8 << 20:
            out.append((at, i))
            at, size = i, 0
        size += len(x) + ORDER + 1
    return [*out, (at, len(texts))] if texts else []


def _suffix(bytes_: int) -> Column:
    return F.col("key").bitwiseAND(F.lit((1 << 8 * bytes_) - 1))


def gram_table(grams: DataFrame) -> DataFrame:
    """key, value: log10 probability of the last byte of each gram, from key, n (its count in training texts)."""
    counts: dict[int, DataFrame] = {ORDER: grams.filter("n > 0")}
    for k in range(ORDER - 1, -1, -1):
        counts[k] = materialize(counts[k + 1].groupBy(_suffix(k + 1).alias("key")).agg(F.sum("n").alias("n")))
    context = F.shiftright("key", 8)
    nodes: dict[int, DataFrame] = {}
    for k in range(ORDER + 1):
        nodes[k] = counts[k].groupBy(context.alias("context")).agg(F.sum("n").alias("t"), F.count("*").alias("q"))
        if k:  # what the context's symbols count for in its suffix
            shorter = counts[k - 1].select(F.col("key").alias("short"), F.col("n").alias("m"))
            shorter = F.broadcast(shorter) if k == 1 else shorter
            taken = counts[k].withColumn("short", _suffix(k)).join(shorter, "short").groupBy(context.alias("context")).agg(F.sum("m").alias("e"))
            nodes[k] = nodes[k].join(taken, "context")
        else:
            nodes[k] = nodes[k].withColumn("e", F.lit(0).cast("bigint"))
    seen = counts[ORDER].withColumn("context", context).join(nodes[ORDER], "context").select("key", F.log10(F.col("n") / (F.col("t") + F.col("q"))).alias("value"))
    # unseen: gram, value so far, and the mass and number of symbols excluded
    rest = grams.filter("n = 0").select("key", F.lit(0.0).alias("value"), F.lit(0).cast("bigint").alias("xe"), F.lit(0).cast("bigint").alias("xq"))
    done = [seen]
    for k in range(ORDER, -1, -1):
        own = nodes[k].select("context", "t", "q", "e")
        own = F.broadcast(own) if k < 2 else own
        here = rest.withColumn("context", F.shiftright(_suffix(k + 1), 8)).join(own, "context", "left")
        t, q = F.coalesce("t", F.lit(0)) - F.col("xe"), F.coalesce("q", F.lit(0)) - F.col("xq")
        if k < ORDER:
            n = counts[k].select(F.col("key").alias("short"), "n")
            n = F.broadcast(n) if k == 0 else n
            here = here.withColumn("short", _suffix(k + 1)).join(n, "short", "left")
            done.append(here.filter("n is not null").select("key", (F.col("value") + F.log10(F.col("n") / (t + q))).alias("value")))
            here = here.filter("n is null")
        escape = F.when(q > 0, F.log10(q / (t + q))).otherwise(F.lit(0.0))
        exists = F.col("t").isNotNull()
        rest = here.select(
            "key",
            F.when(exists, F.col("value") + escape).otherwise(F.col("value")).alias("value"),
            F.when(exists, F.col("e")).otherwise(F.col("xe")).alias("xe"),
            F.when(exists, F.col("q")).otherwise(F.col("xq")).alias("xq"),
        )
        rest = materialize(rest) if k in (ORDER, 2) else rest
    done.append(rest.select("key", (F.col("value") - F.log10(256 - F.col("xq"))).alias("value")))
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    return out


def _dealt(docs: DataFrame, held: Column, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """chunk, id, text, held, m: one row for each of ``docs``, or for ``m`` equal ones."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held"), F.xxhash64(id_col, text_col).alias("h"))
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count("*")
    per_row = rows.groupBy("h").agg(size.alias("b"), F.count("*").alias("n"))
    found = per_row.agg(F.sum("b"), F.sum((_many(chunk_bytes)).cast("bigint"))).first()
    chunks = max(1, math.ceil((found[0] or 0) / chunk_bytes))
    deal = lambda *key: F.pmod(F.xxhash64(*key), F.lit(chunks)).cast("int").alias("chunk")
    if not found[1]:
        return rows.select(deal("h"), "id", "text", "held", F.lit(1).alias("m"))
    many = materialize(per_row.filter(_many(chunk_bytes)).select("h", "n"))
    many = F.broadcast(many) if found[1] <= LISTED else many
    single = rows.join(many, "h", "left_anti").select(deal("h"), "id", "text", "held", F.lit(1).alias("m"))
    one = rows.join(many.select("h"), "h", "left_semi").groupBy("h").agg(*(F.first(c).alias(c) for c in ("id", "text", "held")))
    part = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / COPIES) - 1)).alias("part")
    one = one.join(many, "h").select("*", part)
    return single.union(one.select(deal("h", "part"), "id", "text", "held", F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES).cast("int").alias("m")))


def _many(chunk_bytes: int) -> Column:
    return (F.col("b") > chunk_bytes // 4) & (F.col("n") > 1)


def score_documents(docs: DataFrame, held: Column | None = None, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``."""
    dealt = _dealt(docs, held_out(F.col(id_col)) if held is None else held, id_col, text_col, chunk_bytes)
    features = materialize_table(dealt.select("chunk", "text", "held", "m").groupBy("chunk").applyInArrow(_features, "chunk int, kind tinyint, key bigint, n bigint"))
    words, grams = features.filter(F.col("kind") == WORD), features.filter(F.col("kind") == GRAM)
    counts = materialize(words.groupBy("key").agg(F.sum("n").alias("n")))
    train, distinct = counts.filter("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    logs = gram_table(materialize(grams.groupBy("key").agg(F.sum("n").alias("n"))))
    model = counts.select(F.lit(WORD).cast("tinyint").alias("kind"), "key", F.col("n").cast("double").alias("value"))
    model = materialize(model.union(logs.select(F.lit(GRAM).cast("tinyint"), "key", "value")))
    asked = features.select("chunk", "kind", "key").join(model, ["kind", "key"]).select("chunk", "kind", "key", "value")
    kind = docs.schema[id_col].dataType.simpleString()
    scored = dealt.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(
        _score, f"id {kind}, held boolean, m int, n_tokens bigint, n_known bigint, logs double, score double"
    )
    scored = scored.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("m"))))
    return scored.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train).cast("bigint").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(train + distinct + 1)))).alias("base_score"),
        "score",
    )
