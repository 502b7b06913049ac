"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words,
but not none, is one window.  A document word inside any occurrence of a window
is hit.

Words are ordered by rarity: by their count over all documents, then by
themselves.  To hold a window a document must hold its rarest word, so that
word alone is the window's necessary prefix.  Windows of an item that share a
rarest word, at one place of the item, share an anchor: the word and the words
up to ``WINDOW - 1`` to its left and right.  Document words are joined with
anchors on the word; the length bound (a document has room for the window) and
the positional bound (room on both sides of this place) drop what cannot fit;
the words beside it are then compared exactly, giving the longest run of item
words around the place.  A run of at least a window's length is a hit of all
its words, as each of them lies in a window that occurs.

Where the anchors are of a checked size, they are broadcast to the segments of
the texts.  Beyond it, words are shuffled with the hashes of their neighbours
alone, once for each different text; the words of a segment are fetched for
places where a neighbour fits, and compared there.

Hits belong to texts, by a hash of the whole text, so that copies share them
and no document is gathered anywhere; rows without words get a key of their
own, so that they don't meet anywhere either.  Null and wordless texts have no words
and no hits; null items and items without words have no windows; an item
without id can hit but is not listed; item ids that repeat count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florilege.llm.shared import materialize, redealt
from florilege.llm.words import fold, lead, n_words, plain_words, raw_words, text_key

WINDOW = 10
#: Words of a text that are looked at together.
SEGMENT = 128
#: Anchors are broadcast only if their words hold at most this many bytes.
BROADCAST_BYTES = 32 << 20


def _run(eq: Column, most: Column) -> Column:
    """How many leading places of ``eq`` are true."""
    at = F.array_position(eq, False)
    return F.when(at == 0, most).otherwise(at - 1).cast("int")


def anchors(items: DataFrame, docs: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """word, item, need, left (nearest first), right of each anchor."""
    own = items.select(F.col(item_col).cast("string").alias("item"), plain_words(F.col(text_col)).alias("w")).filter("size(w) > 0")
    own = own.dropDuplicates()
    vocabulary = own.select(F.explode("w").alias("word")).distinct()
    counts = docs.select(F.explode(raw_words(F.col(text_col))).alias("word")).select(fold(F.col("word")).alias("word"))
    if _fits(vocabulary, F.octet_length("word")):
        counts = counts.join(F.broadcast(vocabulary), "word").groupBy("word").count()
    else:
        counts = counts.groupBy("word").count().join(vocabulary, "word")
    order = materialize(vocabulary.join(counts, "word", "left").select("word", F.coalesce("count", F.lit(0)).alias("n")))
    placed = own.select("item", "w", F.posexplode("w").alias("at", "word")).join(order, "word")
    size = F.size("w")
    last = F.greatest(F.lit(0), size - window)
    starts = F.sequence(F.greatest(F.lit(0), F.col("at") - (window - 1)), F.least("at", last))
    rarest = placed.select("item", "w", F.explode(starts).alias("start"), F.struct("n", "word", "at").alias("p"))
    rarest = rarest.groupBy("item", "w", "start").agg(F.min("p").alias("p")).select("item", "w", "p.word", "p.at").distinct()
    at = F.col("at")
    left = F.reverse(F.slice("w", F.greatest(F.lit(1), at - (window - 2)), F.least(at, F.lit(window - 1))))
    return rarest.select("word", "item", F.least(size, F.lit(window)).alias("need"), left.alias("left"), F.slice("w", at + 2, window - 1).alias("right"))


def _fits(df: DataFrame, size: Column) -> bool:
    """Whether ``df`` is small enough to be broadcast, by its measured size."""
    return df.agg(F.coalesce(F.sum(size + 64), F.lit(0))).first()[0] <= BROADCAST_BYTES


def _met(texts: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """Segments with the places ``p`` where an anchor's word stands beside its neighbour: the join on hashes, for anchors of any number."""
    texts = materialize(texts.groupBy("key").agg(F.first("words").alias("words")))
    marks = materialize(marks.withColumn("anchor", F.monotonically_increasing_id()))
    segments = texts.select("key", n_words(F.col("words")).alias("n"), lead(F.col("words")).alias("lead"), F.explode(_segments("words", window)).alias("s")).select("key", "n", "lead", "s.*")
    h = lambda w: F.xxhash64(fold(w))
    words = F.col("words")
    beside = F.transform(words, lambda w, i: F.struct(h(w).alias("h"), h(F.get(words, i - 1)).alias("before"), h(F.get(words, i + 1)).alias("after")))
    places = segments.select("key", "core", "start", F.posexplode(beside).alias("p", "x")).filter((F.col("start") + F.col("p") >= F.col("core")) & (F.col("start") + F.col("p") < F.col("core") + SEGMENT))
    places = places.select("key", "core", "p", "x.h", F.col("x.before").alias("before"), F.col("x.after").alias("after"))
    narrow = marks.select("anchor", "need", F.xxhash64("word").alias("h"), F.xxhash64(F.get("left", F.lit(0))).alias("left_h"), F.xxhash64(F.get("right", F.lit(0))).alias("right_h"))
    fits = (F.col("need") == 1) | (F.col("before") == F.col("left_h")) | (F.col("after") == F.col("right_h"))
    places = places.join(narrow, "h").filter(fits).select("key", "core", "p", "anchor")
    return segments.join(places, ["key", "core"]).join(marks, "anchor").filter(fold(F.get("words", F.col("p"))) == F.col("word"))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """key, first, last (word places), item of each run of item words in a text."""
    marks = materialize(anchors(items, docs, window, item_col, text_col))
    size = F.octet_length("word") + F.size("left") * 16 + F.size("right") * 16 + F.octet_length(F.concat_ws("", "left", "right"))
    texts = docs.select(text_key(F.col(text_col)).alias("key"), raw_words(F.col(text_col)).alias("words"))
    if _fits(marks, size):
        parts = texts.select("key", n_words(F.col("words")).alias("n"), lead(F.col("words")).alias("lead"), F.explode(_segments("words", window)).alias("s"))
        found = parts.select("key", "n", "lead", "s.*", F.posexplode("s.words").alias("p", "raw")).withColumn("word", fold(F.col("raw"))).join(F.broadcast(marks), "word")
    else:
        found = _met(texts, marks, window)
    p, words = F.col("p"), F.col("words")
    place = F.col("start") + p
    found = found.filter((F.col("n") >= F.col("need")) & (place >= F.col("core")) & (place < F.col("core") + SEGMENT))
    beside = (fold(F.get(words, p + 1)) == F.get("right", F.lit(0))) | (fold(F.get(words, p - 1)) == F.get("left", F.lit(0)))
    found = found.filter((F.col("need") == 1) | beside)
    n_left, n_right = F.least(p, F.size("left")), F.least(F.size(words) - p - 1, F.size("right"))
    found = found.filter(n_left + n_right + 1 >= F.col("need"))
    same = lambda a, b: F.coalesce(a == fold(b), F.lit(False))
    before = F.reverse(F.slice(words, p - n_left + 1, n_left))
    run_left = _run(F.zip_with(F.slice("left", F.lit(1), n_left), before, same), n_left)
    run_right = _run(F.zip_with(F.slice("right", F.lit(1), n_right), F.slice(words, p + 2, n_right), same), n_right)
    found = found.select("key", (place - F.col("lead")).alias("at"), "item", "need", run_left.alias("l"), run_right.alias("r")).filter("l + r + 1 >= need")
    return found.select("key", (F.col("at") - F.col("l")).alias("first"), (F.col("at") + F.col("r")).alias("last"), "item")


def _segments(words: str, window: int) -> Column:
    """The words in runs of SEGMENT, each with ``window - 1`` more on both sides: a matched row carries this, not the text."""
    n, edge = F.size(words), window - 1

    def cut(core: Column) -> Column:
        start = F.greatest(F.lit(0), core - edge)
        return F.struct(core.alias("core"), start.alias("start"), F.slice(words, start + 1, F.least(n, core + SEGMENT + edge) - start).alias("words"))

    return F.transform(F.sequence(F.lit(0), n - 1, F.lit(SEGMENT)), cut)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated of each row of ``docs``, and the columns to ``carry``.

    A carried column whose name is one of the others' comes out as ``NAME_of_docs``.
    """
    spans = hits(docs, items, window, text_col, item_col)
    spans = spans.groupBy("key", "first", "last", "item").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("first", "last", "item").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("last").over(before), F.lit(-1))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, reach))
    per_text = spans.select("key", "item", fresh.alias("fresh")).groupBy("key").agg(F.sum("fresh").alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items"))
    carried = F.struct(*carry) if carry else F.struct(F.lit(0))
    rows = docs.select(F.col(id_col), carried.alias("carried"), n_words(raw_words(F.col(text_col))).cast("bigint").alias("n_words"), text_key(F.col(text_col), n_words(raw_words(F.col(text_col))) > 0).alias("key"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    taken = (id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return rows.join(redealt(per_text), "key", "left").select(
        id_col,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce(F.sha2(F.array_join("items", ",").cast("binary"), 256), none).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        *(F.col(f"carried.{c}").alias(f"{c}_of_docs" if c in taken else c) for c in carry),
    )
