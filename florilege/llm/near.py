"""Jaccard join of word shingles with Bayesian pruning of MinHash candidates.

Texts are lower-cased (A-Z) and cut into plain words; five words in a row are a
shingle (a shorter text with words is one shingle).  Texts of the same words
form a class, by a 128-bit hash of the words, and only one of them is compared.

1. Each text gets ``HASHES`` MinHash values; ``ROWS`` of them make a band.
   Classes that share a band are candidates.  At the threshold of 0.8 a pair
   shares none of the 48 bands with a chance of 5e-7.
2. Candidates that hang together, by stars to the smallest class of a bucket,
   form candidate groups.  A group of up to ``BLOCK`` classes goes to one task
   with others of its kind.  A larger one is compared bucket by bucket, each
   pair in the first band it shares, if the buckets' squares are less than the
   group's own (classes that hang together by chains), and else as a whole (so
   near that most pairs share a band).  What is over ``BLOCK`` classes is cut
   into blocks, and each pair of blocks is a task's unit, so that no task holds
   more than two blocks.
3. In a unit, pairs are compared ``STEP`` values at a time.  With m of n values
   equal and a uniform prior, the posterior probability of reaching the
   threshold is that of Bin(n + 1, threshold) <= m; pairs below ``TOLERANCE``
   are dropped, the rest are verified on the shingles themselves.

Texts without words (null, empty, only signs) are linked to nothing; they form
a class with texts that are equal to the letter, null being one of its own.
Repeated rows belong to one class; null ids are kept, and join nothing: a
class's text is found by the mark of one of its rows, a hash of id and text.
An empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.llm.components import components
from florilege.llm.shared import forget_shuffles, held, materialize, redealt
from florilege.llm.words import PLAIN_TABLE, Numbering, map_slices

WORDS, THRESHOLD = 5, 0.8
HASHES, ROWS = 288, 6
BANDS = HASHES // ROWS
STEP, TOLERANCE = 32, 1e-9
BLOCK = 400

_rng = np.random.default_rng(20240601)
MULTIPLY = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
#: Multipliers of the words in a shingle's hash.
MIX = _rng.integers(0, 2**62, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def plain(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(PLAIN_TABLE).split()


class _Hashes:
    """64-bit hashes of words, kept between batches up to a bound."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for w in set(words) - known.keys():
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, count=len(words))


@lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    own = _Hashes()
    held(own.known.clear)
    return own


def shingle_rows(per_text: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each shingle in the flat words, and shingles per text; texts shorter than a shingle have none here."""
    n = np.maximum(per_text - words + 1, 0)
    begin = np.cumsum(per_text) - per_text
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - n), n), n


def signatures(texts: list[str | None]) -> tuple[list[bytes], list[int], list[bytes]]:
    """Class key, number of shingles (with repeats) and MinHash values (16 bits each) of each text."""
    split = [plain(t) for t in texts]
    per_text = np.fromiter(map(len, split), np.int64, count=len(split))
    flat = [w for ws in split for w in ws]
    keys = [
        xxhash.xxh3_128_digest(b" ".join(ws), seed=1) if ws else xxhash.xxh3_128_digest(b"" if t is None else b"=" + t.encode(), seed=2)
        for ws, t in zip(split, texts)
    ]
    h = _hashes().of(flat)
    starts, n = shingle_rows(per_text, WORDS)
    mixed = np.zeros(len(starts), np.uint64)
    for k in range(WORDS):
        mixed += h[starts + k] * MIX[k]
    short = np.flatnonzero((per_text > 0) & (n == 0))
    begin = np.cumsum(per_text) - per_text
    out = np.zeros((len(texts), HASHES), np.uint16)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    own = (mixed >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(n)
    for i in np.flatnonzero(n):
        out[i] = _minima(own[ends[i] - n[i] : ends[i]])
    for i in short:
        at = h[begin[i] : begin[i] + per_text[i]]
        value = np.uint64(0)
        for k, x in enumerate(at):
            value = np.uint64((int(value) + int(x) * int(MIX[k])) & (2**64 - 1))
        out[i] = _minima(np.array([(int(value) * 0x9E3779B97F4A7C15 >> 32) & 0xFFFFFFFF], np.uint32))
    return keys, [int(a) or int(b > 0) for a, b in zip(n, per_text)], [x.tobytes() for x in out]


def _minima(values: np.ndarray) -> np.ndarray:
    """Low 16 bits of each permutation's minimum."""
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(values), 512):
        part = values[at : at + 512]
        np.minimum(least, (part[:, None] * MULTIPLY + ADD).min(axis=0), out=least)
    return (least & np.uint32(0xFFFF)).astype(np.uint16)


@lru_cache(maxsize=8)
def least_matches(threshold: float, hashes: int, tolerance: float) -> list[int]:
    """For n values compared: the fewest equal ones with which a pair stays."""
    out = [0]
    for n in range(1, hashes + 1):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.exp(
                math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(threshold) + (n + 1 - m) * math.log(1 - threshold)
            )
        out.append(m)
    return out


def surviving_pairs(left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two matrices of MinHash values that no step of the comparison drops."""
    least = least_matches(threshold, HASHES, TOLERANCE)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(left), 64):
        a = left[at : at + 64]
        equal = np.zeros((len(a), len(right)), np.uint16)
        for k in range(STEP):
            equal += a[:, None, k] == right[None, :, k]
        i, j = np.nonzero(equal >= least[STEP])
        if same:
            i, j = i[i + at < j], j[i + at < j]
        count = equal[i, j].astype(np.int64)
        for n in range(STEP, HASHES, STEP):
            count = count + (a[i, n : n + STEP] == right[j, n : n + STEP]).sum(axis=1)
            keep = count >= least[min(n + STEP, HASHES)]
            i, j, count = i[keep], j[keep], count[keep]
        found.append((i + at, j))
    return np.concatenate([x for x, _ in found]) if found else np.zeros(0, int), np.concatenate([y for _, y in found]) if found else np.zeros(0, int)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Exact shingle numbers of each text, sorted and distinct; numbers hold within the list of texts."""
    split = [plain(t) for t in texts]
    index = Numbering()
    per_text = np.fromiter(map(len, split), np.int64, count=len(split))
    numbers = index.numbers([w for ws in split for w in ws])
    starts, n = shingle_rows(per_text, words)
    row = numbers[starts]
    for k in range(1, words):  # number of the first k words, then of one more
        _, row = np.unique(row * len(index) + numbers[starts + k], return_inverse=True)
    ends, begin = np.cumsum(n), np.cumsum(per_text) - per_text
    short: dict[tuple, int] = {}
    out = []
    for i in range(len(texts)):
        if n[i]:
            out.append(np.unique(row[ends[i] - n[i] : ends[i]]))
        elif per_text[i]:
            key = tuple(numbers[begin[i] : begin[i] + per_text[i]].tolist())
            out.append(np.array([-1 - short.setdefault(key, len(short))]))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def linked_pairs(values: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool, threshold: float, band: int = 0) -> Iterator[tuple[int, int, float]]:
    """Pairs (positions in ``sets``) of left x right whose Jaccard similarity reaches the threshold and that share no band before ``band``."""
    i, j = surviving_pairs(values[left], values[right], same, threshold)
    if band and len(i):
        equal = values[left[i], : band * ROWS] == values[right[j], : band * ROWS]
        fresh = ~equal.reshape(len(i), band, ROWS).all(axis=2).any(axis=1)
        i, j = i[fresh], j[fresh]
    for a, b in zip(left[i].tolist(), right[j].tolist()):
        x, y = sets[a], sets[b]
        if not len(x) or not len(y) or min(len(x), len(y)) < threshold * max(len(x), len(y)) - 1e-9:
            continue
        both = len(np.intersect1d(x, y, assume_unique=True))
        either = len(x) + len(y) - both
        if both >= threshold * either - 1e-9:
            yield a, b, both / either


def _unit(threshold: float, pairs: bool):
    """One unit: groups, or two blocks of one group.  Gives links and, per class, their number and a root."""

    def run(t: pa.Table) -> pa.Table:
        keys, groups, bands, sides, crosses = (t.column(c).to_pylist() for c in ("key", "grp", "band", "side", "cross"))
        values = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(len(keys), HASHES)
        sets = shingle_sets(t.column("text").to_pylist())
        members: dict[bytes, list[int]] = {}
        seen: set[tuple[bytes, bytes]] = set()
        for at, g in enumerate(groups):
            if (g, keys[at]) not in seen:  # a row that repeats may have brought its text twice
                members.setdefault(g, []).append(at)
                seen.add((g, keys[at]))
        links, root = np.zeros(len(keys), np.int64), list(range(len(keys)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        out: list[tuple[bytes, bytes, float]] = []
        for at in members.values():
            two, band, side, at = crosses[at[0]], bands[at[0]], np.array([sides[x] for x in at]), np.array(at)
            for a, b, similarity in linked_pairs(values, sets, at[side == 0], at[side == 1] if two else at, not two, threshold, band):
                if pairs:
                    out.append((*sorted((keys[a], keys[b])), similarity))
                links[a] += 1
                links[b] += 1
                root[max(top(a), top(b))] = min(top(a), top(b))
        if pairs:
            return pa.table([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.float64()))], names=["a", "b", "similarity"])
        some = np.flatnonzero(links)
        return pa.table(
            [pa.array([keys[x] for x in some], pa.binary()), pa.array(links[some]), pa.array([keys[top(x)] for x in some], pa.binary())],
            names=["key", "links", "root"],
        )

    return run


def row_mark(id_col: str, text_col: str) -> Column:
    """A number that tells rows of one id, or of none, apart by their text."""
    return F.xxhash64(id_col, text_col).alias("row_mark")


class Join:
    """The stages of the join over ``docs``; ``classes`` has one row per row of ``docs``."""

    def __init__(self, docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.docs, self.threshold, self.id_col, self.text_col = docs, threshold, id_col, text_col
        kind = docs.schema[id_col].dataType.simpleString()

        def sign(part: pa.RecordBatch) -> pa.RecordBatch:
            keys, n, values = signatures(part.column(1).to_pylist())
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(values, pa.binary())], names=["id", "row_mark", "key", "n", "sig"]
            )

        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_mark(id_col, text_col))
        signed = map_slices(rows, ["id", "text", "row_mark"], "text", sign, f"id {kind}, row_mark bigint, key binary, n bigint, sig binary")
        self.classes = materialize(signed)

    def distinct(self) -> DataFrame:
        """key, sig, rep (the mark of one row), n_copies of each class with words."""
        return self.classes.filter("n > 0").groupBy("key").agg(F.min("row_mark").alias("rep"), F.count("*").alias("n_copies"), F.first("sig").alias("sig"))

    @staticmethod
    def buckets(distinct: DataFrame, *more: str) -> DataFrame:
        """key, band, bucket of each class, and ``more`` columns."""
        bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * (2 * ROWS) + 1, F.lit(2 * ROWS))))
        return distinct.select("key", *more, F.posexplode(bands).alias("band", "bucket"))

    def groups(self, distinct: DataFrame) -> DataFrame:
        """key, comp of classes that share a band with another."""
        exploded = self.buckets(distinct).select("key", "bucket")
        heads = exploded.groupBy("bucket").agg(F.min("key").alias("head"), F.max("key").alias("tail")).filter("head <> tail").select("bucket", "head")
        edges = exploded.join(heads, "bucket").filter("key <> head").select("key", "head").distinct()
        return components(edges, "key", "head").select(F.col("node").alias("key"), F.col("component").alias("comp"))

    @staticmethod
    def _placed(members: DataFrame, rows: int, kind: str) -> DataFrame:
        """unit, grp, key, band, side, cross of ``members`` (grp, key, band, size of grp): ``rows`` of them."""
        parts = max(1, math.ceil(rows / 1500))
        small = F.col("size") <= BLOCK
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        own = F.when(small, 0).otherwise(F.pmod(F.xxhash64("key"), blocks).cast("int"))
        other = F.explode(F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1)))
        low, high = F.least("own", "other"), F.greatest("own", "other")
        unit = lambda g, i, j: F.struct(F.lit(kind).alias("kind"), g.alias("g"), i.alias("i"), j.alias("j"))
        unit = F.when(small, unit(F.lit(None).cast("binary"), F.pmod(F.xxhash64("grp"), F.lit(parts)).cast("int"), F.lit(-1))).otherwise(unit(F.col("grp"), low, high))
        return members.withColumn("own", own).withColumn("other", other).select(
            unit.alias("unit"), "grp", "key", "band", F.when(small, 0).otherwise((F.col("own") > low).cast("int")).alias("side"), (~small & (low < high)).alias("cross")
        )

    def _in_units(self, pairs: bool) -> DataFrame:
        distinct = materialize(self.distinct())
        groups = materialize(self.groups(distinct))
        sizes = groups.groupBy("comp").agg(F.count("*").alias("size"))
        members = materialize(groups.join(redealt(sizes), "comp"))
        n = members.count()
        forget_shuffles(self.docs.sparkSession)
        # of large groups: the work bucket by bucket
        large = members.filter(F.col("size") > BLOCK).join(distinct.select("key", "sig"), "key")
        shared = self.buckets(large, "comp", "size").withColumnRenamed("size", "of_comp")
        counts = shared.groupBy("comp", "of_comp", "bucket").agg(F.count("*").alias("size")).filter("size > 1")
        chained = counts.groupBy("comp", "of_comp").agg(F.sum(F.col("size") * F.col("size")).alias("work")).filter("work < of_comp * of_comp").select("comp")
        chained = materialize(chained)
        whole = members.join(chained, "comp", "left_anti").select(F.col("comp").alias("grp"), "key", F.lit(0).alias("band"), "size")
        placed = self._placed(whole, n, "whole")
        if not chained.isEmpty():
            of_chains = shared.join(chained, "comp", "left_semi").join(counts.select("comp", "bucket", "size"), ["comp", "bucket"])
            of_chains = materialize(of_chains.select(F.col("bucket").cast("string").cast("binary").alias("grp"), "key", "band", "size"))
            placed = placed.union(self._placed(of_chains, of_chains.count(), "bucket"))
        reps = groups.join(distinct, "key").select("key", "sig", "rep")
        docs = self.docs.select(row_mark(self.id_col, self.text_col), F.col(self.text_col).alias("text"))
        texts = self._own_text(docs.join(reps, F.col("row_mark") == F.col("rep")))
        rows = placed.join(texts, "key").select("unit", "grp", "key", "band", "side", "cross", "sig", "text")
        schema = "a binary, b binary, similarity double" if pairs else "key binary, links bigint, root binary"
        return rows.groupBy("unit").applyInArrow(_unit(self.threshold, pairs), schema)

    def _own_text(self, texts: DataFrame) -> DataFrame:
        """One text for each key: rows that repeat bring it more than once, and a mark's other text, if ever, is told by its own key."""

        def fits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()
            for b in batches:
                keep = []
                for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                    ok = key not in seen and xxhash.xxh3_128_digest(b" ".join(plain(text)), seed=1) == key
                    seen.update([key] if ok else [])
                    keep.append(ok)
                yield b.filter(pa.array(keep))

        return texts.select("key", "sig", "text").mapInArrow(fits, "key binary, sig binary, text string")

    def pairs(self) -> DataFrame:
        """a, b, similarity: class keys of each pair of different texts that reaches the threshold (see ``classes`` for membership)."""
        return self._in_units(True)

    def documents(self) -> DataFrame:
        """id, class_id (least id of all that hang together), n_links (different texts linked), n_copies (rows of the same words), row_mark, first.

        ``first`` is true for one row of all that hang together, that of the
        least id, rows without id last, and the least mark, and for its equals.
        """
        found = materialize(self._in_units(False))
        forget_shuffles(self.docs.sparkSession)
        links = found.groupBy("key").agg(F.sum("links").alias("n_links"))
        comps = components(found, "key", "root").select(F.col("node").alias("key"), F.col("component").alias("comp"))
        order = F.struct(F.col("id").isNull().alias("none"), "id", "row_mark")
        per_key = self.classes.groupBy("key").agg(F.min("id").alias("least"), F.min(order).alias("own"), F.count("*").alias("n_copies"))
        known = per_key.join(links, "key", "left").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
        linked = known.filter("n_links is not null").groupBy("comp").agg(F.min("least").alias("of_comp"), F.min("own").alias("own_of_comp"))
        known = known.join(redealt(linked), "comp", "left").select(
            "key", F.coalesce("of_comp", "least").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "n_copies", F.coalesce("own_of_comp", "own").alias("own")
        )
        first = order.eqNullSafe(F.col("own"))
        return self.classes.select("id", "row_mark", "key").join(known, "key").select(F.col("id").alias(self.id_col), "class_id", "n_links", "n_copies", "row_mark", first.alias("first"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links, n_copies."""
    return Join(docs, threshold, id_col, text_col).documents().drop("row_mark", "first")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of all that hang together the one of the least id (see ``Join.documents``), once if it repeats."""
    marks = Join(docs, threshold, id_col, text_col).documents().filter("first").select(F.col("row_mark").alias("_row_mark")).distinct()
    own = docs.withColumn("_row_mark", row_mark(id_col, text_col))
    return own.join(marks, "_row_mark", "left_semi").dropDuplicates(["_row_mark", id_col, text_col]).drop("_row_mark")  # the join's own partitioning serves
