"""Bytes of long passages that occur twice or more, by merging Burrows-Wheeler transforms.

A passage of ``LENGTH`` bytes repeats if it starts at another place too, of the
same text or of another.  Texts are bytes (UTF-8).

1. Equal texts are one text with a weight.
2. Each place that a passage can start at has an anchor: the gram of ``GRAM``
   bytes with the least hash in the passage.  Places in a row with one anchor
   are a context: the bytes that their passages cover.  Equal passages have the
   same anchor, so passages repeat within the contexts of an anchor only, and
   anchors that occur once are done with.
3. Different contexts of an anchor meet in a bucket.  Its contexts are dealt
   into shards; each shard sorts its own suffixes, over blocks of ``SYMBOL``
   bytes as symbols, into a transform.  The transforms are merged by refining
   their interleave: a step puts every suffix where the symbol before it
   belongs, by its shard's own mapping, so that after step h all suffixes stand
   in order of h symbols.  No suffix is compared again.  The step at which two
   neighbours part is their common prefix in symbols; runs of neighbours that
   share ``LENGTH // SYMBOL`` symbols are the repeated intervals.
4. An anchor with more than ``HOT_BYTES`` of different contexts is dealt into
   several buckets.  Each then also names one start of every interval, single
   ones too, by the hash of its passage; the buckets' names meet by hash, each
   once a bucket, and what two buckets name repeats.
5. Ranges of repeated starts go back to the texts, whose bytes they cover.

Passages and blocks are told apart by 64-bit hashes, compared only within an
anchor's bucket.

Defined results: a null text is an empty one; a text of under ``LENGTH`` bytes
keeps all.  Repeated rows, whatever their ids, are texts like others: each
counts.  A null id is carried.  A very long text is read in pieces.  An empty
table gives an empty result.  Other columns don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.shared import materialize_table, release
from florilege.llm.words import map_slices, ragged_take, slices, text_key

#: Bytes of a passage, of the grams that anchors are, of a symbol.
LENGTH, GRAM, SYMBOL = 400, 64, 100
#: Bytes of contexts to a bucket, to a shard within it, to an anchor before it is dealt into several; bytes of text to a piece; names to a group.
BUCKET_BYTES, SHARD_BYTES, HOT_BYTES, PIECE, NAMES = 2 << 20, 256 << 10, 4 << 20, 1 << 20, 1 << 20
MANY = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
LOW = np.uint64(32)


class Hashes:
    """Hashes of any stretch of some bytes, from sums of its bytes times powers."""

    _up = _down = np.zeros(0, np.uint64)

    @classmethod
    def _powers(cls, n: int) -> None:
        if len(cls._up) < n:
            for name, base in (("_up", BASE), ("_down", pow(BASE, -1, 1 << 64))):
                powers = np.full(n, base & MANY, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers))

    def __init__(self, data: np.ndarray) -> None:
        self._powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * self._down[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed((self.sums[end] - self.sums[start]) * self._up[start])

    def each(self, width: int) -> np.ndarray:
        """Of all stretches of ``width`` bytes."""
        n = len(self.sums) - width
        return self._mixed((self.sums[width:] - self.sums[:n]) * self._up[:n])

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h ^= h >> LOW
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> LOW
        return h


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window, by minima from both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, MANY, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def contexts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """start, number of starts, anchor and hash of each context of texts that lie behind one another and end at ``ends``.

    A context never reaches over a text's end.
    """
    out = []
    for begin in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        piece = data[begin : begin + PIECE + LENGTH - 1]
        hashes = Hashes(piece)
        grams = hashes.each(GRAM)
        place = np.arange(len(grams), dtype=np.uint64)
        anchor = least_in_windows(grams >> np.uint64(24) << np.uint64(24) | place, LENGTH - GRAM + 1) & np.uint64(0xFFFFFF)
        start = np.arange(len(anchor))
        whole = start + begin + LENGTH <= ends[np.searchsorted(ends, start + begin, side="right")]
        edge = np.ones(len(anchor) + 1, bool)
        edge[1:-1] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
        cut = np.flatnonzero(edge)
        lo, hi = cut[:-1], cut[1:]
        lo, hi = lo[whole[lo]], hi[whole[lo]]
        out.append((lo + begin, hi - lo, grams[anchor[lo].astype(np.int64)].view(np.int64), hashes.of(lo, hi + LENGTH - 1).view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.zeros(0, np.int64) for _ in range(4))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, and where each text ends in them."""
    joined = column.cast(pa.large_binary())
    ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends[1:] - ends[0]


def _contexts_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, ends = _bytes_of(batch.column(1))
    lo, n, anchor, ctx = contexts(data, ends)
    of = np.searchsorted(ends, lo, side="right")
    starts = np.concatenate([[0], ends[:-1]])
    return pa.record_batch([batch.column(0).take(pa.array(of)), pa.array(lo - starts[of]), pa.array(n), pa.array(anchor), pa.array(ctx), batch.column(2).take(pa.array(of))], names=["text_key", "lo", "n_starts", "anchor", "ctx", "n"])


def _ranked(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    edge = np.concatenate([[0], keys[order][1:] != keys[order][:-1]])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(edge)
    return rank


class Transforms:
    """The transforms of the shards of some strings, over symbols of ``SYMBOL`` bytes.

    A string of n bytes has a suffix at each of its places 0 to n: its symbols
    are the blocks that follow it without gap; the last ``SYMBOL`` places are
    ends, without one (symbol 0).
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray) -> None:
        self.sizes, self.slots = sizes, sizes + 1
        self.first = np.cumsum(self.slots) - self.slots
        self.data_first = np.cumsum(sizes) - sizes
        self.string = np.repeat(np.arange(len(sizes)), self.slots)
        place = np.arange(len(self.string)) - self.first[self.string]
        self.place = place
        real = place <= sizes[self.string] - SYMBOL
        self.hashes = Hashes(data)
        start = self.data_first[self.string[real]] + place[real]
        self.symbol = np.zeros(len(place), np.int64)
        self.symbol[real] = 1 + _ranked(self.hashes.of(start, start + SYMBOL))
        self.headed = place >= SYMBOL  # a symbol stands before it
        shard = np.cumsum(sizes) // SHARD_BYTES
        cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        self.shards = [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.order, self.lf, self.before = self._sorted()

    def _sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all shards in turn: their sorted suffixes, to which entry each one's predecessor goes, and the symbol before each."""
        orders, maps = [], []
        for a, b in self.shards:
            lo, hi = self.first[a], self.first[b - 1] + self.slots[b - 1]
            rank, reach = self.symbol[lo:hi].copy(), SYMBOL
            longest = int(self.sizes[a:b].max())
            ended = self.symbol[lo:hi] == 0
            while reach <= longest:
                # a suffix that ends within its reach meets an end there (rank 0) or has met one before
                nxt = np.zeros(len(rank), np.int64)
                nxt[:-reach] = rank[reach:]
                inside = self.place[lo:hi] + reach <= self.sizes[self.string[lo:hi]]
                nxt[~inside] = 0
                rank = _ranked(rank << 32 | nxt)
                reach *= 2
            assert not rank[ended].any()
            order = np.sort(rank << 32 | np.arange(len(rank))) & 0xFFFFFFFF
            entry = np.empty(len(order), np.int64)
            entry[order] = np.arange(len(order))
            orders.append(order + lo)
            maps.append(np.where(self.headed[order + lo], entry[order - SYMBOL], -1) + lo)  # entries of a shard are as many as its slots
        order = np.concatenate(orders)
        before = np.where(self.headed[order], self.symbol[order - SYMBOL], 0)
        return order, np.concatenate(maps), before

    def merge(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The interleave in order of ``depth`` symbols, as slots, and the symbols that each shares with the one before (``depth`` at most)."""
        n = len(self.order)
        ends = np.flatnonzero(self.symbol[self.order] == 0)  # in the order of shards, within a shard by place
        entries, block = np.arange(n), np.zeros(n, np.int64)
        common = np.full(n, depth, np.int8)
        for h in range(1, depth + 1):
            before = self.before[entries]
            moved = np.flatnonzero(before)
            by = (np.sort(before[moved] << 32 | np.arange(len(moved))) & 0xFFFFFFFF).astype(np.int64)  # by symbol, as they stand
            moved = moved[by]
            symbol, old = before[moved], block[moved]
            edge = np.zeros(n, bool)
            edge[0] = True
            if len(ends) < n:
                edge[len(ends)] = True
                edge[len(ends) + 1 :] = (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])
            common[edge & (common == depth)] = h - 1
            entries = np.concatenate([ends, self.lf[entries[moved]]])
            block = np.cumsum(edge)
        return self.order[entries], common


def repeated(data: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """string, start and hash of one passage of each interval, and whether the interval weighs two or more; then a flag per start of every string.

    Returns (flags, string, start, hash): ``flags`` in order of strings, a
    string of n bytes having n - LENGTH + 1; the others of intervals of weight one.
    """
    transforms = Transforms(data, sizes)
    slot, common = transforms.merge(LENGTH // SYMBOL)
    string, place = transforms.string[slot], transforms.place[slot]
    edge = common < LENGTH // SYMBOL
    at = np.flatnonzero(edge)
    weight = np.add.reduceat(weights[string], at)
    heavy = np.repeat(weight >= 2, np.diff(np.append(at, len(slot))))
    fits = place + LENGTH <= sizes[string]
    starts = sizes - LENGTH + 1
    first = np.cumsum(starts) - starts
    flags = np.zeros(starts.sum(), bool)
    flags[(first[string] + place)[fits & heavy]] = True
    one = at[fits[at]]
    return flags, string[one], place[one], transforms.hashes.of(*(lambda s: (s, s + LENGTH))(transforms.data_first[string[one]] + place[one]))


def runs(flags: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """group, from and to (positions) of maximal runs of set flags within a group."""
    if not len(flags):
        return (np.zeros(0, np.int64),) * 3
    begin = flags.copy()
    begin[1:] &= ~flags[:-1] | (group[1:] != group[:-1])
    end = flags.copy()
    end[:-1] &= ~flags[1:] | (group[1:] != group[:-1])
    lo = np.flatnonzero(begin)
    return group[lo], lo, np.flatnonzero(end) + 1


RANGES = "anchor long, ctx long, ranges array<int>"
FOUND = f"{RANGES}, part int, names binary"


def _listed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def _ranges(anchor: np.ndarray, ctx: np.ndarray, of: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Rows of the strings in ``of`` (sorted), with their ranges behind one another."""
    ids, counts = np.unique(of, return_counts=True)
    return anchor[ids], ctx[ids], _listed(np.stack([lo, hi], axis=1).ravel(), 2 * counts)


def _bucket(parts: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("ctx", "ascending")]).combine_chunks()
        anchor, ctx, n, hot = (table.column(c).to_numpy() for c in ("anchor", "ctx", "n", "hot"))
        data, ends = _bytes_of(table.column("bytes").chunk(0))
        sizes = np.diff(ends, prepend=0)
        flags, string, start, name = repeated(data, sizes, n)
        starts = sizes - LENGTH + 1
        first = np.cumsum(starts) - starts
        of, lo, hi = runs(flags, np.repeat(np.arange(len(sizes)), starts))
        a, c, r = _ranges(anchor, ctx, of, lo - first[of], hi - first[of])
        nothing = pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())
        out = [pa.table([pa.array(a), pa.array(c), r, *nothing], names=["anchor", "ctx", "ranges", "part", "names"])]
        told = hot[string]
        if told.any():
            string, start, name = string[told], start[told], name[told]
            rows = np.stack([name.view(np.int64), anchor[string], ctx[string], start], axis=1)
            part = (name >> np.uint64(11)) % np.uint64(parts)
            for k in np.unique(part):
                row = pa.table({"anchor": pa.nulls(1, pa.int64()), "ctx": pa.nulls(1, pa.int64()), "ranges": pa.nulls(1, pa.list_(pa.int32())), "part": pa.array([k], pa.int32()), "names": pa.array([rows[part == k].tobytes()], pa.binary())})
                out.append(row)
        release()
        return pa.concat_tables(out)

    return run


def _met(table: pa.Table) -> pa.Table:
    """Starts that another bucket names too."""
    rows = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for x in table.column("names").to_pylist()])
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[order]
    same = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
    twice = np.zeros(len(rows), bool)
    twice[1:] |= same
    twice[:-1] |= same
    rows = rows[twice]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1]))]
    new = np.concatenate([[True], (rows[1:, 1:3] != rows[:-1, 1:3]).any(axis=1)])[: len(rows)]
    of = np.cumsum(new) - 1
    a, c, r = _ranges(rows[new, 1], rows[new, 2], of, rows[:, 3], rows[:, 3] + 1)
    release()
    return pa.table([pa.array(a), pa.array(c), r], names=["anchor", "ctx", "ranges"])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The bytes of the contexts that a text lends."""
    data, ends = _bytes_of(batch.column(0))
    lent = batch.column(1)
    n = np.diff(lent.offsets.to_numpy())
    flat = lent.flatten()
    lo, size = flat.field("lo").to_numpy(), flat.field("n_starts").to_numpy() + LENGTH - 1
    lo = lo + np.repeat(np.concatenate([[0], ends[:-1]]), n)
    offsets = np.concatenate([[0], np.cumsum(size)])
    held = data[ragged_take(lo, size, np.arange(len(lo)))]
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lo), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(held.tobytes())])
    return pa.record_batch([flat.field(c) for c in ("bucket", "anchor", "ctx", "n", "hot")] + [cut.cast(pa.binary())], names=["bucket", "anchor", "ctx", "n", "hot", "bytes"])


def _removed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What is left of texts whose repeated starts lie in ``ranges``."""
    data, ends = _bytes_of(batch.column(1))
    lists = batch.column(2)
    n_lists = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    pairs = flat.field("ranges")
    counts = np.diff(pairs.offsets.to_numpy()) // 2
    bounds = pairs.flatten().to_numpy().reshape(-1, 2)
    shift = np.repeat(flat.field("lo").to_numpy() + np.repeat(np.concatenate([[0], ends[:-1]]), n_lists), counts)
    depth = np.zeros(len(data) + 1, np.int32)
    np.add.at(depth, bounds[:, 0] + shift, 1)
    np.add.at(depth, bounds[:, 1] + shift + LENGTH - 1, -1)
    gone = np.cumsum(depth[:-1]) > 0
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    of, _, _ = runs(gone, text)
    kept = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]
    return pa.record_batch(
        [batch.column(0), pa.array(np.bincount(text[gone], minlength=len(ends))), pa.array(np.bincount(of, minlength=len(ends))), pa.array(kept)],
        names=["text_key", "n_removed", "n_spans", "kept_sha256"],
    )


def repeated_starts(texts: DataFrame) -> DataFrame:
    """text_key, list of (lo, ranges): where the repeated passages of texts (text_key, text, n) start."""
    # a task's batches keep to the slices' size
    found = materialize_table(map_slices(texts, ["text_key", "text", "n"], "text", _contexts_of, "text_key binary, lo long, n_starts long, anchor long, ctx long, n long"))
    each = found.groupBy("anchor", "ctx").agg(F.sum("n").alias("n"), F.min(F.struct("text_key", "lo")).alias("at"), F.first("n_starts").alias("n_starts"))
    size = F.col("n_starts") + (LENGTH - 1)
    groups = each.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("m"), F.sum(size).alias("bytes")).filter("total >= 2")
    each = materialize_table(each.join(groups.drop("total"), "anchor"))
    alone = each.filter("m = 1").select("anchor", "ctx", F.array(F.lit(0), F.col("n_starts").cast("int")).alias("ranges"))
    asked = each.filter("m > 1")
    much, hot = asked.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.sum(F.when(F.col("bytes") > HOT_BYTES, F.col("n_starts"))), F.lit(0))).first()
    buckets, parts = max(1, -(-int(much) // BUCKET_BYTES)), max(1, -(-int(hot) // NAMES))
    is_hot = F.col("bytes") > HOT_BYTES
    share = F.when(is_hot, F.pmod(F.col("ctx"), F.ceil(F.col("bytes") / BUCKET_BYTES))).otherwise(0)
    bucket = F.pmod(F.xxhash64("anchor", share), F.lit(buckets))
    lent = asked.select("at.text_key", F.struct("at.lo", "n_starts", bucket.alias("bucket"), "anchor", "ctx", "n", is_hot.alias("hot")).alias("x"))
    lent = lent.groupBy("text_key").agg(F.collect_list("x").alias("x")).join(texts.select("text_key", "text"), "text_key")
    held = map_slices(lent, ["text", "x"], "text", _cut, "bucket long, anchor long, ctx long, n long, hot boolean, bytes binary")
    merged = materialize_table(held.groupBy("bucket").applyInArrow(_bucket(parts), FOUND))
    ranges = merged.filter("part IS NULL").select("anchor", "ctx", "ranges").union(alone)
    if hot:
        ranges = ranges.union(merged.filter("part IS NOT NULL").groupBy("part").applyInArrow(_met, RANGES))
    return found.select("text_key", "lo", "anchor", "ctx").join(ranges, ["anchor", "ctx"]).groupBy("text_key").agg(F.collect_list(F.struct("lo", "ranges")).alias("x"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = own.select("doc_id", text_key(F.col("text")).alias("text_key"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    texts = own.filter(F.octet_length("text") >= LENGTH).groupBy(text_key(F.col("text")).alias("text_key")).agg(F.first("text").alias("text"), F.count("*").alias("n"))
    texts = materialize_table(texts)
    starts = repeated_starts(texts).join(texts.select("text_key", "text"), "text_key")
    cut = map_slices(starts, ["text_key", "text", "x"], "text", _removed, "text_key binary, n_removed long, n_spans long, kept_sha256 string")
    none = F.lit(0).cast("long")
    return rows.join(cut, "text_key", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
