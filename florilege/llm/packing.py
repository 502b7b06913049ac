"""Harmonic packing of documents into sequences of a fixed capacity.

A document's ids, closed by an end id, are cut into full sequences, then into
exact halves, quarters and eighths of the capacity, so that only a fragment of
at most ``capacity // FINE`` ids is left.  A piece of length n is of class
k = capacity // n, and a sequence of class k holds exactly k such pieces: exact
parts leave no padding and fragments leave less than 1 / (FINE + 1).

Each worker fills the bins of each class by itself, in one pass over its rows
and with one open bin per class in memory.  What ``FAN`` workers leave open,
one bin of each class at most, goes through the same pass in one task, and so
on in rounds, until one worker's open bins are left: fewer pieces than
``capacity * log(capacity)`` whatever the input, which first fit fills up.

Null texts count as empty (a piece of the end id alone); every row is packed,
repeated rows too; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from florilege.llm.bpe import encoder
from florilege.llm.shared import materialize, release
from florilege.llm.words import slices

#: Documents are cut until the rest is of this class at least.
FINE = 8
#: Workers whose open bins one task of the next round takes.
FAN = 8
#: Bytes of text that are tokenised together.
SLICE = 3 << 20


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    full, rest = divmod(n, capacity)
    out, part = [capacity] * full, capacity // 2
    while part >= max(1, capacity // FINE):
        if rest >= part:
            out.append(part)
            rest -= part
        part //= 2
    return [*out, rest] if rest else out


class Bins:
    """Open bins of one task: rows come in with their length, full bins go out with ids and offsets."""

    def __init__(self, level: int, capacity: int) -> None:
        self.capacity, self.open, self.made = capacity, {}, []
        self.next = level << 58 | TaskContext.get().partitionId() << 36

    def put(self, length: int, row: tuple) -> None:
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((length, row))
        if len(held) == k:
            self.close(self.open.pop(k))

    def close(self, held: list) -> None:
        at = 0
        for length, row in held:
            self.made.append((*row, self.next, at))
            at += length
        self.next += 1


def _emit(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 5000):
        part = list(zip(*rows[at : at + 5000]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(part, schema)], schema=schema)


def _fill(level: int, capacity: int, schema: pa.Schema, length_at: int):
    """A later round: pieces of the open bins of some workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(level, capacity)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[:-2])):
                bins.put(row[length_at], row)
            yield from _emit(bins.made, schema)
            bins.made = []
        yield from _emit([(*row, None, None) for held in bins.open.values() for _, row in held], schema)

    return run


def _first_fit(level: int, capacity: int, schema: pa.Schema, length_at: int):
    """Last pass, one task: the bounded rest, longest first, each into the first sequence with room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns[:-2]))]
        key = lambda r: (-r[length_at], str(r))
        bins = Bins(level, capacity)
        room: list[int] = []
        held: list[list] = []
        for row in sorted(rows, key=key):
            n = row[length_at]
            at = next((i for i, free in enumerate(room) if free >= n), None)
            if at is None:
                at = len(room)
                room.append(capacity)
                held.append([])
            room[at] -= n
            held[at].append((n, row))
        for x in held:
            bins.close(x)
        yield from _emit(bins.made, schema)

    return run


def pack(docs: DataFrame, vocabulary: str, pattern: str, end_id: int = 0, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds ``ids``, the piece's own ids, so that grouping by
    ``sequence_id`` and ordering by ``offset`` gives the sequences themselves.
    """
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if with_ids else []) + ["sequence_id", "offset"]
    kind = docs.schema[id_col].dataType
    spark_kinds = [kind.simpleString()] + ["bigint"] * 4 + (["array<int>"] if with_ids else []) + ["bigint"] * 2
    spark_schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, spark_kinds))
    types = [to_arrow_type(kind)] + [pa.int64()] * 4 + ([pa.list_(pa.int32())] if with_ids else []) + [pa.int64()] * 2
    schema = pa.schema(list(zip(names, types)))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, own = Bins(1, capacity), encoder(vocabulary, pattern)
        cuts: dict[int, list[int]] = {}
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                flat, counts = own.encode(part.column(1).to_pylist())
                n = counts + 1
                ends = np.cumsum(n)
                ids = np.full(int(ends[-1]), end_id, "<u4")
                inside = np.ones(len(ids), bool)
                inside[ends - 1] = False
                ids[inside] = flat
                view = memoryview(ids).cast("B")
                base = 0
                for doc_id, size in zip(part.column(0).to_pylist(), n.tolist()):
                    if size not in cuts:
                        if len(cuts) > 20_000:
                            cuts.clear()
                        cuts[size] = cut_lengths(size, capacity)
                    start = 0
                    for length in cuts[size]:
                        a = base + start
                        row = (doc_id, start, length, zlib.crc32(view[4 * a : 4 * (a + length)]), size)
                        if with_ids:
                            row = (*row, ids[a : a + length].astype(np.int32).tolist())
                        bins.put(length, row)
                        start += length
                    base += size
                del flat, inside, ids, view  # not held while the next slice is tokenised
                yield from _emit(bins.made, schema)
                bins.made = []
        yield from _emit([(*row, None, None) for held in bins.open.values() for _, row in held], schema)
        release()

    length_at = 2
    filled = materialize(docs.select(id_col, text_col).mapInArrow(first, spark_schema))
    done, rest = [filled], filled
    level, workers = 2, filled.rdd.getNumPartitions()
    while workers > 1:
        workers = -(-workers // FAN)
        open_bins = rest.filter(F.col("sequence_id").isNull()).withColumn("_worker", F.floor(F.spark_partition_id() / FAN))
        dealt = open_bins.repartition(workers, "_worker").drop("_worker")
        rest = materialize(dealt.mapInArrow(_fill(level, capacity, schema, length_at), spark_schema))
        done.append(rest)
        level += 1
    last = rest.filter(F.col("sequence_id").isNull()).coalesce(1).mapInArrow(_first_fit(level, capacity, schema, length_at), spark_schema)
    for x in done:
        last = last.unionByName(x.filter(F.col("sequence_id").isNotNull()))
    return last
