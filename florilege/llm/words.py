"""Word and batch helpers shared by the text operators.

Python code here runs inside Arrow-batched functions.  A batch is cut into
slices of a few MB before any Python list of words is made, so that memory
follows the slice, not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.llm.shared import release

#: Words of the quality and language-model operators: runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Words of the matching operators: ASCII letters and digits (lower case) and everything beyond ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between two plain words.
PLAIN_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The same on texts of both cases.
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes that separate plain words become a space, A-Z become a-z; a table for bytes.translate.
PLAIN_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

SLICE_BYTES = 2 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null stays null."""
    return F.translate(text, UPPER, LOWER)


def fold(word: Column) -> Column:
    """``lower_ascii`` of a word, by the faster way for words that are all ASCII."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(lower_ascii(word))


def raw_words(text: Column) -> Column:
    """Plain words of a text in their own case, JVM-side, by one pass of one pattern.

    The first and the last are empty where the text begins or ends with a gap
    (see ``lead`` and ``n_words``); a null text is an empty one.
    """
    return F.split(F.coalesce(text, F.lit("")), RAW_GAP, -1)


def lead(words: Column) -> Column:
    """1 where the first of ``raw_words`` is empty, else 0."""
    return (F.get(words, F.lit(0)) == "").cast("int")


def n_words(words: Column) -> Column:
    """How many of ``raw_words`` are words."""
    n = F.size(words)
    return n - lead(words) - ((n > 1) & (F.get(words, n - 1) == "")).cast("int")


def plain_words(text: Column) -> Column:
    """Array of plain words of a short text; null and texts without words give an empty array."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), PLAIN_GAP, -1), lambda w: w != "")


def text_key(text: Column, known: Column | None = None) -> Column:
    """16 bytes that stand for a text.  Where ``known`` is false they stand for the row alone."""
    key = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.unhex(key if known is None else F.when(known, key).otherwise(F.md5(F.monotonically_increasing_id().cast("string").cast("binary"))))


def slices(batch: pa.RecordBatch, text_at: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_slices(df: DataFrame, columns: list[str], text: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to slices of ``columns`` of ``df``; ``text`` is the column that bounds a slice."""
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                yield fn(part)
        release()

    return df.select(*columns).mapInArrow(run, schema)


class Numbering(dict):
    """Numbers keys in order of first sight; ``fresh`` holds those not yet taken by ``take``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        self[key] = at = len(self)
        self.fresh.append(key)
        return at

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, count=len(keys))

    def take(self) -> list:
        fresh, self.fresh = self.fresh, []
        return fresh


class Grower:
    """A numpy array that grows at its end."""

    def __init__(self, dtype) -> None:
        self.data, self.size = np.empty(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            grown = np.empty(max(need, 2 * len(self.data)), self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : need] = values
        self.size = need

    @property
    def view(self) -> np.ndarray:
        return self.data[: self.size]


def ragged_take(starts: np.ndarray, lengths: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Positions, in the flat values, of the ragged rows ``pick``, one row after the other."""
    n = lengths[pick]
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(n)
    return np.arange(total) + np.repeat(starts[pick] - (ends - n), n)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of ``counts`` values (0 for empty runs)."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
