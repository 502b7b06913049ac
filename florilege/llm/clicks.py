"""Deduplication of clicks whose windows expire, as a stateful stream over batches.

Copies of click rows are cut into batches by when they come; each batch is fed
to one streaming query, which is started anew for it on the same checkpoint.
State is kept by shard (a hash of the click), not by click: one Arrow-packed
blob holds the open windows of all clicks of a shard as arrays, sorted by click.
A batch is folded into it by a merge join on sorted ids and some vectorised
rounds, one per window that a click opens in the batch.

A window is open until its deadline falls behind the watermark; the shard's
timeout stands at its least deadline.  In the last batch each shard has a
closing row, so that all of them close what is left.

Defined results: a row without id, with an id below 0 or without a time of
arrival takes no part.  Other nulls are empty texts in the hash.  Rows that
repeat in all that counts are one row with a number, put together before they
are shuffled by shard.  An empty table gives an empty result.  Columns that
aren't read, whatever they are called, don't matter.  A long ``props`` only
enters the hash.  Memory of a task follows the shard (``SHARD_ROWS`` copies of
all batches), of which there are more in larger tables, and the different rows
of one click within a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from florilege.llm.shared import checkpoint_dir, remove_folder

#: Hours from a window's start to its deadline, hours that a row may be late, batches.
SPAN, LATE, BATCHES = 72, 48, 12
#: Copies to a shard, over all batches; shards at least.
SHARD_ROWS, LEAST_SHARDS = 100_000, 64
MS = 3_600_000
#: Hours before the first one at which event time begins (the watermark stands at 0 before the first batch).
HEAD = 1000

ROW = "shard int, click_id long, hour long, hash binary, crc long, n long"
CLOSED = "click_id long, start_hour long, closed_batch long, n_repeats long, n_conflicts long, conflict_crc long, hash binary"
STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def epoch_micros(stamp: str, kind: str) -> Column:
    """Microseconds since 1970 in UTC; a stamp without a zone is UTC, whatever the session's zone."""
    if kind == "timestamp":
        return F.unix_micros(stamp)
    clock = (F.hour(stamp) * 60 + F.minute(stamp)).cast("long") * 60_000_000 + (F.expr(f"extract(SECOND FROM `{stamp}`)") * 1_000_000).cast("long")
    return F.unix_date(F.col(stamp).cast("date")).cast("long") * 86_400_000_000 + clock


def copies(clicks: DataFrame) -> DataFrame:
    """click_id, hour, place (when the copy comes), hash (32 bytes), crc (of its hex digits), for each copy of each row."""
    kinds = dict(clicks.dtypes)
    arrived = F.floor(epoch_micros("arrived_at", kinds["arrived_at"]) / 3_600_000_000)
    told = F.concat_ws(
        "|", *(F.coalesce(x.cast("string"), F.lit("")) for x in (F.col("client_id"), F.col("kind"), F.floor(F.col("value") * 100 + 0.5), epoch_micros("ts", kinds["ts"]), F.col("props")))
    )
    own = clicks.filter("click_id >= 0 AND arrived_at IS NOT NULL").select("click_id", arrived.alias("arrived"), told.alias("told"))
    own = own.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("click_id") % 3)).alias("j"))
    own = own.withColumn("c", F.crc32(F.concat_ws(":", "click_id", "j")))
    own = own.withColumn("hour", F.col("arrived") + 6 * F.col("j") * (F.col("c") % 10))
    hexed = F.sha2(F.concat_ws("|", "told", (F.col("c") % 3).cast("string")), 256)
    return own.select("click_id", "hour", (F.col("hour") + F.floor(F.col("c") / 10) % 200).alias("place"), hexed.alias("hex")).select("click_id", "hour", "place", F.unhex("hex").alias("hash"), F.crc32("hex").alias("crc"))


class Windows:
    """Open windows as arrays, sorted by click; ``pack`` and ``unpack`` turn them into an Arrow blob and back."""

    NAMES = ("click_id", "start", "n_repeats", "n_conflicts", "conflict_crc")

    def __init__(self, ids, start, n_repeats, n_conflicts, conflict_crc, opener) -> None:
        self.click_id, self.start, self.n_repeats, self.n_conflicts, self.conflict_crc, self.opener = ids, start, n_repeats, n_conflicts, conflict_crc, opener

    @classmethod
    def none(cls) -> Windows:
        return cls(*(np.zeros(0, np.int64) for _ in range(5)), np.zeros((0, 4), np.uint64))

    def take(self, at: np.ndarray) -> Windows:
        return Windows(*(getattr(self, k)[at] for k in self.NAMES), self.opener[at])

    def __add__(self, other: Windows) -> Windows:
        return Windows(*(np.concatenate([getattr(self, k), getattr(other, k)]) for k in self.NAMES), np.concatenate([self.opener, other.opener]))

    def pack(self) -> bytes:
        batch = pa.record_batch([pa.array(getattr(self, k)) for k in self.NAMES] + [pa.array(np.ascontiguousarray(self.opener[:, k])) for k in range(4)], names=[*self.NAMES, "h0", "h1", "h2", "h3"])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batch.schema) as to:
            to.write_batch(batch)
        return out.getvalue().to_pybytes()

    @classmethod
    def unpack(cls, blob: bytes) -> Windows:
        batch = pa.ipc.open_stream(blob).read_next_batch()
        arrays = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(9)]
        return cls(*arrays[:5], np.stack(arrays[5:], axis=1))

    def closed(self, batch: int) -> pd.DataFrame:
        raw = np.ascontiguousarray(self.opener).astype(">u8").tobytes()
        return pd.DataFrame(
            {
                "click_id": self.click_id, "start_hour": self.start, "closed_batch": np.full(len(self.start), batch, np.int64), "n_repeats": self.n_repeats, "n_conflicts": self.n_conflicts,
                "conflict_crc": self.conflict_crc, "hash": [raw[k : k + 32] for k in range(0, len(raw), 32)],
            }
        )


def _sum_by(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, group, values)
    return out


def fold(state: Windows, click_id: np.ndarray, hour: np.ndarray, opener: np.ndarray, crc: np.ndarray, n: np.ndarray) -> tuple[Windows, Windows]:
    """The windows after a batch, and those that it closed.

    ``opener``: hashes as four big-endian numbers a row; ``n``: how often the
    row repeats.  Rows are taken per click by hour, then hash.
    """
    order = np.lexsort((*(opener[:, k] for k in (3, 2, 1, 0)), hour, click_id))
    click_id, hour, opener, crc, n = click_id[order], hour[order], opener[order], crc[order], n[order]
    ids, first = np.unique(click_id, return_index=True)
    ends = np.append(first[1:], len(click_id))
    at = np.searchsorted(state.click_id, ids)
    known = at < len(state.click_id)
    known[known] = state.click_id[at[known]] == ids[known]
    now = Windows(ids, *(np.zeros(len(ids), np.int64) for _ in range(4)), np.zeros((len(ids), 4), np.uint64))
    for name in Windows.NAMES[1:]:
        getattr(now, name)[known] = getattr(state, name)[at[known]]
    now.opener[known] = state.opener[at[known]]
    least, width = hour.min(), hour.max() - hour.min() + 2
    key = np.repeat(np.arange(len(ids)), ends - first) * width + (hour - least + 1)
    place, fresh, live, closed = first.copy(), np.flatnonzero(~known), np.arange(len(ids)), Windows.none()
    while len(live):
        p = place[fresh]  # these open a window with their next row; its own repeats don't conflict
        now.start[fresh], now.opener[fresh], now.n_repeats[fresh] = hour[p], opener[p], n[p] - 1
        now.n_conflicts[fresh] = now.conflict_crc[fresh] = 0
        place[fresh] += 1
        to = np.searchsorted(key, live * width + np.clip(now.start[live] + SPAN - least + 1, 0, width - 1), side="right")
        to = np.clip(to, place[live], ends[live])
        taken = to - place[live]
        rows = np.arange(taken.sum()) + np.repeat(place[live] - (np.cumsum(taken) - taken), taken)
        of = np.repeat(live, taken)
        unlike = (opener[rows] != now.opener[of]).any(axis=1) * n[rows]
        now.n_repeats += _sum_by(of, n[rows], len(ids))
        now.n_conflicts += _sum_by(of, unlike, len(ids))
        now.conflict_crc += _sum_by(of, unlike * crc[rows], len(ids))
        place[live] = to
        live = fresh = live[to < ends[live]]
        closed += now.take(live)
    rest = np.ones(len(state.click_id), bool)
    rest[at[known]] = False
    after = state.take(rest) + now
    return after.take(np.argsort(after.click_id, kind="stable")), closed


def expiring(batch: int, before: int, origin: int, last: bool) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """A function that folds a shard's rows into its blob and closes what falls behind the watermark, with rows or by its timeout.

    ``batch`` is fed now, ``before`` was the last that had rows: windows behind
    the watermark with which a batch begins closed after ``before``.  Event
    time is in hours from ``origin``; after the ``last`` batch all is over.
    """

    def step(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        windows = Windows.unpack(bytes(state.get[0])) if state.exists else Windows.none()
        over = (windows.start + SPAN - origin) * MS <= watermark
        yield windows.take(over).closed(before)
        windows, parts = windows.take(~over), []
        for part in rows:
            part = part[(part["n"] > 0) & ((part["hour"] - origin) * MS > watermark)]
            if len(part):
                parts.append((*(part[c].to_numpy(np.int64) for c in ("click_id", "hour")), np.frombuffer(b"".join(part["hash"]), ">u8").reshape(-1, 4).astype(np.uint64), *(part[c].to_numpy(np.int64) for c in ("crc", "n"))))
        if parts:
            windows, closed = fold(windows, *(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield closed.closed(batch)
        if last:
            yield windows.closed(batch)
            windows = Windows.none()
        if len(windows.start):
            state.update((windows.pack(),))
            state.setTimeoutTimestamp(int(windows.start.min() + SPAN - origin) * MS)
        elif state.exists:
            state.remove()

    return step


def _hadoop(spark: SparkSession, path: str):
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark._jsc.hadoopConfiguration())


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder within the shared store; false if there is none."""
    a, store = _hadoop(spark, source)
    return store.exists(a) and store.rename(a, _hadoop(spark, target)[0])


def write_batches(rows: DataFrame, folder: str, n_batches: int) -> int | None:
    """Folders ``batch=k`` of rows of ROW, the last with a closing row for each shard; the origin of event time."""
    spark = rows.sparkSession
    ends = rows.agg(F.min("place"), F.max("place"), F.min("hour"), F.max("hour"), F.count("*")).first()
    if not ends[4]:
        return None
    low, high, least, last, count = map(int, ends)
    shards, origin = max(LEAST_SHARDS, -(-count // SHARD_ROWS)), least - HEAD
    batch = F.floor((F.col("place") - low) * n_batches / (high - low + 1)).cast("int")
    shard = F.pmod(F.xxhash64("click_id"), F.lit(shards)).cast("int")
    own = rows.groupBy(batch.alias("batch"), shard.alias("shard"), "click_id", "hour", "hash", "crc").agg(F.count("*").alias("n"))
    none = F.lit(0).cast("long")
    end = spark.range(shards).select(F.lit(n_batches - 1).alias("batch"), F.col("id").cast("int").alias("shard"), none.alias("click_id"), F.lit(last).cast("long").alias("hour"), F.unhex(F.lit("00" * 32)).alias("hash"), none.alias("crc"), none.alias("n"))
    # a task writes a file for each batch: small partitions are put together first
    tasks = max(spark.sparkContext.defaultParallelism, -(-count // SHARD_ROWS))
    own.unionByName(end).coalesce(tasks).write.partitionBy("batch").parquet(folder)
    return origin


def dedupe_clicks(clicks: DataFrame, n_batches: int = BATCHES) -> DataFrame:
    """click_id, start_hour, closed_batch, n_repeats, n_conflicts, conflict_crc, hash of every window of every click.

    Runs the stream and returns what its sink, a folder under the checkpoint
    folder, then holds; the batches and the checkpoint are deleted.
    """
    spark = clicks.sparkSession
    checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/clicks-{uuid.uuid4().hex}"
    shown = ("click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", F.lower(F.hex("hash")).alias("hash"))
    origin = write_batches(copies(clicks), f"{base}/staged", n_batches)
    if origin is None:
        return spark.createDataFrame([], CLOSED).select(*shown)
    landing, shared = _hadoop(spark, f"{base}/landing")
    shared.mkdirs(landing)
    store = "spark.sql.streaming.stateStore"
    settings = {
        # each RocksDB that is opened leaves memory outside the heap that isn't given back, and each start opens one for every partition
        f"{store}.providerClass": STORE,
        # each start loads the state anew: a store that stays open after its commit would only hold memory
        f"{store}.unloadOnCommit": "true",
        # a commit leaves checksums to the shared folder's file system
        "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
        # timeouts that are due when a batch ends fire as the next begins
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    were = {k: spark.conf.get(k, None) for k in settings}
    before = -1
    try:
        for k in range(n_batches):
            for name, value in settings.items():
                spark.conf.set(name, value)
            if not _move(spark, f"{base}/staged/batch={k}", f"{base}/landing/batch={k}"):
                continue
            stamp = F.timestamp_seconds((F.col("hour") - origin) * 3600)
            fed = spark.readStream.schema(ROW).parquet(f"{base}/landing/*").withColumn("event", stamp).withWatermark("event", f"{LATE} hours 1 millisecond")
            found = fed.groupBy("shard").applyInPandasWithState(expiring(k, before, origin, k == n_batches - 1), CLOSED, "blob binary", "append", GroupStateTimeout.EventTimeTimeout)
            query = found.writeStream.format("parquet").option("path", f"{base}/windows").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
            query.awaitTermination()
            before = k
    finally:
        for name, value in were.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    for part in ("staged", "landing", "state"):
        remove_folder(spark, f"{base}/{part}")
    return spark.read.schema(CLOSED).parquet(f"{base}/windows").select(*shown)
