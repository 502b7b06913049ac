"""Vector bin packing of documents into shards: bytes, tokens and rows together.

Rows with equal texts are a group and stay together while the group is at most
half of a shard in bytes, tokens and rows; a larger one is split by row, its
rows being numbered and dealt in turn, so that equal rows spread as well.
Groups are placed in order of size, each into the shard where the dot product
of its vector with the shard's residual capacity is highest; bytes weigh most,
as the law that holds is that of near equal ``bytes``.

Groups over 1 / ``LARGE`` of a shard, and pieces of split ones, are placed
first, by the driver: 3 * shards * LARGE groups at most, whatever the input.
All others are dealt by hash into buckets of about ``BUCKET`` groups.  A bucket
places its groups by itself, against its share of the capacity that the large
ones left in each shard; as every bucket ends near equal, so does the whole.
Slots are numbered within parts of a shard, whose row counts, ``PARTS`` a shard
at most, give each part its first slot.

A null text is empty (8 bytes, no token).  Repeated rows are rows; null ids
sort first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florilege.llm.shared import materialize

LARGE, BUCKET, PARTS, PART_ROWS = 32, 20_000, 4096, 50_000
WEIGHTS = (40.0, 1.0, 1.0)


def place(vectors: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS, residual: np.ndarray | None = None, unit: np.ndarray | None = None, first: int = 0) -> np.ndarray:
    """Shard of each item; ``vectors``: items x dimensions.

    ``unit`` is a shard's capacity, by default an equal share of the sum;
    ``residual`` (shards x dimensions) what is left of it, by default all, and
    is brought up to date.  Ties go to the shard that follows ``first``.
    """
    unit = vectors.sum(axis=0) / shards if unit is None else unit
    share = vectors / np.where(unit > 0, unit, 1)
    residual = np.ones((shards, vectors.shape[1])) if residual is None else residual
    scale = np.array(weights)
    turn = np.roll(np.arange(shards), -first)
    out = np.zeros(len(vectors), np.int64)
    for at in np.argsort(-np.round((share * scale).sum(axis=1), 9), kind="stable"):
        out[at] = best = int(turn[np.argmax(np.round(residual @ (share[at] * scale), 9)[turn])])  # rounded, so that ties are ties
        residual[best] -= share[at]
    return out


def _bucket(shards: int, free: np.ndarray):
    """Places the groups of one bucket; ``free`` (shards x 3) is each shard's part of what large groups left."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        vectors = np.stack([t.column(c).to_numpy().astype(float) for c in ("b", "t", "r")], axis=1)
        own = vectors.sum(axis=0)
        residual = free * shards  # of this bucket's sum, in units of an equal share
        shard = place(vectors, shards, residual=residual, unit=own / shards, first=t.column("bucket")[0].as_py() % shards)
        return pa.table([t.column("key"), pa.array(shard, pa.int32())], names=["key", "shard"])

    return run


def assign_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard of each row of ``docs``.

    ``tokens`` counts a row's tokens; by default its space-separated pieces.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = F.when(text == "", 0).otherwise(F.size(F.split(text, " ", -1))) if tokens is None else tokens
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        tokens.cast("bigint").alias("tokens"), F.unhex(F.md5(text.cast("binary"))).alias("key"), F.monotonically_increasing_id().alias("row"),
    ))
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")))
    found = groups.agg(F.sum("b"), F.sum("t"), F.sum("r"), F.count("*")).first()
    total, n_groups = np.array([x or 0 for x in found[:3]], float), found[3]
    bound = [max(1.0, x / shards / LARGE) for x in total]
    over = (F.col("b") > bound[0]) | (F.col("t") > bound[1]) | (F.col("r") > bound[2])
    large = sorted(groups.filter(over).collect(), key=lambda x: bytes(x.key))  # 3 * shards * LARGE at most

    # items that the driver places: large groups, and pieces of those over half a shard
    items, vectors = [], []
    for x in large:
        vector = np.array([x.b, x.t, x.r], float)
        whole = (vector * shards <= 0.5 * np.maximum(total, 1)).all()
        pieces = 1 if whole else max(1, min(x.r, math.ceil(max(vector / bound))))
        items += [(bytes(x.key), pieces, k) for k in range(pieces)]
        vectors += [vector / pieces] * pieces
    residual = np.ones((shards, 3))
    shard_of = place(np.array(vectors, float).reshape(-1, 3), shards, residual=residual, unit=np.maximum(total, 1) / shards)
    table = spark.createDataFrame([(*x, int(s)) for x, s in zip(items, shard_of)], "key binary, pieces int, piece int, shard int")
    deal = rows.join(F.broadcast(table.select("key", "pieces").distinct()), "key")
    chunk = F.shiftright("row", 33)  # the partition that the row was read in: no window sees more of a group
    turn = F.row_number().over(Window.partitionBy("key", chunk).orderBy("row")) + F.pmod(F.xxhash64(chunk), F.col("pieces"))
    split = deal.filter("pieces > 1").withColumn("piece", F.pmod(turn, F.col("pieces")).cast("int"))
    of_large = deal.filter("pieces = 1").withColumn("piece", F.lit(0)).union(split).join(F.broadcast(table), ["key", "pieces", "piece"])

    free = np.maximum(residual, 0)
    free = free / np.where(free.sum(axis=0) > 0, free.sum(axis=0), 1)
    buckets = max(1, math.ceil(n_groups / BUCKET))
    small = groups.filter(~over).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    of_small = rows.join(small.groupBy("bucket").applyInArrow(_bucket(shards, free), "key binary, shard int"), "key")

    parts = max(1, min(PARTS, math.ceil(total[2] / shards / PART_ROWS)))
    columns = ["id", "size", "crc", "shard", "row", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part")]
    placed = materialize(of_large.select(*columns).union(of_small.select(*columns)))
    counts = {(x.shard, x.part): x["count"] for x in placed.groupBy("shard", "part").count().collect()}  # shards * PARTS at most
    begin, next_slot = [], dict.fromkeys(range(shards), 0)
    for (shard, part), n in sorted(counts.items()):
        begin.append((shard, part, next_slot[shard]))
        next_slot[shard] += n
    placed = placed.join(F.broadcast(spark.createDataFrame(begin, "shard int, part int, begin bigint")), ["shard", "part"])
    order = Window.partitionBy("shard", "part").orderBy("id", "crc", "size", "row")
    return placed.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("begin") + F.row_number().over(order) - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
