"""Neighbours, numbering, paging, batches, universes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florilege.store import computed_once


def _ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``_part``, the number of their range in the order, and ``_tie``, by which rows of one place are told apart.

    Ranges are drawn from a sample, and adaptive execution merges them: two
    reads may cut them differently.  So the rows are computed once with their
    range's number.  The tie deals rows of one frequent place over ranges.
    """
    told = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    own = rows.withColumn("_tie", F.xxhash64(*told)).repartitionByRange(*order, "_tie").withColumn("_part", F.spark_partition_id())
    return computed_once(own)


def neighbours(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """Previous and next value in a global order.

    Rows are range-partitioned by the order and numbered within ranges; only
    one count and the edge rows of each range meet, so no task sees them all.
    """
    own = _ranged(rows.select(*order, value), order)
    full = [*order, "_tie"]
    w = Window.partitionBy("_part").orderBy(*full)
    inside = own.withColumn("before", F.lag(value).over(w)).withColumn("after", F.lead(value).over(w)).withColumn("first", F.lag(F.lit(1)).over(w).isNull()).withColumn("last", F.lead(F.lit(1)).over(w).isNull())
    edges = own.groupBy("_part").agg(F.min_by(value, F.struct(*full)).alias("lead"), F.max_by(value, F.struct(*full)).alias("trail"))
    g = Window.orderBy("_part")  # one row per range
    edges = edges.select("_part", F.lag("trail").over(g).alias("from_before"), F.lead("lead").over(g).alias("from_after"))
    joined = inside.join(F.broadcast(edges), "_part")
    return joined.select(*order, value, F.when(F.col("first"), F.col("from_before")).otherwise(F.col("before")).alias("previous"), F.when(F.col("last"), F.col("from_after")).otherwise(F.col("after")).alias("next"))


def number_within(rows: DataFrame, group: str, order: str, name: str = "number") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(order)).cast("bigint"))


def inherit_number(rows: DataFrame, numbered: DataFrame, link: str, key: str) -> DataFrame:
    """Rows take the number of the row they link to; null without one."""
    return rows.join(numbered.select(F.col(key).alias(link), "number"), link, "left")


def page(rows: DataFrame, stamp: str, key: str, size: int, before=None) -> DataFrame:
    """Latest rows before a stamp: a filter and a top-k, no offset."""
    rows = rows.filter(F.col(stamp) < before) if before is not None else rows
    return rows.orderBy(F.col(stamp).desc(), F.col(key).desc()).limit(size)


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Place of each row (0, 1, ...) in sorted order, by counts per range: no window over all rows.

    Rows of one place are numbered in an order of their own; every row keeps
    all its columns and gets a number that no other has.
    """
    own = _ranged(rows, order)
    counts = own.groupBy("_part").agg(F.count("*").alias("n"))
    base = counts.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    at = F.col("_base") + F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_tie")) - 1
    return own.join(F.broadcast(base), "_part").withColumn(name, at.cast("bigint")).drop("_part", "_base", "_tie")  # one row per range


def batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    """Batch number of each row in sorted order."""
    return numbered(rows, [order], "batch").withColumn("batch", F.floor(F.col("batch") / size).cast("bigint"))


def absent(universe: tuple[int, int], present: DataFrame, column: str) -> DataFrame:
    """Numbers of a range that do not occur."""
    spark = present.sparkSession
    return spark.range(universe[0], universe[1] + 1).withColumnRenamed("id", column).join(present.select(column).distinct(), column, "left_anti")
