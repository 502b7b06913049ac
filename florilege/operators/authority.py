"""Winners by authority, language pivots, synonym groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_by_authority(df: DataFrame, keys: list[str], rank: list[str], values: list[str]) -> DataFrame:
    """The row of least rank of each key, by one aggregation (map-side combined, no sort); ``rank`` must break ties."""
    best = F.min_by(F.struct(*values), F.struct(*rank)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"best.{v}").alias(v) for v in values))


def pivot_winners(df: DataFrame, key: str, kind: str, kinds: list[str], value: str, rank: list[str]) -> DataFrame:
    """One column per kind with the winning value, in one pass over the rows."""
    return df.groupBy(key).agg(*(F.min_by(value, F.when(F.col(kind) == k, F.struct(*rank))).alias(k) for k in kinds))


def pivot_max(df: DataFrame, key: str, columns: dict[str, tuple[Column, str]]) -> DataFrame:
    """Conditional maxima: name -> (condition, value)."""
    return df.groupBy(key).agg(*(F.max(F.when(c, F.col(v))).alias(n) for n, (c, v) in columns.items()))


def synonym_groups(df: DataFrame, partition: str, order: str, name: str = "group_id") -> DataFrame:
    """Dense rank of a content within a category, nulls last."""
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(partition).orderBy(F.col(order).asc_nulls_last())).cast("bigint"))


def mode_of(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value of each key, the least of equals."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).count()
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("count"), F.col(value))).alias("mode"))


def nested(df: DataFrame, key: str, items: list[str], name: str) -> DataFrame:
    """Rows of a key as an array of structs in order of ``items``."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*items))).alias(name))
