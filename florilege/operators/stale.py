"""Usages made with an older version of their sense, and what follows from a change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stale_segments(usage: DataFrame, sense: DataFrame) -> DataFrame:
    """Distinct segments with a usage, not rejected, of an older version than the sense's."""
    current = sense.select("sense_id", "version")
    return usage.filter("status <> 'rejected'").join(current, "sense_id").filter("used < version").select("segment_id").distinct()


def fresh_segments(segments: DataFrame, usage: DataFrame, sense: DataFrame) -> DataFrame:
    """Segments without any stale usage: the stale set first, then an equi anti join."""
    return segments.join(stale_segments(usage, sense), "segment_id", "left_anti")


def blast_radius(usage: DataFrame, segments: DataFrame, reviews: DataFrame, sense: DataFrame) -> DataFrame:
    """Per sense: segments it touches, by status, reviewed ones, and those that no change has made stale yet."""
    touched = usage.filter("status <> 'rejected'").select("sense_id", "segment_id").distinct()
    flags = (
        touched.join(segments.select("segment_id", "status"), "segment_id")
        .join(reviews.select("segment_id").distinct().withColumn("reviewed", F.lit(True)), "segment_id", "left")
        .join(stale_segments(usage, sense).withColumn("stale", F.lit(True)), "segment_id", "left")
    )
    counted = lambda c, name: F.count_if(c).alias(name)
    return flags.groupBy("sense_id").agg(
        F.count("*").alias("total"),
        counted(F.col("status") == "translated", "translated"),
        counted(F.col("status") == "needs_human", "needs_human"),
        counted(F.col("status") == "pending", "pending"),
        counted(F.col("reviewed").isNotNull(), "reviewed"),
        counted(F.col("stale").isNull(), "marginal"),
    )


def cost_preview(candidates: DataFrame, human: DataFrame, limit: int | None, per_segment: float) -> DataFrame:
    """How many of the first ``limit`` candidates are paid for, once human-edited ones are left out, and the price."""
    chosen = candidates.orderBy("segment_id")
    chosen = chosen.limit(limit) if limit is not None else chosen
    return chosen.join(human.select("segment_id"), "segment_id", "left_anti").agg(F.count("*").alias("payable")).withColumn("usd", F.round(F.col("payable") * per_segment, 6))


def price_per_segment(last_cost: float | None, last_segments: int, tokens: int = 400, per_thousand: float = 0.00014, zero_cost_is_valid: bool = True) -> float:
    """The last run's price, or the estimate from tokens where there is none (or none but zero)."""
    if last_segments and last_cost is not None and (last_cost > 0 or zero_cost_is_valid):
        return last_cost / last_segments
    return tokens / 1000 * per_thousand


def guard_and_reset(segments: DataFrame, stale: DataFrame, human: DataFrame) -> DataFrame:
    """New status of segments: stale ones go to pending, their notes with them, or to needs_human with a note where a person has edited them; others keep theirs."""
    marked = segments.join(stale.select("segment_id").distinct().withColumn("_stale", F.lit(True)), "segment_id", "left")
    marked = marked.join(human.select("segment_id").distinct().withColumn("_human", F.lit(True)), "segment_id", "left")
    guarded = F.col("_stale").isNotNull() & F.col("_human").isNotNull()
    status = F.when(guarded, "needs_human").when(F.col("_stale").isNotNull(), "pending").otherwise(F.col("status"))
    note = F.col("note") if "note" in segments.columns else F.lit(None).cast("string")
    note = F.when(guarded, "edited by a person").when(F.col("_stale").isNull(), note)
    return marked.withColumn("status", status).withColumn("note", note).drop("_stale", "_human")


def drop_polished(polished: DataFrame, stale: DataFrame, human: DataFrame) -> DataFrame:
    """Polished texts without those of segments that ``guard_and_reset`` sends back to pending."""
    reset = stale.select("segment_id").distinct().join(human.select("segment_id"), "segment_id", "left_anti")
    return polished.join(reset, "segment_id", "left_anti")
