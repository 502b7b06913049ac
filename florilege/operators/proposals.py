"""Proposals for changes of senses: validation as one chain of conditions over joins, no look-up per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def locked_terms(usage: DataFrame, senses: DataFrame) -> DataFrame:
    """segment_id, sense_id that bind a segment: a usage that isn't rejected, of an approved sense with a rendering."""
    bound = senses.filter((F.col("status") == "approved") & F.col("content").isNotNull()).select("sense_id")
    return usage.filter("status <> 'rejected'").select("segment_id", "sense_id").join(bound, "sense_id", "left_semi").distinct()


def validate(proposals: DataFrame, senses: DataFrame, locked: DataFrame) -> DataFrame:
    """Adds ``reason``: ok or what is wrong.

    ``proposals``: proposal_id, kind (rendering, sense_here, remove_here,
    retire_sense), sense_id, target_id, content, segment_id.  ``senses``: their
    ``content`` is the rendering that holds.  ``locked``: segment_id, sense_id
    that a segment is bound to (see ``locked_terms``).  A ``sense_here`` names
    another sense of the term, or else a text of its own.
    """
    own = senses.select("sense_id", F.col("term_id").alias("_term"), F.col("content").alias("_now"))
    target = senses.select(F.col("sense_id").alias("target_id"), F.col("term_id").alias("_target_term"))
    bound = locked.select("segment_id", "sense_id").distinct().withColumn("_bound", F.lit(True))
    joined = proposals.join(own, "sense_id", "left").join(target, "target_id", "left").join(bound, ["segment_id", "sense_id"], "left")
    kind, pointed = F.col("kind"), F.col("target_id").isNotNull()
    blank = F.coalesce(F.col("content") == "", F.lit(True))
    same = F.col("content") == F.coalesce("_now", F.lit(""))
    here = kind == "sense_here"
    reason = (
        F.when(F.col("_term").isNull(), "not_found")
        .when((kind == "rendering") & blank, "proposed_sk_required")
        .when((kind == "rendering") & same, "no_change")
        .when(kind.isin("sense_here", "remove_here") & F.col("_bound").isNull(), "not_locked_here")
        .when(here & pointed & (F.col("target_id") == F.col("sense_id")), "no_change")
        .when(here & pointed & ~F.coalesce(F.col("_target_term") == F.col("_term"), F.lit(False)), "wrong_term")
        .when(here & ~pointed & blank, "missing_target")
        .when(here & ~pointed & same, "no_change")
        .otherwise("ok")
    )
    return joined.withColumn("reason", reason).select(*proposals.columns, "reason")


#: Kinds that change a sense everywhere, and kinds of one segment.
SENSE_WIDE, PER_SEGMENT = ("rendering", "retire_sense"), ("sense_here", "remove_here")


def _joined(proposals: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """A left join in which proposals without a key, which have no partner, are dealt over the tasks by their ids."""
    own = proposals.withColumn("_deal", F.when(F.col(key).isNull(), F.xxhash64("proposal_id")).otherwise(F.lit(0).cast("bigint")))
    return own.join(other.withColumn("_deal", F.col(key).cast("bigint") % 1), [key, "_deal"], "left").drop("_deal")


def display(proposals: DataFrame, senses: DataFrame, segments: DataFrame, radius: DataFrame) -> DataFrame:
    """Proposals (proposal_id, kind, sense_id, target_id, origin, snapshot) as they are shown.

    ``label`` of the sense; ``target_label`` and ``target_content`` of a target
    of the same term; ``locator`` of the segment for kinds of one segment;
    ``live``, the rendering that holds now, and ``drift`` from the one that the
    proposal has seen; for kinds that change a sense everywhere the counts of
    ``radius`` (sense_id, ...), 0 where it has no row.
    """
    counts = [c for c in radius.columns if c != "sense_id"]
    own = senses.select("sense_id", F.col("term_id").alias("_term"), "label", F.col("content").alias("live"))
    target = senses.select(F.col("sense_id").alias("target_id"), F.col("term_id").alias("_target_term"), F.col("label").alias("_label"), F.col("content").alias("_content"))
    place = segments.select(F.col("segment_id").alias("origin"), F.col("path").alias("_path"))
    p = _joined(proposals, own, "sense_id")
    p = _joined(p, radius.select("sense_id", F.struct(*counts).alias("_r")), "sense_id")
    p = _joined(_joined(p, target, "target_id"), place, "origin")
    same, wide = F.col("_term") == F.col("_target_term"), F.col("kind").isin(*SENSE_WIDE) & F.col("sense_id").isNotNull()
    return p.select(
        *proposals.columns, "label", F.when(same, F.col("_label")).alias("target_label"), F.when(same, F.col("_content")).alias("target_content"), F.when(F.col("kind").isin(*PER_SEGMENT), F.col("_path")).alias("locator"), "live",
        (F.col("_term").isNotNull() & ~F.col("live").eqNullSafe(F.col("snapshot"))).alias("drift"), *(F.when(wide, F.coalesce(f"_r.{c}", F.lit(0))).alias(c) for c in counts),
    )


def constraints_block(rows: DataFrame) -> DataFrame:
    """Per required text and label: the distinct surfaces, sorted, in one line."""
    return rows.groupBy("required", "label").agg(F.array_join(F.array_sort(F.collect_set("surface")), ", ").alias("surfaces"))
