"""Feeds, participants, unread counts and digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feed(*sources: DataFrame) -> DataFrame:
    """Events of unlike sources in one table, absent columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def participants(comments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct (segment, user) of those who wrote or reviewed."""
    return comments.select("segment_id", F.col("author").alias("user")).union(reviews.select("segment_id", "reviewer")).distinct()


def unseen(comments: DataFrame, people: DataFrame, reads: DataFrame, notified: DataFrame | None = None) -> DataFrame:
    """Comments by others on a participant's segments since the later of their last read and last notice."""
    state = reads.select("segment_id", F.col("reader").alias("user"), "last_read_at")
    joined = comments.join(people, "segment_id").filter("author <> user").join(state, ["segment_id", "user"], "left")
    mark = F.col("last_read_at")
    if notified is not None:
        joined = joined.join(notified.select("segment_id", "user", "last_notified_at"), ["segment_id", "user"], "left")
        mark = F.greatest("last_read_at", "last_notified_at")
    return joined.filter(mark.isNull() | (F.col("created_at") > mark)).select("user", "segment_id", "comment_id", "author", "created_at")


def digests(rows: DataFrame) -> DataFrame:
    """Per user and segment: number and comment ids in order of time."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("created_at", "comment_id"))), lambda x: x["comment_id"].cast("string"))
    return rows.groupBy("user", "segment_id").agg(F.count("*").alias("n"), F.array_join(ids, ",").alias("comment_ids"))
