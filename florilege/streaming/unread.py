"""Unread comments and activity as streams.

Beyond the batch views: the same joins run over files as they arrive.
``windowed_activity`` bounds its state by a watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Events of a folder's Parquet files as a stream; local timestamps become instants, which watermarks need."""
    df = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def comments(df: DataFrame) -> DataFrame:
    return df.filter("event_type = 'click'").select(
        F.col("event_id").alias("comment_id"), (F.col("event_id") % 200).alias("segment_id"), F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string")).alias("author"), F.col("ts").alias("created_at")
    )


def unread(stream: DataFrame, people: DataFrame, state: DataFrame) -> DataFrame:
    """Comments that participants have not seen, joined with static people and read marks."""
    own = state.select("segment_id", F.col("reader").alias("user"), "last_read_at")
    joined = stream.join(people, "segment_id").filter("author <> user").join(own, ["segment_id", "user"], "left")
    return joined.filter(F.col("last_read_at").isNull() | (F.col("created_at") > F.col("last_read_at"))).select("user", "segment_id", "comment_id", "author", "created_at")


def windowed_activity(df: DataFrame, length: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events per window and type; late ones count until the watermark passes."""
    return df.withWatermark("ts", late).groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(df: DataFrame, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    return df.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that is there, in micro-batches, then end; ``sink`` gets each batch, its id tells repeats."""
    query = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
