"""Counts and roll-ups of segments, usages, comments and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _status(value: str) -> Column:
    return F.count_if(F.col("status") == value).alias(value)


def article_progress(segments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per article: segments by status, reviewed ones and all; reviews are one row per segment at most."""
    own = reviews.select("segment_id", F.col("reviewer").alias("by"))
    return segments.join(own, "segment_id", "left").groupBy("pars", "question_path", "article_path", "a_num").agg(
        _status("translated"), _status("needs_human"), _status("pending"), F.count("by").alias("reviewed"), F.count("*").alias("total")
    )


def questions_by_status(segments: DataFrame, order: DataFrame, status: str) -> DataFrame:
    """Questions with segments of a status; parts without a place come last (9999)."""
    found = segments.filter(F.col("status") == status).join(order, "pars", "left")
    return found.groupBy("pars", "question_path").agg(F.count("*").alias("n"), F.coalesce(F.max("ordinal"), F.lit(9999)).cast("bigint").alias("ordinal"))


def progress(segments: DataFrame, reviews: DataFrame) -> DataFrame:
    """All segments by status and reviewed, in one row: the EXISTS is a semi-join flag."""
    own = reviews.select("segment_id").distinct().withColumn("seen", F.lit(True))
    return segments.join(own, "segment_id", "left").agg(
        F.count("*").alias("total"), _status("translated"), _status("needs_human"), _status("pending"), F.count("seen").alias("reviewed")
    )


def dedup_rollup(usage: DataFrame, sense: DataFrame, segments: DataFrame) -> DataFrame:
    """Per term, label and rendering: frequency, worst confidence, methods, locators by path."""
    joined = usage.filter("status <> 'rejected'").join(sense.select("sense_id", "term", "label", "content"), "sense_id").join(segments.select("segment_id", "path"), "segment_id")
    return joined.groupBy("term", "label", "content").agg(
        F.count("*").alias("frequency"), F.max("confidence").alias("confidence"),
        F.array_join(F.array_sort(F.collect_set("method")), "|").alias("methods"), F.array_join(F.array_sort(F.collect_set("path")), "|").alias("locators"),
    )


def run_summary(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Average iterations and segments of each run, runs without segments too."""
    return runs.join(rows, "run_id", "left").groupBy("run_id").agg(F.count("segment_id").alias("segments"), F.round(F.avg("iterations"), 6).alias("avg_iterations"), F.count_if(F.col("status") == "needs_human").alias("needs_human"))


def comment_badges(comments: DataFrame, reads: DataFrame, reader: str) -> DataFrame:
    """Per segment: comments, open ones, and those of others since the reader's last visit."""
    own = reads.filter(F.col("reader") == reader).select("segment_id", "last_read_at")
    unread = (F.col("author") != reader) & (F.col("last_read_at").isNull() | (F.col("created_at") > F.col("last_read_at")))
    return comments.join(own, "segment_id", "left").groupBy("segment_id").agg(F.count("*").alias("total"), F.count_if(~F.col("resolved")).alias("open"), F.count_if(unread).alias("unread"))


def thread_state(comments: DataFrame) -> DataFrame:
    return comments.groupBy("segment_id").agg(F.bool_and("resolved").alias("resolved"))


def failure_classes(failures: DataFrame) -> DataFrame:
    """Failures by class and term, from a JSON array of objects; null and empty arrays have none."""
    each = failures.select("run_id", F.explode(F.from_json("classes", "array<struct<class:string,term:string>>")).alias("f"))
    name = F.when(F.col("f.term").isNull(), F.col("f.class")).otherwise(F.concat("f.class", F.lit("("), "f.term", F.lit(")")))
    return each.groupBy("run_id", name.alias("failure")).agg(F.count("*").alias("n"))


def compare_runs(counts: DataFrame, key: str, a: int, b: int) -> DataFrame:
    """Counts of two runs side by side, 0 where one has none, with the change."""
    side = lambda run, name: counts.filter(F.col("run_id") == run).select(key, F.col("n").alias(name))
    both = side(a, "n_a").join(side(b, "n_b"), key, "full_outer").fillna(0, ["n_a", "n_b"])
    change = F.col("n_b") - F.col("n_a")
    return both.withColumn("change", change).withColumn("sign", F.when(change > 0, "▲").when(change < 0, "▼").otherwise("="))


def flips(rows: DataFrame, a: int, b: int) -> DataFrame:
    """Segments whose status differs between two runs."""
    x, y = (rows.filter(F.col("run_id") == r).select("segment_id", F.col("status").alias(n)) for r, n in ((a, "status_a"), (b, "status_b")))
    return x.join(y, "segment_id").filter("status_a <> status_b")


def coverage(segments: DataFrame, texts: DataFrame, lang: str) -> DataFrame:
    """with, total of a language; see ``uncovered`` for those without."""
    own = texts.filter(F.col("lang") == lang).select("segment_id").distinct().withColumn("has", F.lit(True))
    return segments.select("segment_id").join(own, "segment_id", "left").agg(F.count("has").alias("with"), F.count("*").alias("total"))


def uncovered(segments: DataFrame, texts: DataFrame, lang: str) -> DataFrame:
    """Segments without a text of a language, as rows."""
    return segments.select("segment_id").join(texts.filter(F.col("lang") == lang).select("segment_id"), "segment_id", "left_anti")


def text_volume(texts: DataFrame) -> DataFrame:
    return texts.groupBy("lang").agg(F.sum(F.length("content")).alias("chars"))


def token_cost(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Price of each row by its model's rates per million; a row of a model without rates is an error when it is computed."""
    unknown = F.raise_error(F.concat(F.lit("no rates for "), F.coalesce("model", F.lit("null")))).cast("double")
    cost = (F.col("input") * F.col("input_rate") + F.col("cached") * F.col("cached_rate") + F.col("output") * F.col("output_rate")) / 1e6
    joined = rows.join(F.broadcast(rates.withColumn("_known", F.lit(True))), "model", "left")  # a row per model; by the model, a few tasks would get all rows
    return joined.withColumn("usd", F.when(F.col("_known"), F.round(cost, 6)).otherwise(unknown)).drop("_known")


def assert_rates(needs_human: float, avg_iterations: float, most_human: float = 0.20, most_iterations: float = 2.5) -> None:
    """Ends a run whose rates are over the thresholds."""
    if needs_human > most_human or avg_iterations > most_iterations:
        raise RuntimeError(f"needs_human {needs_human:.2%} or iterations {avg_iterations:.2f} over the threshold")
