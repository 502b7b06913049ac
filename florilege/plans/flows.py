"""Draft, check and review of segments through a replaceable model, and resumable batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.operators.terms import term_check
from florilege.store import computed_once


class ModelBackend(Protocol):
    """What a flow asks of a model.  Instances are sent to workers."""

    def draft(self, source: str, feedback: list[str]) -> str: ...

    def review(self, source: str, draft: str) -> tuple[str, str]: ...


@dataclass
class EchoModel:
    """Deterministic stand-in: a draft repeats its source; a review passes drafts that hold ``must``."""

    must: str = ""

    def draft(self, source: str, feedback: list[str]) -> str:
        return source + "".join(f" {f}" for f in feedback)

    def review(self, source: str, draft: str) -> tuple[str, str]:
        return ("PASS", "") if self.must in draft else ("REVISE", self.must)


def replay(log: DataFrame) -> DataFrame:
    """State of each segment from an append-only log (segment_id, iteration, kind, verdict, draft): the last passing draft, else the last."""
    ordered = log.filter("draft is not null").groupBy("segment_id").agg(
        F.max("iteration").alias("iterations"),
        F.max_by("draft", F.when(F.col("verdict") == "PASS", F.col("iteration"))).alias("passed"),
        F.max_by("draft", "iteration").alias("latest"),
    )
    return ordered.select("segment_id", "iterations", F.when(F.col("passed").isNotNull(), "translated").otherwise("needs_human").alias("status"), F.coalesce("passed", "latest").alias("draft"))


def pending_batches(candidates: DataFrame, done: DataFrame, size: int) -> DataFrame:
    """Batches of what is not done yet, so that a run that broke off goes on."""
    from florilege.operators.navigation import batches

    return batches(candidates.join(done.select("segment_id"), "segment_id", "left_anti"), "segment_id", size)


def gained(before: DataFrame, after: DataFrame, targets: DataFrame, translated: DataFrame) -> DataFrame:
    """term_id, segment_id: translated segments that a run of the resolver has bound to terms that had no usage.

    ``before`` and ``after``: segment_id, sense_id of its output; ``targets``:
    term_id, sense_id of newly approved terms.  Terms with a usage before are
    left out; the others have no row in ``before``, so that all that they have in
    ``after`` is what the run has added, and the snapshots needn't be compared.
    """
    used = before.select("sense_id").distinct().join(targets, "sense_id").select("term_id").distinct()
    fresh = targets.join(used, "term_id", "left_anti")
    found = after.join(fresh, "sense_id").select("term_id", "segment_id").distinct()
    return found.join(translated.select("segment_id"), "segment_id", "left_semi").select("term_id", "segment_id")


CLASSES = "array<struct<round:int,class:string,term:string>>"


def _calls(rows: DataFrame, model: ModelBackend, what: str, schema: str) -> DataFrame:
    """A model's answers to rows; an error of the model is an answer too."""

    def draft(row) -> dict:
        try:
            return {"draft": model.draft(row["content"], list(row["said"]))}
        except Exception:  # a model's failure is a result of its segment, not of the job
            return {"draft": None}

    def review(row) -> dict:
        for attempt in range(2):
            try:
                verdict, feedback = model.review(row["content"], row["draft"])
                return {"verdict": verdict, "feedback": feedback, "failed": attempt > 0}
            except Exception:
                continue
        return {"verdict": None, "feedback": None, "failed": True}

    ask, names = {"draft": draft, "review": review}[what], [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([{"segment_id": row["segment_id"], **ask(row)} for row in frame.to_dict("records")], columns=names)

    return rows.mapInPandas(run, schema)


def draft_rounds(segments: DataFrame, constraints: DataFrame, forms: DataFrame, model: ModelBackend, most: int = 3) -> DataFrame:
    """segment_id, status, rounds, chosen, draft, classes, feedback after up to ``most`` rounds of draft, check and review.

    ``segments``: segment_id (unique), content.  ``constraints``: segment_id,
    required, category.  A round is a job over the segments still open: drafts
    by the model, the terminology check as joins, a review only of drafts that
    pass it, and the next round's rows without those that are done.  Feedback
    is what the check misses, or what the reviewer says.

    A pass (PASS) ends with that draft.  Else the last draft that passed the
    check is kept for a person, or the last draft at all; without any draft
    the segment is left pending.  A segment without text asks for a person at
    once.  Errors of drafting end a segment's rounds; a review is tried twice.
    """
    given = segments.select("segment_id", F.coalesce("content", F.lit("")).alias("content"))
    no_class = F.array().cast(CLASSES)
    start = given.select(
        "segment_id", "content", F.array().cast("array<string>").alias("said"), F.lit(0).alias("rounds"), F.lit(None).cast("string").alias("passed"), F.lit(None).cast("int").alias("passed_at"),
        F.lit(None).cast("string").alias("latest"), F.lit(None).cast("int").alias("latest_at"), no_class.alias("classes"), F.lit(None).cast("string").alias("feedback"),
    )
    note = lambda k, name, term=None: F.array(F.struct(F.lit(k).alias("round"), F.lit(name).alias("class"), (F.lit(None).cast("string") if term is None else term).alias("term")))
    empty = F.col("content") == ""
    done = [start.filter(empty).withColumns({"status": F.lit("needs_human"), "classes": note(0, "no_source_text")})]
    open_ = computed_once(start.filter(~empty))
    for k in range(1, most + 1):
        if open_.isEmpty():
            break
        drafts = computed_once(_calls(open_.select("segment_id", "content", "said"), model, "draft", "segment_id bigint, draft string"))
        drafted = drafts.filter("draft IS NOT NULL")
        # not one draft is gathered: the check looks for the words that a segment's terms need
        missed = term_check(drafted.withColumnRenamed("draft", "content"), constraints, forms).filter("NOT ok").groupBy("segment_id").agg(F.array_sort(F.collect_set("required")).alias("missed"))
        checked = computed_once(open_.join(drafts, "segment_id").join(missed, "segment_id", "left").withColumn("rounds", F.lit(k)))
        fine = checked.filter("draft IS NOT NULL AND missed IS NULL")
        told = _calls(fine.select("segment_id", "content", "draft"), model, "review", "segment_id bigint, verdict string, feedback string, failed boolean").withColumnRenamed("feedback", "_told")
        r = checked.join(computed_once(told), "segment_id", "left")
        good = F.col("draft").isNotNull() & F.col("missed").isNull()
        passed = F.col("verdict") == "PASS"
        more = (
            F.when(F.col("draft").isNull(), note(k, "translator_error")).when(F.col("missed").isNotNull(), F.transform("missed", lambda t: note(k, "precheck_terminology", t)[0]))
            .otherwise(F.concat(F.when(F.col("failed"), note(k, "reviewer_error")).otherwise(no_class), F.when(F.col("verdict").isNotNull() & ~passed, note(k, "reviewer_revision")).otherwise(no_class)))
        )
        said = F.when(F.col("missed").isNotNull(), F.array_join("missed", ", ")).when(F.col("verdict").isNotNull() & ~passed, F.nullif("_told", F.lit("")))
        r = r.withColumns(
            {
                "passed": F.when(good, F.col("draft")).otherwise(F.col("passed")), "passed_at": F.when(good, F.lit(k)).otherwise(F.col("passed_at")), "latest": F.coalesce("draft", "latest"), "latest_at": F.when(F.col("draft").isNotNull(), F.lit(k)).otherwise(F.col("latest_at")),
                "classes": F.concat("classes", more), "_said": said, "_over": F.coalesce(passed, F.lit(False)), "feedback": F.when(F.coalesce(passed, F.lit(False)), F.lit(None).cast("string")).when(F.col("verdict").isNotNull() | F.col("missed").isNotNull(), said).otherwise(F.col("feedback")),
            }
        )
        r = computed_once(r.withColumn("said", F.when(F.col("_said").isNotNull(), F.concat("said", F.array("_said"))).otherwise(F.col("said"))))
        goes_on = ~F.col("_over") & F.col("_said").isNotNull() & F.lit(k < most)
        ended = F.when(F.col("_over"), "translated").when(F.coalesce("passed", "latest").isNull(), "pending").otherwise("needs_human")
        done.append(r.filter(~goes_on).withColumn("status", ended).select(*start.columns, "status"))
        open_ = r.filter(goes_on).select(*start.columns)
    out = reduce(DataFrame.unionByName, done)
    return out.select("segment_id", "status", "rounds", F.coalesce("passed_at", "latest_at").alias("chosen"), F.coalesce("passed", "latest").alias("draft"), "classes", "feedback")
