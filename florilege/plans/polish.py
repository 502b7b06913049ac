"""Polishing of texts in batches of an outside service, as a versioned state table.

A candidate becomes an item of a batch and goes through four states, each a
commit of its own: ``submitted`` (the batch is with the service), ``polled``
(its answer is here), ``guarded`` (kept or refused by the guards), ``written``
(the text is in place).  A run goes on from the last commit: what a step has
done is in the state, what it hadn't committed is done again.  Submissions
carry the batch's key, which is a hash of its segments, so that a service that
sees it again answers with the batch it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.operators.guards import polish_guards
from florilege.operators.mutate import upsert
from florilege.operators.navigation import batches
from florilege.store import TableSet, computed_once


class BatchService(Protocol):
    """What a run asks of a service.  Instances are sent to workers."""

    def submit(self, key: str, rows: list[tuple[int, str]]) -> str:
        """The batch's number; the same for the same key."""

    def poll(self, batch: str) -> dict[int, str] | None:
        """Texts by segment, or none while the batch is under way."""


ITEMS = "segment_id long, batch string, before string, after string, state string"


def _submitted(candidates: DataFrame, items: DataFrame, service: BatchService, size: int) -> DataFrame:
    """Items of candidates (segment_id, text) that aren't items yet."""
    new = candidates.select("segment_id", "text").join(items.select("segment_id"), "segment_id", "left_anti")
    own = computed_once(batches(new, "segment_id", size))  # of ``size`` rows each

    def send(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("segment_id")
        key = str(pd.util.hash_pandas_object(frame["segment_id"], index=False).sum())
        batch = service.submit(key, list(zip(frame["segment_id"].tolist(), frame["text"].tolist(), strict=True)))
        return pd.DataFrame({"segment_id": frame["segment_id"], "batch": batch, "before": frame["text"], "after": None, "state": "submitted"})

    return items.unionByName(own.groupBy("batch").applyInPandas(send, ITEMS))


def _polled(items: DataFrame, service: BatchService) -> DataFrame:
    """Items with the answers of batches that are ready; a segment that an answer leaves out keeps its text."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for batch in frame["batch"]:
                found = service.poll(batch)
                if found is not None:
                    rows += [(batch, k, text) for k, text in found.items()] + [(batch, None, None)]
            yield pd.DataFrame({c: pd.Series([r[k] for r in rows], dtype=object) for k, c in enumerate(("batch", "segment_id", "_after"))})

    waiting = items.filter("state = 'submitted'").select("batch").distinct()
    answers = computed_once(waiting.mapInPandas(ask, "batch string, segment_id long, _after string"))
    ready = answers.select("batch", F.lit(True).alias("_ready")).distinct()
    own = items.join(ready, "batch", "left").join(answers.filter("segment_id IS NOT NULL"), ["batch", "segment_id"], "left")
    turn = (F.col("state") == "submitted") & F.col("_ready").isNotNull()
    return own.withColumn("after", F.when(turn, F.coalesce("_after", "before")).otherwise(F.col("after"))).withColumn("state", F.when(turn, "polled").otherwise(F.col("state"))).select("segment_id", "batch", "before", "after", "state")


def _guarded(items: DataFrame, watched: list[str]) -> DataFrame:
    """Polled items whose guards fail keep their text."""
    told = polish_guards(items.filter("state = 'polled'"), "before", "after", watched).select("segment_id", F.col("ok").alias("_ok"))
    own = items.join(told, "segment_id", "left")
    turn = F.col("state") == "polled"
    return own.withColumn("after", F.when(turn & ~F.coalesce("_ok", F.lit(False)), F.col("before")).otherwise(F.col("after"))).withColumn("state", F.when(turn, "guarded").otherwise(F.col("state"))).drop("_ok")


def polish(tables: TableSet, candidates: DataFrame, service: BatchService, watched: list[str], size: int = 100) -> dict[str, int]:
    """Carry a run on as far as it comes; how many items are in each state.

    ``tables`` holds ``item`` and ``polished`` (segment_id, text).  A batch
    that isn't ready is asked for by the next call.  Nothing is done twice:
    an item that is written stays, and a candidate that is an item is none.
    """
    spark = tables.spark
    read, t = tables.read()
    if not read:
        read = tables.commit(0, {"item": spark.createDataFrame([], ITEMS), "polished": spark.createDataFrame([], "segment_id long, text string")})
    steps = (
        lambda t: {"item": _submitted(candidates, t["item"], service, size)},
        lambda t: {"item": _polled(t["item"], service)},
        lambda t: {"item": _guarded(t["item"], watched)},
        lambda t: {
            "polished": upsert(t["polished"], t["item"].filter("state = 'guarded'").select("segment_id", F.col("after").alias("text")), ["segment_id"]),
            "item": t["item"].withColumn("state", F.when(F.col("state") == "guarded", "written").otherwise(F.col("state"))),
        },
    )
    for step in steps:
        read, t = tables.read()
        tables.commit(read, step(t))
    return {r["state"]: r["n"] for r in tables.read()[1]["item"].groupBy("state").agg(F.count("*").alias("n")).collect()}  # four rows at most
