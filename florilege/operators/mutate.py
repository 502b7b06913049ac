"""State transitions as functions from snapshot to snapshot, and validators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florilege.operators.navigation import numbered
from florilege.store import computed_once


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the source replace those of the target with their key."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source, allowMissingColumns=True)


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def guarded_upsert(target: DataFrame, source: DataFrame, keys: list[str], guarded: DataFrame) -> DataFrame:
    """An upsert that leaves guarded keys alone."""
    return upsert(target, source.join(guarded.select(*keys), keys, "left_anti"), keys)


def update_where(target: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return target.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    return target.filter(~F.coalesce(condition, F.lit(False)))


def delete_using(target: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(other.select(*keys).distinct(), keys, "left_anti")


def delete_subtree(tables: dict[str, DataFrame], doomed: DataFrame, key: str = "segment_id") -> dict[str, DataFrame]:
    """The same ids go from each table that depends on them."""
    return {name: delete_using(df, doomed, [key]) for name, df in tables.items()}


def update_from(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Fills a column from another table where it has a value."""
    own = source.select(key, F.col(column).alias("_new"))
    return target.join(own, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def replace_guesses(target: DataFrame, fresh: DataFrame, keys: list[str], guessed: str = "model_proposed") -> DataFrame:
    """Guessed rows are wiped and new ones inserted where no row, a rejected one either, is in the way; nothing fresh, nothing done."""
    is_guess = F.col("status") == guessed
    any_fresh = fresh.limit(1).select(F.lit(True).alias("_any"))
    kept = target.filter(is_guess).withColumn("_any", F.lit(True)).join(any_fresh, "_any", "left_anti").drop("_any")
    others = target.filter(~F.coalesce(is_guess, F.lit(False)))
    return insert_missing(others, fresh, keys).unionByName(kept, allowMissingColumns=True)


def review(segments: DataFrame, reviews: DataFrame, texts: DataFrame, commands: DataFrame) -> dict[str, DataFrame]:
    """outcome, review and text after commands, one a segment: (segment_id, action, expected, by, content, note).

    ``reviews``: segment_id, reviewer, version, note.  ``texts``: segment_id,
    content, the texts that people have written.  ``save``, ``accept`` and
    ``note`` make a review or raise its version if it is the expected one;
    ``reset`` deletes it with the text.  Only ``note`` changes the note, only
    ``save`` the text.  A segment that isn't there is ``notfound``, a version
    that another has changed, or deleted under a reset, ``conflict``: neither
    changes anything.
    """
    known = segments.select("segment_id", F.lit(True).alias("_known")).distinct()
    held = reviews.select("segment_id", F.col("version").alias("_version"), F.col("note").alias("_note"))
    c = commands.join(known, "segment_id", "left").join(held, "segment_id", "left")
    none, same, reset = F.col("_version").isNull(), F.col("_version") == F.col("expected"), F.col("action") == "reset"
    fits = F.when(none, ~reset | (F.col("expected") == 0)).otherwise(same)
    c = c.withColumn("outcome", F.when(F.col("_known").isNull(), "notfound").when(fits, "ok").otherwise("conflict"))
    c = c.withColumn("version", F.when(F.col("outcome") == "ok", F.when(reset, 0).otherwise(F.coalesce("_version", F.lit(0)) + 1)))
    ok = c.filter("outcome = 'ok'")
    note = F.when(F.col("action") == "note", F.col("note")).otherwise(F.col("_note"))
    made = ok.filter("action <> 'reset'").select("segment_id", F.col("by").alias("reviewer"), "version", note.alias("note"))
    said = ok.filter("action = 'save'").select("segment_id", "content")
    gone = ok.filter("action = 'reset'").select("segment_id")
    return {
        "outcome": c.select("segment_id", "outcome", "version"),
        "review": upsert(reviews.join(gone, "segment_id", "left_anti"), made, ["segment_id"]),
        "text": upsert(texts.join(gone, "segment_id", "left_anti"), said, ["segment_id"]),
    }


def bump_on_change(target: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """New content; the version grows only if it differs, null-safe."""
    own = changes.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = target.join(own, key, "left")
    differs = F.col("_hit").isNotNull() & ~F.col(column).eqNullSafe(F.col("_new"))
    return joined.withColumn("version", F.col("version") + differs.cast("int")).withColumn(column, F.when(differs, F.col("_new")).otherwise(F.col(column))).drop("_new", "_hit")


def retire(target: DataFrame, ids: list[int], key: str = "sense_id") -> DataFrame:
    """Retired senses always get a new version."""
    return update_where(target, F.col(key).isin(ids), {"status": F.lit("retired"), "version": F.col("version") + 1})


def transition(target: DataFrame, commands: DataFrame, key: str, allowed: dict[str, list[str]], polished: DataFrame | None = None, back: str = "needs_human") -> DataFrame:
    """Reason of each command (key, to): ok, notfound, wrong_status, by what each status may come from; already_polished where ``back`` comes too late for one of ``polished``."""
    joined = commands.join(target.select(key, "status"), key, "left")
    may = F.lit(False)
    for to, froms in allowed.items():
        may = may | ((F.col("to") == to) & F.col("status").isin(froms))
    late = F.lit(False)
    if polished is not None:
        joined = joined.join(polished.select(key, F.lit(True).alias("_polished")).distinct(), key, "left")
        late = (F.col("to") == back) & F.col("_polished").isNotNull()
    reason = F.when(F.col("status").isNull(), "notfound").when(~may, "wrong_status").when(late, "already_polished").otherwise("ok")
    return joined.withColumn("reason", reason).drop("_polished")


def upsert_pending(target: DataFrame, proposals: DataFrame, order: str) -> DataFrame:
    """Proposals as pending ones: an open one of the same kind, author, sense (for a new term: lemma without case) and origin is changed in place and keeps its id; others get ids behind the largest, in order.

    Of several with one key the last one's content counts, at the first one's
    place.  What an open proposal takes over are ``target_id``, ``content`` and
    ``note``, as far as the table has them; all other columns are carried.
    """
    what = F.when(F.col("kind") == "add_term", F.lower("lemma")).otherwise(F.col("sense_id").cast("string"))
    keyed = lambda d: d.withColumn("_k", F.struct("kind", "proposed_by", what.alias("what"), F.coalesce("origin", F.lit(-1)).alias("origin")))
    columns = [c for c in target.columns if c != "proposal_id"]
    given = keyed(proposals.withColumn("status", F.lit("pending")))
    new = computed_once(given.groupBy("_k").agg(F.max_by(F.struct(*columns), order).alias("_new"), F.min(order).alias("_first")))
    changed = [c for c in ("target_id", "content", "note") if c in columns]
    is_open = F.coalesce(F.col("status") == "pending", F.lit(False))
    open_ = keyed(target.filter(is_open))  # only open proposals can change, so only they meet the new ones
    hit = F.col("_first").isNotNull()
    kept = open_.join(new, "_k", "left").withColumns({c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in changed}).select(*target.columns)
    fresh = assign_keys(target, new.join(open_.select("_k"), "_k", "left_anti").select("_first", "_new.*"), "proposal_id", ["_first"])
    return target.filter(~is_open).unionByName(kept).unionByName(fresh.select(*target.columns))


def decide(target: DataFrame, proposal_id: int, status: str, by: str) -> DataFrame:
    """Only a pending proposal is decided; open siblings for the same sense are superseded when it is approved."""
    own = target.filter((F.col("proposal_id") == proposal_id) & (F.col("status") == "pending")).select(F.col("sense_id").alias("_s"), F.lit(True).alias("_on"))
    joined = target.join(F.broadcast(own), F.col("sense_id") == F.col("_s"), "left")
    mine = (F.col("proposal_id") == proposal_id) & (F.col("status") == "pending")
    sibling = F.col("_on").isNotNull() & (F.col("status") == "pending") & F.lit(status == "approved")
    after = F.when(mine, F.lit(status)).when(sibling, "superseded").otherwise(F.col("status"))
    return joined.withColumn("decided_by", F.when(mine, F.lit(by)).otherwise(F.col("decided_by"))).withColumn("status", after).drop("_s", "_on")


def changes(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str] = ()) -> DataFrame:
    """keys, change of what differs between two snapshots: added, removed, or changed in one of ``columns`` (null equals null)."""
    told = lambda d, name: d.select(*keys, F.struct(*columns, F.lit(True).alias("_")).alias(name)).distinct()
    both = told(before, "_a").join(told(after, "_b"), keys, "full")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return both.withColumn("change", change).filter("change IS NOT NULL").select(*keys, "change")


def assign_keys(target: DataFrame, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """New rows get keys behind the largest, in order; no window sees them all."""
    last = target.agg(F.coalesce(F.max(key), F.lit(0)).alias("_last"))  # one row
    return numbered(rows, order, "_n").join(F.broadcast(last)).withColumn(key, F.col("_last") + F.col("_n") + 1).drop("_last", "_n")


def merge_sheet(existing: DataFrame, new: DataFrame, key: str, preserve: list[str]) -> DataFrame:
    """The new rows, with what people have filled in kept; keys that are gone go."""
    kept = existing.select(key, *(F.col(c).alias(f"_{c}") for c in preserve))
    return new.join(kept, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in preserve}).drop(*(f"_{c}" for c in preserve))


def duplicates(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys that break a unique constraint, a partial one if ``where`` is given."""
    rows = df.filter(where) if where is not None else df
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def violations(df: DataFrame, check: Column) -> DataFrame:
    """Rows for which a check is false; unknown passes, as in SQL."""
    return df.filter(~F.coalesce(check, F.lit(True)))


def orphans(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).join(parents.select(key).distinct(), key, "left_anti")
