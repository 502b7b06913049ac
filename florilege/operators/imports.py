"""Approved rows of a review sheet, applied to the glossary in the sheet's order.

A row with a sense's id approves that sense; one without it makes, extends or
updates the term of its lemma.  A row's effect depends on the rows of the same
term before it (the first makes the term, the next adds a sense, the one after
it updates that sense), on none of another term.  So terms are dealt by their
lemma without case, and the rows of one are folded over its senses in order.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.operators.mutate import assign_keys
from florilege.store import computed_once

#: What becomes of a row.
OK, CONFIRMED, CONFLICT, NOT_FOUND = "OK", "ALREADY_CONFIRMED", "CONFLICT", "NOT_FOUND"
CREATED, SENSE_ADDED, UPDATED, NO_LEMMA = "CREATED", "SENSE_ADDED", "UPDATED", "NO_LEMMA"

_OUT = "what string, place long, outcome string, bumped boolean, key string, term_id long, lemma string, category string, surface string, sense_id long, label string, status string, version long, content string, written boolean"
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]


def _text(x) -> str | None:
    """A cell's text, trimmed; none if nothing is left."""
    return (x.strip() or None) if isinstance(x, str) else None


def _number(x) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


class _Term:
    """One term and its senses, as rows find them: by id and by label, so that a row costs the same however many senses there are."""

    def __init__(self, key: str, state: pd.DataFrame) -> None:
        self.key, self.senses, self.term = key, [], None
        self.by_id: dict[int, int] = {}
        self.by_label: dict[str | None, list[int]] = defaultdict(list)
        for row in state.sort_values("sense_id").to_dict("records"):
            self.term = {"term_id": _number(row["term_id"]), "lemma": row["lemma"], "category": row["category"], "surface": _text(row["surface"]), "place": None}
            if _number(row["sense_id"]) is not None:
                self.by_id.setdefault(_number(row["sense_id"]), len(self.senses))
                self.put({"sense_id": _number(row["sense_id"]), "label": row["label"], "status": row["status"], "version": _number(row["version"]), "content": row["content"], "written": False, "place": None})

    def put(self, sense: dict) -> None:
        self.senses.append(sense)
        heapq.heappush(self.by_label[sense["label"]], len(self.senses) - 1)

    def relabel(self, at: int, label: str | None) -> None:
        self.senses[at]["label"] = label
        heapq.heappush(self.by_label[label], at)

    def first(self, label: str | None) -> dict | None:
        """The first sense of a label; places that have another one by now are forgotten."""
        places = self.by_label[label]
        while places and self.senses[places[0]]["label"] != label:
            heapq.heappop(places)
        return self.senses[places[0]] if places else None

    def approve(self, row: dict) -> tuple[str, bool]:
        """A row with a sense's id."""
        at = self.by_id[_number(row["sense_id"])]
        sense = self.senses[at]
        if _number(row["version"]) is None:
            return CONFLICT, False
        content, known = _text(row["content"]), sense["status"] == "approved"
        if known and (content is None or content == sense["content"]):
            self.relabel(at, _text(row["label"]))
            return CONFIRMED, False
        sense |= {"content": content or "", "written": True, "version": sense["version"] + 1, "status": "approved"}
        self.relabel(at, _text(row["label"]))
        if not known:
            self.term["surface"] = _text(row["surface"]) or self.term["surface"]
        return OK, True

    def add(self, row: dict) -> tuple[str, bool]:
        """A row without one: its lemma is this term's."""
        label, content = _text(row["label"]), _text(row["content"])
        new = {"sense_id": None, "label": label, "status": "approved", "version": 1, "content": content, "written": content is not None, "place": row["place"]}
        if self.term is None:
            self.term = {"term_id": None, "lemma": _text(row["lemma"]), "category": _text(row["category"]), "surface": _text(row["surface"]), "place": row["place"]}
            self.put(new)
            return CREATED, False
        sense = self.first(label)
        if sense is None:
            self.put(new)
            return SENSE_ADDED, False
        sense["status"] = "approved"
        bump = content is not None and content != sense["content"]
        if bump:
            sense |= {"content": content, "written": True, "version": sense["version"] + 1}
        self.term["surface"] = _text(row["surface"]) or self.term["surface"]
        return UPDATED, bump

    def rows(self) -> Iterator[dict]:
        if self.term is not None:
            yield {"what": "term", "key": self.key, **self.term}
            for s in self.senses:
                yield {"what": "sense", "key": self.key, "term_id": self.term["term_id"], **s}


def _fold(key: tuple, commands: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
    term, out = _Term(key[0], state), []
    for row in commands.sort_values("place").to_dict("records"):
        outcome, bumped = term.approve(row) if _number(row["sense_id"]) is not None else term.add(row)
        out.append({"what": "outcome", "place": row["place"], "outcome": outcome, "bumped": bumped})
    found = [*out, *term.rows()]
    return pd.DataFrame({c: pd.Series([row.get(c) for row in found], dtype=object) for c in _COLUMNS})


def import_approvals(sheet: DataFrame, terms: DataFrame, senses: DataFrame) -> dict[str, DataFrame]:
    """outcome, term, sense and rendering after a sheet's approved rows.

    ``sheet``: place (order), sense_id (null: a new term's), version, lemma,
    surface, label, content, category.  ``terms``: term_id, lemma, category,
    surface.  ``senses``: sense_id, term_id, label, status, version, content
    (the rendering that holds).  ``outcome`` has place, outcome and bumped of
    each row; ``term`` and ``sense`` are whole tables, new keys behind the
    largest in the sheet's order; ``rendering`` has sense_id and content of
    those that a person has written.

    Only a blank version is a conflict.  An approved sense is done with unless
    its content changes, which raises its version; another is approved, with a
    new version, whatever version the sheet names.
    """
    known = terms.select("term_id", "lemma", "category", "surface", F.lower("lemma").alias("key"))
    own_key = senses.select("sense_id", "term_id").join(known.select("term_id", F.col("key").alias("own_key")), "term_id").drop("term_id")
    blank = F.coalesce(F.trim("lemma") == "", F.lit(True))
    placed = sheet.join(own_key, "sense_id", "left").withColumn("key", F.when(F.col("sense_id").isNotNull(), F.col("own_key")).otherwise(F.when(~blank, F.lower(F.trim("lemma"))))).drop("own_key")
    lost = placed.filter("key IS NULL").select("place", F.when(F.col("sense_id").isNull(), NO_LEMMA).otherwise(NOT_FOUND).alias("outcome"), F.lit(False).alias("bumped"))
    commands = placed.filter("key IS NOT NULL").select("key", "place", F.col("sense_id").cast("long").alias("sense_id"), F.col("version").cast("long").alias("version"), "lemma", "surface", "label", "content", "category")
    touched = known.join(commands.select("key").distinct(), "key", "left_semi")
    state = touched.join(senses.select("term_id", "sense_id", "label", "status", "version", "content"), "term_id", "left")
    state = state.select(F.col("key").alias("of"), *(F.col(c).alias(c) for c in ("term_id", "lemma", "category", "surface", "sense_id", "label", "status", "version", "content")))
    done = computed_once(commands.groupBy("key").cogroup(state.groupBy("of")).applyInPandas(_fold, _OUT))
    outcome = done.filter("what = 'outcome'").select("place", "outcome", "bumped").union(lost)

    term = done.filter("what = 'term'").select("key", "term_id", "lemma", "category", "surface", "place")
    fresh = assign_keys(terms, term.filter("term_id IS NULL").drop("term_id"), "term_id", ["place"])
    term = computed_once(term.filter("term_id IS NOT NULL").unionByName(fresh))
    sense = done.filter("what = 'sense'").drop("term_id").join(term.select("key", "term_id"), "key").select("sense_id", "term_id", "label", "status", "version", "content", "written", "place")
    new = assign_keys(senses, sense.filter("sense_id IS NULL").drop("sense_id"), "sense_id", ["place"])
    sense = computed_once(sense.filter("sense_id IS NOT NULL").unionByName(new))
    others = lambda table, changed, key: table.join(changed.select(key), key, "left_anti")
    return {
        "outcome": outcome,
        "term": others(terms.select("term_id", "lemma", "category", "surface"), term, "term_id").unionByName(term.drop("key", "place")),
        "sense": others(senses.select("sense_id", "term_id", "label", "status", "version", "content"), sense, "sense_id").unionByName(sense.drop("written", "place")),
        "rendering": sense.filter("written").select("sense_id", "content"),
    }
