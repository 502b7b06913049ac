"""Approvals and imports by literal cases, commits of several tables, numbering of many rows."""

import pytest
from pyspark.sql import functions as F

from florilege.operators import glossary, imports, mutate, navigation, proposals
from florilege.sources import readers
from florilege.store import StaleError, TableSet


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


TERMS = [(1, "Actus", "term", None), (2, "habitus", "term", "Habitus"), (3, "bare", None, None)]
SENSES = [(10, 1, None, "proposed", 3, "čin"), (11, 1, "as passion", "approved", 2, "vášeň"), (20, 2, None, "approved", 1, "zvyk"), (21, 2, "x", "retired", 4, None)]


def imported(spark, *sheet):
    """place, sense_id, version, lemma, surface, label, content, category of each row."""
    schema = "place long, sense_id long, version long, lemma string, surface string, label string, content string, category string"
    terms = spark.createDataFrame(TERMS, "term_id int, lemma string, category string, surface string")
    senses = spark.createDataFrame(SENSES, "sense_id long, term_id int, label string, status string, version int, content string")
    return imports.import_approvals(spark.createDataFrame([(k, *r) for k, r in enumerate(sheet)], schema), terms, senses)


def test_rows_that_name_a_sense(spark):
    out = imported(
        spark,
        (99, 1, "", "", "", "y", ""),  # no such sense
        (10, None, "", "", "", "y", ""),  # blank version
        (10, 1, "", "actum", " lab ", "nový", ""),  # a version that differs proceeds
        (20, 1, "", "other", "", "zvyk", ""),  # approved, the same content: the label alone goes
        (11, 2, "", "", "", "cit", ""),  # approved, new content
    )
    assert rows(out["outcome"]) == [(0, "NOT_FOUND", False), (1, "CONFLICT", False), (2, "OK", True), (3, "ALREADY_CONFIRMED", False), (4, "OK", True)]
    assert rows(out["sense"]) == [
        (10, 1, "lab", "approved", 4, "nový"), (11, 1, None, "approved", 3, "cit"), (20, 2, None, "approved", 1, "zvyk"), (21, 2, "x", "retired", 4, None),
    ]
    assert rows(out["term"]) == [(1, "Actus", "term", "actum"), (2, "habitus", "term", "Habitus"), (3, "bare", None, None)]
    assert rows(out["rendering"]) == [(10, "nový"), (11, "cit")]


def test_rows_of_new_terms_in_order(spark):
    out = imported(
        spark,
        (None, None, " Virtus ", "virtute", "", "cnosť", "term"),
        (None, None, "VIRTUS", "else", "as power", " ", ""),
        (None, None, "virtus", "virtutem", "as power", "moc", ""),
        (None, None, "virtus", "", "as power", "moc", ""),
        (None, None, "actus", "", "As passion", "", ""),
        (None, None, "ACTUS", "actui", "", "čin", ""),
        (None, None, "bare", "", "", "holý", ""),
        (None, None, "  ", "", "", "x", ""),
        (None, None, "zeta", "", "", "", ""),
    )
    assert [r[1:] for r in rows(out["outcome"])] == [("CREATED", False), ("SENSE_ADDED", False), ("UPDATED", True), ("UPDATED", False), ("SENSE_ADDED", False), ("UPDATED", False), ("SENSE_ADDED", False), ("NO_LEMMA", False), ("CREATED", False)]
    assert [r for r in rows(out["sense"]) if r[0] > 21 or r[0] == 10] == [
        (10, 1, None, "approved", 3, "čin"), (22, 4, None, "approved", 1, "cnosť"), (23, 4, "as power", "approved", 2, "moc"), (24, 1, "As passion", "approved", 1, None), (25, 3, None, "approved", 1, "holý"), (26, 5, None, "approved", 1, None),
    ]
    assert [r for r in rows(out["term"]) if r[0] != 2] == [(1, "Actus", "term", "actui"), (3, "bare", None, None), (4, "Virtus", "term", "virtutem"), (5, "zeta", None, None)]
    assert rows(out["rendering"]) == [(22, "cnosť"), (23, "moc"), (25, "holý")]


def test_a_sheet_without_rows_changes_nothing(spark):
    out = imported(spark)
    assert not out["outcome"].collect() and out["term"].count() == 3 and rows(out["sense"]) == sorted(SENSES, key=str)


def test_approved_rows_of_a_sheet(spark):
    cells = ("place long, approved string, category string, lemma string, surface string, label string, content string, sense_id string, version string",)
    sheet = spark.createDataFrame(
        [(k, a, "", lemma, "", "", "", i, v) for k, (a, lemma, i, v) in enumerate([("TRUE", "", "1", "2"), ("yes", "l", "x", "2"), ("", "l", "3", "1"), (" True ", "", "4", "?"), ("1", "virtus", " ", ""), ("1", " ", "", "1"), ("Y", "l", "6", "1"), ("✓", "l", "8", "1"), (None, "l", None, None)])], *cells)
    assert rows(readers.approvals(sheet), "place", "sense_id", "version", "lemma") == [(0, 1, 2, ""), (3, 4, None, ""), (4, None, None, "virtus")]


P = "proposal_id long, kind string, proposed_by string, sense_id int, target_id int, origin long, lemma string, content string, status string, note string"


def glossary_tables(spark):
    return {
        "proposal": spark.createDataFrame(
            [
                (1, "rendering", "u", 10, None, None, "a", "new", "pending", None), (2, "rendering", "v", 10, None, None, "a", "rival", "pending", None), (3, "retire_sense", "v", 10, None, None, "a", None, "pending", None),
                (4, "sense_here", "u", 10, 11, 100, "a", None, "pending", None), (5, "sense_here", "u", 10, 20, 100, "a", None, "pending", None), (6, "sense_here", "u", 10, 12, 100, "a", None, "pending", None),
                (7, "sense_here", "u", 10, 11, 999, "a", None, "pending", None), (8, "sense_here", "u", 10, None, 100, "a", "free", "pending", None), (9, "remove_here", "u", 20, None, 101, "b", None, "pending", None),
                (10, "remove_here", "u", 20, None, 100, "b", None, "pending", None), (11, "add_term", "u", None, None, None, "Virtus", "cnosť", "pending", None), (12, "add_term", "v", None, None, None, "virtus", "moc", "pending", None),
                (13, "add_term", "v", None, None, None, "ACTUS", "x", "pending", None), (14, "rendering", "u", 20, None, None, "b", "zvyk", "pending", None), (15, "rendering", "u", 20, None, None, "b", " ", "pending", None), (16, "rendering", "u", 20, None, None, "b", "z", "rejected", None),
            ], P,
        ),
        "term": spark.createDataFrame([(1, "actus"), (2, "habitus")], "term_id long, lemma string"),
        "sense": spark.createDataFrame([(10, 1, 3, "approved", "old"), (11, 1, 5, "proposed", "other"), (12, 1, 1, "retired", "gone"), (20, 2, 1, "approved", "zvyk")], "sense_id int, term_id int, version int, status string, content string"),
        "usage": spark.createDataFrame([(100, 10, 3, "model_proposed"), (101, 20, 1, "confirmed"), (102, 10, 2, "confirmed")], "segment_id long, sense_id int, used int, status string"),
        "segment": spark.createDataFrame([(100, "translated"), (101, "translated"), (102, "translated")], "segment_id long, status string"),
        "human": spark.createDataFrame([(101,)], "segment_id long"),
    }


def choose(spark, *ids, edited=None):
    return spark.createDataFrame([(i, edited) for i in ids], "proposal_id long, edited string")


def test_outcomes_of_approvals(spark):
    t = glossary_tables(spark)
    done = lambda *ids, **k: rows(glossary.approvals(t["proposal"], choose(spark, *ids, **k), t["term"], t["sense"], t["usage"]), "proposal_id", "outcome", "effect")
    assert done(1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 77) == sorted(
        [(1, "ok", "change"), (4, "ok", "repoint"), (5, "wrong_term", None), (6, "retired", None), (7, "stale", None), (8, "ok", "acknowledge"), (9, "ok", "reject_usage"), (10, "stale", None), (11, "ok", "add"), (12, "term_exists", None), (13, "term_exists", None), (14, "ok", "change"), (15, "empty", None), (16, "not_pending", None), (77, "not_found", None)], key=str)
    assert done(1, 4, 8, 9, edited=" x ") == [(1, "ok", "change"), (4, "no_edit", None), (8, "ok", "acknowledge"), (9, "no_edit", None)]
    assert done(1, edited="  ") == [(1, "empty_edit", None)]


def test_a_usage_moved_to_a_sense_is_not_the_one_rejected_there(spark):
    """Both effects are found by the sense that the usage had in the snapshot."""
    t = glossary_tables(spark)
    p = spark.createDataFrame([(1, "sense_here", "u", 10, 11, 100, "a", None, "pending", None), (2, "remove_here", "u", 11, None, 100, "a", None, "pending", None)], P)
    usage = t["usage"].union(spark.createDataFrame([(100, 11, 4, "model_proposed")], t["usage"].schema))
    done = glossary.approvals(p, choose(spark, 1, 2), t["term"], t["sense"], usage)
    out = glossary.applied(p, t["term"], t["sense"], usage, t["segment"], t["human"], done)
    assert rows(out["usage"]) == [(100, 11, 4, "rejected"), (100, 11, 5, "confirmed"), (101, 20, 1, "confirmed"), (102, 10, 2, "confirmed")]


def test_all_effects_are_one_commit_and_the_loser_changes_nothing(spark, tmp_path):
    tables = TableSet(spark, f"file://{tmp_path}/tables")
    assert tables.commit(0, glossary_tables(spark)) == 1
    read, before = tables.read()
    number, outcomes = glossary.approve(tables, choose(spark, 1, 4, 9, 11, 14))
    assert number == 2 and {r.outcome for r in outcomes.collect()} == {"ok"}
    t = tables.read()[1]
    assert rows(t["sense"]) == [(10, 1, 4, "approved", "new"), (11, 1, 5, "approved", "other"), (12, 1, 1, "retired", "gone"), (20, 2, 1, "approved", "zvyk"), (21, 3, 1, "approved", "cnosť")]
    assert rows(t["usage"]) == [(100, 11, 5, "confirmed"), (101, 20, 1, "rejected"), (102, 10, 2, "confirmed")]
    assert rows(t["segment"], "segment_id", "status") == [(100, "pending"), (101, "needs_human"), (102, "translated")]
    assert rows(t["term"], "term_id", "lemma") == [(1, "actus"), (2, "habitus"), (3, "Virtus")]
    assert {r.proposal_id: r.status for r in t["proposal"].collect() if r.status != "pending"} == {1: "approved", 4: "approved", 9: "approved", 11: "approved", 14: "approved", 2: "superseded", 3: "superseded", 15: "superseded", 16: "rejected"}
    folders = sorted(p.name for p in (tmp_path / "tables" / "data").iterdir())
    with pytest.raises(StaleError):  # a second writer that has read snapshot 1
        tables.commit(read, {"sense": before["sense"].withColumn("status", F.lit("lost"))})
    race = TableSet(spark, tables.folder)
    race.version = lambda: read  # it looks before the other commits, and writes after
    with pytest.raises(StaleError):
        race.commit(read, {"sense": before["sense"].withColumn("status", F.lit("lost"))})
    assert tables.version() == 2 and rows(tables.read()[1]["sense"]) == rows(t["sense"])
    assert sorted(p.name for p in (tmp_path / "tables" / "data").iterdir()) == folders
    assert rows(tables.read(1)[1]["sense"]) == rows(before["sense"])


def test_usages_that_no_effect_meets_are_left_out(spark):
    """The filter lets all through that the join may find, and little else."""
    usage = spark.range(40_000).select(F.col("id").alias("segment_id"), (F.col("id") % 900).cast("int").alias("sense_id"))
    here = usage.filter("segment_id % 40 = 3").select("segment_id", F.col("sense_id").cast("long").alias("sense_id"))
    told = glossary._might_meet(usage, here, ["segment_id", "sense_id"], "maybe")
    assert told.columns == ["segment_id", "sense_id", "maybe"] and told.count() == 40_000
    assert told.filter("segment_id % 40 = 3 AND NOT maybe").count() == 0 and told.filter("maybe").count() < 8_000
    assert glossary._might_meet(usage, here.limit(0), ["segment_id", "sense_id"], "maybe").filter("maybe").count() == 0


def test_reopening_keeps_lemmas_and_origins_apart(spark):
    given = [(1, "add_term", "u", None, None, None, "virtus", "a", "rejected", "n1"), (2, "add_term", "u", None, None, None, "habitus", "b", "rejected", "n2"), (3, "remove_here", "u", 10, None, 100, "x", None, "rejected", None), (4, "remove_here", "u", 10, None, 102, "x", None, "rejected", None),
             (5, "rendering", "u", 10, None, None, "x", "c", "approved", None), (6, "rendering", "u", 99, None, None, "x", "c", "rejected", None), (7, "add_term", "u", None, None, None, "VIRTUS", "live", "pending", None), (8, "remove_here", "u", 10, None, 999, "x", None, "rejected", None)]
    t = glossary_tables(spark)
    out, told = glossary.reopen(spark.createDataFrame(given, P), spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 8, 50)], "proposal_id long"), t["sense"], t["segment"])
    assert rows(told) == sorted([(1, "ok"), (2, "ok"), (3, "ok"), (4, "ok"), (5, "not_rejected"), (6, "gone"), (8, "gone"), (50, "not_found")], key=str)
    got = {r.proposal_id: (r.lemma, r.origin, r.content, r.status, r.note) for r in out.collect()}
    assert got[7] == ("VIRTUS", None, "a", "pending", "n1") and got[1][3] == "rejected"
    assert {k: v for k, v in got.items() if k > 8} == {9: ("habitus", None, "b", "pending", "n2"), 10: ("x", 100, None, "pending", None), 11: ("x", 102, None, "pending", None)}


def test_reasons_of_proposals(spark):
    senses = spark.createDataFrame([(1, 1, "a", "approved"), (2, 1, None, "approved"), (3, 2, "c", "approved"), (4, 1, "d", "proposed")], "sense_id int, term_id int, content string, status string")
    usage = spark.createDataFrame([(7, 1, "confirmed"), (7, 2, "confirmed"), (8, 1, "rejected"), (7, 4, "confirmed")], "segment_id int, sense_id int, status string")
    cases = [("rendering", 9, None, "x", 7), ("rendering", 1, None, "", 7), ("rendering", 1, None, "a", 7), ("rendering", 1, None, "b", None), ("sense_here", 1, 1, None, 7), ("sense_here", 1, 3, None, 7), ("sense_here", 1, 2, None, 7), ("sense_here", 1, None, None, 7),
             ("sense_here", 1, None, "a", 7), ("sense_here", 1, None, "z", 7), ("sense_here", 1, 2, None, 8), ("remove_here", 2, None, None, 7), ("remove_here", 4, None, None, 7), ("remove_here", 1, None, None, 7), ("retire_sense", 1, None, None, None)]
    p = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "proposal_id int, kind string, sense_id int, target_id int, content string, segment_id int")
    got = [r.reason for r in proposals.validate(p, senses, proposals.locked_terms(usage, senses)).orderBy("proposal_id").collect()]
    assert got == ["not_found", "proposed_sk_required", "no_change", "ok", "no_change", "wrong_term", "ok", "missing_target", "no_change", "ok", "not_locked_here", "not_locked_here", "not_locked_here", "ok", "ok"]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_many_rows_keep_their_number_and_all_their_columns(spark, adaptive):
    """Rows with a payload, at a size where ranges are drawn from a sample; a third of them at one place."""
    n = 400_000
    own = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1000).alias("k"), F.col("id"), F.repeat(F.lit("payload"), 3).alias("p"))
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = navigation.numbered(own, ["k"])
        assert got.agg(F.count("*"), F.count_distinct("number"), F.min("number"), F.max("number"), F.count_distinct("id")).first()[:] == (n, n, 0, n - 1, n)
        before = got.select(F.col("k").alias("a"), (F.col("number") + 1).alias("number")).join(got.select("k", "number"), "number")
        assert before.filter("a > k").count() == 0 and got.columns == ["k", "id", "p", "number"]
        keyed = mutate.assign_keys(spark.createDataFrame([(5,)], "key long"), own, "key", ["k", "id"])
        assert keyed.agg(F.count("*"), F.count_distinct("key"), F.min("key"), F.max("key")).first()[:] == (n, n, 6, n + 5)
        near = navigation.neighbours(own.select("id", F.col("k").alias("v")), ["id"], "v")
        assert near.agg(F.count("*"), F.count_if(F.col("previous").isNull()), F.count_if(F.col("next").isNull())).first()[:] == (n, 1, 1)
        sizes = navigation.batches(own, "id", 1000).groupBy("batch").count()
        assert sizes.agg(F.count("*"), F.min("count"), F.max("count")).first()[:] == (400, 1000, 1000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_proposals_of_one_id_as_in_sql(spark, tmp_path):
    """A sense's key that comes twice makes two proposals of each of its usages' ids."""
    import duckdb

    from florilege.plans import registry

    c, names = duckdb.connect(), "region nation customer orders lineitem labels part".split()
    for name in names:
        again = f" UNION ALL SELECT * REPLACE (p_partkey - 1 AS p_partkey) FROM '{SMALL}/part.parquet' WHERE p_partkey % 5 = 1" if name == "part" else ""
        c.execute(f"COPY (SELECT * FROM '{SMALL}/{name}.parquet'{again}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    counts = lambda found: sorted(tuple(r) for r in found if r[0] == "proposal")
    assert counts(registry.queries()["U17_applied"](spark, str(tmp_path)).select("what", "status", "n", "ids").collect()) == counts(c.execute(registry.oracle_sql()["U17_applied"]).fetchall())


SMALL = "/root/testdata/sf0.001"


def test_many_senses_of_one_term_are_found_at_once():
    """Work grows with the rows, not with rows times senses."""
    import time

    import pandas as pd

    n = 30_000
    state = pd.DataFrame({"term_id": 1, "lemma": "a", "category": None, "surface": None, "sense_id": range(n), "label": [f"l{k}" for k in range(n)], "status": "flagged", "version": 1, "content": "c"})
    sheet = pd.DataFrame({"place": range(n), "sense_id": range(n), "version": 1.0, "lemma": "a", "surface": None, "label": [f"m{k}" for k in range(n)], "content": "d", "category": None})
    sheet.loc[n] = {"place": n, "sense_id": None, "version": None, "lemma": "a", "surface": None, "label": f"m{n - 1}", "content": "e", "category": None}
    begun = time.process_time()
    out = imports._fold(("a",), sheet, state)
    assert time.process_time() - begun < 8
    assert list(out[out["what"] == "outcome"]["outcome"].value_counts().items()) == [("OK", n), ("UPDATED", 1)]
    last = out[out["what"] == "sense"].iloc[-1]
    assert (last["sense_id"], last["label"], last["version"], last["content"]) == (n - 1, f"m{n - 1}", 3, "e")
