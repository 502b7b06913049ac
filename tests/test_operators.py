"""Literal cases of what SQL doesn't cover."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from florilege.functions import paths
from florilege.functions import text as tx
from florilege.operators import acceptance, guards, lookups, match, mining, mutate, navigation, rollup, sample, stale, terms
from florilege.operators import phrases as phrases_
from florilege.plans import flows, polish
from florilege.sinks import reports, writers
from florilege.sources import readers
from florilege.store import TableSet
from florilege.streaming import unread


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_paths(spark):
    df = spark.createDataFrame([(x,) for x in ("I.q1", "I.q1.a1", "I.q10", "I.q10.a1", "I.q1_x", "I_II.q2.a3.arg4", "I")], "path string")
    p = F.col("path")
    assert rows(df.filter(paths.under(p, "I.q1"))) == [("I.q1",), ("I.q1.a1",)] == rows(df.filter(paths.under_range(p, "I.q1")))
    assert rows(df.filter(paths.article_filter(p, "I.q1"))) == [("I.q1",)]
    assert {r.path: (r.n, r.u) for r in df.select("path", paths.tail_number(p).alias("n"), paths.parent(p).alias("u")).collect()}["I_II.q2.a3.arg4"] == (4, "I_II.q2.a3")
    assert one(spark, paths.parent(F.lit("I"))) is None and one(spark, paths.tail_number(F.lit("I.q"))) is None
    assert one(spark, paths.to_locator(F.lit("I_II.q3.a1"))) == "~ST.I-II.Q3.A1"
    assert one(spark, paths.from_locator(F.lit("~ST.I-II.Q3.A1"))) == "I_II.q3.a1" and one(spark, paths.from_locator(F.lit("~ST.I"))) == "I"
    assert one(spark, paths.clean_label(F.lit("I-II"))) == "I_II"


@pytest.mark.parametrize("word, want", [("animus", "anim"), ("essen", "ess"), ("anima", "anim"), ("aia", "aia"), ("sus", "sus"), ("deo", "deo")])
def test_stem(spark, word, want):
    assert one(spark, tx.stem(F.lit(word))) == want


def test_text(spark):
    assert one(spark, tx.strip_marks(F.lit("Cnosť ľubosť Vášeň ß"))) == "cnost lubost vasen "
    assert all(unicodedata.normalize("NFD", m).encode("ascii", "ignore").decode() == p for p, marked in tx.MARKED.items() for m in marked)
    assert one(spark, tx.holds_phrase(F.lit("toto o sebe je"), F.lit("o sebe."))) and not one(spark, tx.holds_phrase(F.lit("toto po sebe je"), F.lit("o sebe")))
    assert one(spark, tx.outside_parentheses(F.lit("a, b (c, d), e"))) == ["a", "b (c, d)", "e"]
    assert one(spark, tx.length_ratio(F.lit("x"), F.lit(""))) == 1.0 and one(spark, tx.sentences(F.lit("no end"))) == 1
    assert one(spark, tx.verdict(F.lit("pass\nlater: FAIL"))) == "FAIL" and one(spark, tx.canonical_lemma(F.lit("Actus2"))) == "actus"
    assert one(spark, F.rlike(F.lit("a\\Eb"), tx.escaped(F.lit("a\\Eb"))))


def spans_of(text, phrases):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return sorted({(i, -len(p), k) for k, p in phrases for i in range(len(words)) if words[i : i + len(p)] == p})


def test_leftmost_longest_equals_loop(spark):
    rng = random.Random(3)
    phrases = [(0, "actus"), (1, "actus essendi"), (2, "essendi"), (3, "per se"), (4, "se actus"), (5, "per se actus")]
    texts = [(i, " ".join(rng.choice("actus essendi per se et".split()) for _ in range(12))) for i in range(40)] + [(99, None), (98, "")]
    df = spark.createDataFrame(texts, "segment_id long, content string")
    spans = phrases_.phrase_spans(df, spark.createDataFrame(phrases, "phrase_id long, phrase string"))
    want = []
    for i, t in texts:
        end = 0
        for start, minus, k in spans_of(t or "", [(k, p.split()) for k, p in phrases]):
            if start >= end:
                want.append((i, k, start, -minus))
                end = start - minus
    assert rows(match.leftmost_longest(spans)) == sorted(want)


def test_overlay_and_links(spark):
    base = spark.createDataFrame([("a", 1)], "k string, n int")
    found, missing = match.overlay(spark.createDataFrame([("a",), ("b",)], "k string"), base, "k")
    assert rows(found) == [("a", 1)] and rows(missing) == [("b",)]
    with pytest.raises(LookupError):
        match.overlay(spark.createDataFrame([("b",)], "k string"), base, "k", "fail")
    own = spark.createDataFrame([("x", "arg", 1, 10), ("x", "reply", 1, 11), ("x", "reply", 0, 12), ("x", "reply", 7, 13)], "g string, t string, n int, id int")
    assert sorted((r.id, r.reply_to) for r in match.link_replies(own, "g", "t", "n", "id").collect()) == [(11, 10), (12, None), (13, None)]
    t = spark.createDataFrame([(1, "habet se bene. habet"), (2, "se habet")], "segment_id long, content string")
    assert rows(match.construction_suppressed(t, ["habet"], ["se"])) == [(2, "habet")]


def test_resolution_precedence(spark):
    f = lambda x: spark.createDataFrame(x, "segment_id long, term_id long")
    assert rows(match.resolve(f([(1, 1)]), f([(1, 1), (1, 2)]), f([(1, 2), (2, 3)]))) == [(1, 1, 0), (1, 2, 1), (2, 3, 2)]


def test_lift_uses_other_segments_and_floor(spark):
    texts = spark.createDataFrame([(i, "common word" + (" rare" if i < 5 else "")) for i in range(100)], "segment_id long, content string")
    links = spark.createDataFrame([(1, i) for i in range(10)], "term_id int, segment_id long")
    got = mining.renderings(links, mining.lemma_sets(texts, "segment_id", "content")).collect()
    assert [(r.lemma, r.df, r.rate) for r in got] == [("rare", 5, 0.5)] and got[0].lift == pytest.approx(0.5 / (0.5 / 90))
    assert mining.polysemous(mining.renderings(links, mining.lemma_sets(texts, "segment_id", "content"))).count() == 0


def test_gaps_count_empty_segments(spark):
    texts = spark.createDataFrame([(i, "novum verbum" if i < 4 else None, None, "") for i in range(10)], "segment_id long, content string, czech string, english string")
    known, lemmas = spark.createDataFrame([("verbum",)], "lemma string"), spark.createDataFrame([], "surface string, candidate int, lemma string")
    assert rows(mining.gap_lemmas(texts, lemmas, known, floor=3, ceiling=0.4), "lemma", "df") == [("novum", 4)] and mining.gap_lemmas(texts, lemmas, known, floor=3, ceiling=0.39).count() == 0


def test_gaps_by_candidates_and_their_contexts(spark):
    lemmas = spark.createDataFrame([("amans", 0, "Amo2"), ("amans", 1, "Caritas"), ("ratione", 0, "Ratio3"), ("rationem", 0, "ratio"), ("unde", 0, "unde")], "surface string, candidate int, lemma string")
    texts = [(1, "Ratione amans", "", ""), (2, "rationem, rationem unde", "cz", None), (3, "ratione", "cz2", "en"), (4, "Ratione unde x", None, "en2"), (5, None, "cz", "en")]
    df = spark.createDataFrame(texts, "segment_id long, content string, czech string, english string")
    got = mining.gap_lemmas(df, lemmas, spark.createDataFrame([("caritas",)], "lemma string"), spark.createDataFrame([("unde",)], "lemma string"), floor=1, ceiling=0.9, context=4)
    assert rows(got) == [("ratio", 4, "Rati", "cz", "en")]


def test_guards(spark):
    df = spark.createDataFrame([(1, "Preto je to. Tak.", "Preto je."), (2, "Preto je to.", "Je to."), (3, "", "")], "id int, a string, b string")
    got = {r.id: (r.sentence_delta, r.lost, r.ok) for r in guards.polish_guards(df, "a", "b", ["preto"]).collect()}
    assert got[1] == (1, [], True) and got[2][1:] == (["preto"], False) and got[3][2]
    assert one(spark, guards.holds_term(F.lit("o dušiach ľudí"), F.lit("duša"))) is True and one(spark, guards.holds_term(F.lit("telo"), F.lit("duša"))) is False
    assert one(spark, guards.holds_exactly(F.lit("Cnosť je"), F.lit("cnost")))


def test_sample_contract(spark):
    own = spark.createDataFrame([(i, f"r{i % 3}", f"r{i % 3}.q{i % 30}", i % 12, i % 7) for i in range(600)], "segment_id long, pars string, question_path string, formulas int, approved int")
    shares = {"formula": 0.3, "rich": 0.4, "plain": 0.3}
    pool = sample.categories(own)
    got = sample.stratified(pool, 50, shares, 1, ["r0.q0"])
    assert rows(got) == rows(sample.stratified(pool, 50, shares, 1, ["r0.q0"])) and got.filter("question_path = 'r0.q0'").isEmpty()
    assert {(r.category, r.n) for r in got.groupBy("category").agg(F.count("*").alias("n")).collect()} == {("formula", 15), ("rich", 20), ("plain", 15)}
    counts = [r.n for r in got.groupBy("category", "pars").agg(F.count("*").alias("n")).collect()]
    assert max(counts) - min(counts) <= 3
    assert sample.quotas(10, shares, ["a", "b"]) == [("formula", "a", 2), ("formula", "b", 1), ("rich", "a", 2), ("rich", "b", 2), ("plain", "a", 2), ("plain", "b", 1)]


def test_changes_of_state(spark):
    sense = spark.createDataFrame([(1, "a", 1, "approved"), (2, None, 1, "proposed")], "sense_id int, content string, version int, status string")
    change = spark.createDataFrame([(1, "a"), (2, "b")], "sense_id int, content string")
    once = mutate.bump_on_change(sense, change, "sense_id", "content")
    assert rows(once, "sense_id", "version", "content") == [(1, 1, "a"), (2, 2, "b")] == rows(mutate.bump_on_change(once, change, "sense_id", "content"), "sense_id", "version", "content")
    assert rows(mutate.delete_where(sense, F.col("content") == "a"), "sense_id") == [(2,)]
    up = mutate.upsert(sense, sense, ["sense_id"])
    assert up.count() == 2
    empty = sense.limit(0)
    assert mutate.replace_guesses(sense, empty, ["sense_id"], "proposed").count() == 2
    props = "proposal_id long, kind string, proposed_by string, sense_id int, lemma string, origin int, content string, status string, decided_by string"
    old = spark.createDataFrame([(1, "k", "u", 5, "L", None, "a", "pending", None), (2, "k", "v", 5, "L", None, "b", "pending", None), (3, "k", "u", 5, "L", None, "c", "rejected", "x")], props)
    new = spark.createDataFrame([(9, "k", "u", 5, "l", None, "d", "pending", None), (10, "k", "u", 5, "l", 4, "e", "pending", None), (11, "k", "u", 5, "l", 4, "f", "pending", None)], props)
    both = mutate.upsert_pending(old, new, "proposal_id")
    assert rows(both, "proposal_id", "content", "status") == [(1, "d", "pending"), (2, "b", "pending"), (3, "c", "rejected"), (4, "f", "pending")]
    done = mutate.decide(both, 1, "approved", "boss")
    assert rows(done, "proposal_id", "status") == [(1, "approved"), (2, "superseded"), (3, "rejected"), (4, "superseded")] == rows(mutate.decide(done, 1, "rejected", "late"), "proposal_id", "status")


def test_invalidation_loop_ends(spark):
    sense = spark.createDataFrame([(1, 2), (2, 1)], "sense_id int, version int")
    usage = spark.createDataFrame([(10, 1, 1, "confirmed"), (11, 1, 1, "confirmed"), (12, 2, 1, "confirmed"), (13, 1, 1, "rejected")], "segment_id int, sense_id int, used int, status string")
    segments = spark.createDataFrame([(i, "translated") for i in range(10, 14)], "segment_id int, status string")
    human = spark.createDataFrame([(11,)], "segment_id int")
    old = stale.stale_segments(usage, sense)
    after = stale.guard_and_reset(segments, old, human)
    assert rows(after, "segment_id", "status") == [(10, "pending"), (11, "needs_human"), (12, "translated"), (13, "translated")]
    again = usage.join(sense, "sense_id").withColumn("used", F.when(F.col("segment_id") != 11, F.col("version")).otherwise(F.col("used"))).drop("version")
    assert rows(stale.stale_segments(again, sense)) == [(11,)]
    assert stale.price_per_segment(0.0, 5) == 0.0 and stale.price_per_segment(0.0, 5, zero_cost_is_valid=False) == pytest.approx(0.000056)


def test_costs_and_thresholds(spark):
    rates = spark.createDataFrame([("a", 1.0, 0.5, 2.0)], "model string, input_rate double, cached_rate double, output_rate double")
    use = "model string, input double, cached double, output double"
    assert rollup.token_cost(spark.createDataFrame([("a", 1e6, 2e6, 1e6)], use), rates).first().usd == 4.0
    with pytest.raises(Exception, match="no rates for b"):
        rollup.token_cost(spark.createDataFrame([("b", 1.0, 1.0, 1.0)], use), rates).collect()
    rollup.assert_rates(0.2, 2.5)
    with pytest.raises(RuntimeError):
        rollup.assert_rates(0.21, 1.0)


def test_paging_and_neighbours(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    got = {r.k: (r.previous, r.next) for r in navigation.neighbours(df, ["k"], "v").collect()}
    assert got == {i: (f"v{i - 1}" if i else None, f"v{i + 1}" if i < 999 else None) for i in range(1000)}
    assert {r.k: r.batch for r in navigation.batches(df.select("k"), "k", 7).collect()} == {i: i // 7 for i in range(1000)}
    assert [r.k for r in navigation.page(df, "k", "v", 3, F.lit(10)).collect()] == [9, 8, 7]


def test_readers(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"segment_id": 1, "type": "final", "n": 1}\n\n{"segment_id": 1, "type": "final", "n": 2}\n{"segment_id": 2, "type": "polish", "n": 3}\n')
    assert rows(readers.jsonl(spark, str(tmp_path / "log.jsonl"), "segment_id long, type string, n int", ["segment_id", "type"])) == [(1, "final", 2), (2, "polish", 3)]
    (tmp_path / "bad.jsonl").write_text('{"segment_id": 1}\nnot json\n')
    with pytest.raises(Exception):
        readers.jsonl(spark, str(tmp_path / "bad.jsonl"), "segment_id long", ["segment_id"]).collect()
    (tmp_path / "s.json").write_text('{"segments": [{"segment_id": 4},\n {"segment_id": 7}]}')
    assert rows(readers.sample_ids(spark, str(tmp_path / "s.json"))) == [(4,), (7,)]
    (tmp_path / "a.log").write_text("[ANOMALY] x\nfine\n[ANOMALY] y\n")
    assert readers.count_lines(spark, str(tmp_path / "a.log")) == 2
    said = spark.createDataFrame([("Objection 2. It seems",), ("On the contrary, x",), ("I answer that, y",), ("Reply to Objection 3. z",), ("Other",)], "t string").select(readers.marker_type(F.col("t")).alias("m")).collect()
    assert [tuple(r.m) if r.m else None for r in said] == [("arg", 2), ("sed_contra", None), ("respondeo", None), ("reply", 3), None]
    pages = spark.createDataFrame([(1, '<P TITLE="I q. 1 a. 1 arg. 1">one<span class="ref">no</span> <p title="I q. 1 a. 1 co.">two</p>x<p title="I q. 1 a. 1 arg. 1">three</p>'), (2, None), (3, "<p>none</p>")], "id int, html string")
    assert rows(readers.elements(pages, "id", "html")) == [(1, "I.q1.a1.arg1", "arg", "one three"), (1, "I.q1.a1.respondeo", "respondeo", "two")]
    assert rows(readers.headings(spark.createDataFrame([("DE DEO",), ("De deo",), ("12",)], "t string"), "t")) == [("DE DEO",)]


def test_carry_forward(spark):
    lines = spark.createDataFrame([("f", 0, None, "lost"), ("f", 1, "A", ""), ("f", 2, None, "one"), ("f", 3, None, "two"), ("f", 4, "B", ""), ("f", 5, None, "three"), ("f", 6, "A", ""), ("f", 7, None, "last")], "file string, at int, tag string, text string")
    assert rows(readers.carry_forward(lines, "file", "at", "tag", "text")) == [("f", "A", "last"), ("f", "B", "three")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], None)], "id int, methods array<string>, note string")
    for frame, want in ((df, ["id,methods,note", "1,a|b,"]), (df.limit(0), ["id,methods,note"])):
        writers.csv_sheet(frame, str(tmp_path / "c"), ["id", "methods", "note"])
        assert "".join(p.read_text() for p in (tmp_path / "c").glob("*.csv")).split("\n")[: len(want)] == want
    sent = []
    rows_ = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("b", 1, 1)], "user string, segment_id int, n int")
    assert writers.send_digests(rows_, lambda u, lines: sent.append((u, lines)) or u != "b") == ["a"] and sent == [("a", ["1: 2", "2: 1"]), ("b", ["1: 1"])]
    writers.append_records(df.select("id"), str(tmp_path / "j"))
    writers.append_records(df.select("id"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert writers.report("T", [df.select("id")]) == "# T\nid\n1\n"


def scripted(script):
    class Scripted:
        """Answers by the source: a list of drafts and of reviews, where None is an error."""

        def __init__(self, script):
            self.script, self.tried = script, {}

        def draft(self, source, feedback):
            said = self.script[source][0]
            answer = said[min(len(feedback), len(said) - 1)]
            if answer is None:
                raise OSError("no line")
            return answer

        def review(self, source, draft):
            said = self.script[source][1].get(draft, ("PASS", ""))
            if said is None or (said[0] == "ONCE" and not self.tried.setdefault((source, draft), 0)):
                self.tried[source, draft] = 1
                raise OSError("no reviewer")
            return ("PASS", "") if said[0] == "ONCE" else said

    return Scripted(script)


def one_by_one(source, required, script, most=3):
    """The rounds of one segment, as a loop."""
    if not source:
        return ("needs_human", 0, None, None, ["0 no_source_text"], None)
    feedback, classes, passed, latest, last, n = [], [], None, None, None, 0
    for n in range(1, most + 1):
        draft = script[source][0][min(len(feedback), len(script[source][0]) - 1)]
        if draft is None:
            classes.append(f"{n} translator_error")
            break
        latest = (n, draft)
        missing = sorted(t for t in required if t not in draft.split())
        if missing:
            classes += [f"{n} precheck_terminology {t}" for t in missing]
            last = ", ".join(missing)
            feedback.append(last)
            continue
        passed = (n, draft)
        said = script[source][1].get(draft, ("PASS", ""))
        if said is None or said[0] == "ONCE":
            classes.append(f"{n} reviewer_error")
        if said is None:
            break
        if said[0] in ("PASS", "ONCE"):
            return ("translated", n, n, draft, classes, None)
        classes.append(f"{n} reviewer_revision")
        last = said[1] or None
        if not last:
            break
        feedback.append(last)
    chosen = passed or latest
    return ("needs_human" if chosen else "pending", n, chosen and chosen[0], chosen and chosen[1], classes, last)


def test_rounds_of_drafts_equal_a_loop(spark):
    script = {
        "ok": (["good word"], {}), "none": ([None], {}), "late error": (["word no", None], {"word no": ("REVISE", "more")}), "never": (["bad", "worse", "worst"], {}), "then": (["bad", "now word"], {}),
        "revised": (["word a", "word b"], {"word a": ("REVISE", "b")}), "deaf": (["word a"], {"word a": None}), "once": (["word a"], {"word a": ("ONCE", "")}), "silent": (["word a"], {"word a": ("REVISE", "")}),
        "back": (["word a", "bad", "bad"], {"word a": ("REVISE", "x")}), "tired": (["word a", "word b", "word c"], {"word a": ("REVISE", "1"), "word b": ("REVISE", "2"), "word c": ("REVISE", "3")}), "error after": (["bad", None], {}),
    }
    sources = [*script, "", None]
    segments = spark.createDataFrame([(k, x, "clash") for k, x in enumerate(sources)], "segment_id long, content string, status string")
    asked = spark.createDataFrame([(k, "word", "term") for k in range(len(sources))] + [(3, "bad", "term"), (3, "other", "term")], "segment_id long, required string, category string")
    got = flows.draft_rounds(segments, asked, spark.createDataFrame([], "lemma string, form string"), scripted(script))
    found = {r.segment_id: (r.status, r.rounds, r.chosen, r.draft, [" ".join(str(x) for x in c if x is not None) for c in r.classes], r.feedback) for r in got.collect()}
    assert found == {k: one_by_one(x, ["word", "bad", "other"] if k == 3 else ["word"], script) for k, x in enumerate(sources)}
    assert not flows.draft_rounds(segments.limit(0), asked, spark.createDataFrame([], "lemma string, form string"), scripted(script)).collect()


def test_gained_segments_of_terms_without_usage(spark):
    before = spark.createDataFrame([(1, 10), (2, 20)], "segment_id long, sense_id int")
    after = spark.createDataFrame([(1, 10), (2, 11), (3, 30), (4, 30), (4, 31), (5, 30), (6, 20)], "segment_id long, sense_id int")
    targets = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (3, 31)], "term_id int, sense_id int")
    assert rows(flows.gained(before, after, targets, spark.createDataFrame([(2,), (3,), (4,)], "segment_id long"))) == [(3, 3), (3, 4)]
    a, b = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, None), (3, "c"), (4, "d")], [(1, "a"), (2, None), (3, None), (5, "e")]))
    assert rows(mutate.changes(a, b, ["k"], ["v"])) == [(3, "changed"), (4, "removed"), (5, "added")]


def test_cues_by_their_rarest_trigram(spark):
    rng = random.Random(5)
    words = ["the thing", "Under", "el que", "ab", "x", "zzz", "ééé", "thing"]
    texts = [(k, "".join(rng.choice([*words, " ", ","]) for _ in range(rng.randrange(12)))) for k in range(80)] + [(80, None)]
    cues = [(k % 3, k, "".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2]))).upper()) for k in range(40)] + [(0, 99, ""), (1, 98, None)]
    candidates = [(k, t) for k, _ in texts for t in range(3) if rng.random() < 0.6]
    got = match.cue_signals(spark.createDataFrame(candidates, "segment_id int, term_id int"), spark.createDataFrame(cues, "term_id int, sense_id int, cue string"), spark.createDataFrame(texts, "segment_id int, content string"), 30)
    text = dict(texts)
    assert rows(got) == sorted({(k, i, 30) for k, t in candidates for u, i, c in cues if t == u and c and text[k] is not None and c.lower() in text[k].lower()})


def service_in(folder):
    class Service:
        """Batches in a folder that all workers see; ready at the second call."""

        def __init__(self, folder):
            self.folder = folder

        def submit(self, key, rows):
            import json
            import pathlib

            path = pathlib.Path(self.folder) / f"b{key}"
            if not path.exists():
                path.write_text(json.dumps(rows))
            with (pathlib.Path(self.folder) / "calls").open("a") as f:
                f.write(key + "\n")
            return path.name

        def poll(self, batch):
            import json
            import pathlib

            if batch.endswith("7") and not (seen := pathlib.Path(self.folder) / f"seen-{batch}").exists():
                seen.write_text("")
                return None
            return {k: text.replace("  ", " ") if k % 5 else "way too short" for k, text in json.loads((pathlib.Path(self.folder) / batch).read_text()) if k % 7}

    return Service(folder)


def test_polish_goes_on_after_each_state(spark, tmp_path):
    candidates = spark.createDataFrame([(k, f"one  sentence of the text number {k} that is long. And one  more.") for k in range(60)], "segment_id long, text string")
    ends = []
    for broken in (None, 2, 3, 4, 5):
        folder = tmp_path / str(broken)
        folder.mkdir()
        tables = TableSet(spark, f"file://{folder}/tables")
        commit, service = tables.commit, service_in(str(folder))
        if broken:

            def fails(read, new, commit=commit, broken=broken):
                out = commit(read, new)
                if out == broken:
                    raise OSError("killed")
                return out

            tables.commit = fails
            with pytest.raises(OSError):
                polish.polish(tables, candidates, service, ["text"], 9)
            tables.commit = commit
        for _ in range(3):
            states = polish.polish(tables, candidates, service, ["text"], 9)
        assert states == {"written": 60} and len((folder / "calls").read_text().split()) == 7
        ends.append(rows(tables.read()[1]["polished"]))
    assert all(e == ends[0] for e in ends) and len(ends[0]) == 60
    text = dict(ends[0])
    assert text[1] == "one sentence of the text number 1 that is long. And one more." and text[5].startswith("one  sentence") and text[7].startswith("one  sentence")


def test_stream_equals_batch(spark, tmp_path):
    from florilege.operators import activity
    from florilege.sources.model import view

    folder = "/root/testdata/sf0.001"
    people = activity.participants(view(spark, folder, "comment"), view(spark, folder, "review"))
    reads = view(spark, folder, "reads")
    batch = activity.unseen(view(spark, folder, "comment"), people, reads)
    got = []
    (tmp_path / "in").mkdir()
    for k, part in enumerate(spark.read.parquet(f"{folder}/events.parquet").randomSplit([0.5, 0.5], 1)):
        part.write.mode("append").parquet(str(tmp_path / "in"))
    stream = unread.unread(unread.comments(unread.events(spark, str(tmp_path / "in"))), people, reads)
    unread.run_available(stream, lambda df, i: got.extend(df.collect()), str(tmp_path / "check"))
    assert sorted((r.user, r.comment_id) for r in got) == rows(batch, "user", "comment_id") and got
    closed = []
    unread.run_available(unread.windowed_activity(unread.events(spark, str(tmp_path / "in"))), lambda df, i: closed.extend(df.collect()), str(tmp_path / "check2"))
    unread.run_available(unread.sessions(unread.events(spark, str(tmp_path / "in"))), lambda df, i: closed.extend(df.collect()), str(tmp_path / "check3"))
    assert closed


def test_records_of_several_files(spark, tmp_path):
    """The last record wins by file name and line, however large a file is."""
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"k": 1, "n": 1}\n{"k": 2, "n": 5}\n')
    (folder / "b.jsonl").write_text("".join('{"k": 3, "n": %d}\n' % i for i in range(2000)) + '{"k": 1, "n": 2}\n')
    (folder / "c.jsonl").write_text('{"k": 2, "n": 6}\n')
    assert rows(readers.jsonl(spark, str(folder), "k int, n int", ["k"])) == [(1, 2), (2, 6), (3, 1999)]


def test_locators_and_coordinates(spark):
    titles = {
        "I q. 1 a. 1 s. c. 2": "I.q1.a1.sed_contra", " I-II q. 3 a. 1 ad arg. ": "I_II.q3.a1.reply0", "I q. 2": None, "I q. 2 a. 3": None, "II q. 1 pr.": None, "III q. 10 pr.": "III.q10.preamble", "I q. 1 a. 1 co": None,
        "II-II q. 7 a. 12 arg.3": "II_II.q7.a12.arg3", "I q. 9 a. 3 ad 2": "I.q9.a3.reply2",
    }
    got = spark.createDataFrame(list(titles.items()), "t string, want string").select("t", readers.parse_locator(F.col("t"))["path"].alias("p")).collect()
    assert {r.t: r.p for r in got} == titles
    lines = {"I ot. 2 čl. 3 arg. 1 Zdá se": "I.q2.a3.arg1", " I-II ot. 1 čl. 1 protiarg.": "I_II.q1.a1.sed_contra", "III ot. 4 čl. 2 odp.": "III.q4.a2.respondeo", "I ot. 2 čl. 3 k 4": "I.q2.a3.reply4", "II-II ot. 8 pr.": "II_II.q8.preamble", "text": None, "I ot. 2 čl. 3": None}
    got = spark.createDataFrame(list(lines.items()), "t string, want string").select("t", readers.parse_coordinate(F.col("t")).alias("p")).collect()
    assert {r.t: r.p for r in got} == lines


def test_preferred_source_and_gaps(spark):
    files = spark.createDataFrame([("I", 1, "f", 1), ("I", 1, "d", 2), ("I", 2, "d", 2), ("I", 3, "d", 2)], "part string, q int, source string, rank int")
    wanted = spark.createDataFrame([("I", k) for k in (1, 1, 2, 3, 4)], "part string, q int")
    found, gaps = readers.preferred_source(wanted, files, ["part", "q"], spark.createDataFrame([("I", 1), ("I", 2)], "part string, q int"))
    assert rows(found) == [("I", 1, "f"), ("I", 2, "d"), ("I", 3, "d")] and rows(gaps) == [("I", 2, "fallback"), ("I", 4, "none")]


def test_record_or_default(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"n": 3,\n "name": "x"}')
    assert rows(readers.json_or(spark, str(tmp_path / "s.json"), "n int, name string", (0, None))) == [(3, "x")]
    assert rows(readers.json_or(spark, str(tmp_path / "none.json"), "n int, name string", (0, None))) == [(0, None)]


def test_glossary_of_repeated_lemmas(spark):
    lines = spark.createDataFrame([(1, "ratio, mens – rozum (vis: schopnosť), dôvod"), (2, "no dash"), (3, "ratio – pomer")], "at int, value string")
    got = readers.senses(readers.glossary(lines))
    assert rows(got, "lemma", "at", "position", "context", "content") == [("mens", 1, 0, "vis", "rozum"), ("mens", 1, 1, None, "dôvod"), ("ratio", 1, 0, None, "pomer")]


def test_completeness_of_articles(spark):
    kinds = spark.createDataFrame([(1, "arg"), (1, "reply"), (1, "respondeo"), (2, "arg"), (3, "sed_contra")], "article int, kind string")
    got = guards.completeness(kinds, "article", "kind", ["arg", "reply"], ["respondeo", "sed_contra"])
    assert rows(got.select("article", F.array_join("fails", ",").alias("f"), F.array_join("warns", ",").alias("w"))) == [(1, "", "sed_contra"), (2, "reply", "respondeo,sed_contra"), (3, "arg,reply", "respondeo")]


def resolved(text, phrases, lemmas, own, senses, signals, gaps, suppressed, has):
    """One segment after the other, as a person would."""
    said = re.findall(r"[^\W\d_]+", text.lower())
    spans = sorted({(i, -len(p.split()), t) for t, p in phrases for i in range(len(said)) if said[i : i + len(p.split())] == p.split()})
    out, end, used, masked = {}, 0, set(), text
    for start, minus, t in spans:
        if start >= end:
            end = start - minus
            used.add(t)
            out.setdefault(t, ("hit", None))
    places = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", text)]
    for start, minus, t in spans:
        if t in used:
            a, b = places[start][0], places[start - minus - 1][1]
            masked = masked[:a] + " " * (b - a) + masked[b:]
    candidates = set()
    for token in sorted({w.lower() for w in re.findall("[a-zA-Z]+", masked)}):
        of = [lemma for _, lemma in sorted((c, x) for s, c, x in lemmas if s == token)] or [token]
        term = next((t for x in of for t, y in own if y == x.lower()), None)
        if term is None:
            candidates.add(re.sub(r"\d+$", "", of[0]).lower())
        elif token not in suppressed:
            out.setdefault(term, ("hit", None))
    for lemma, t, sense in gaps:
        if lemma in candidates and len(lemma) >= 4:
            out.setdefault(t, ("gap", sense))
    rows_ = []
    for t, (how, sense) in out.items():
        if how == "gap":
            rows_.append((t, sense, "czech_derived" if has[0] else "english_derived" if has[1] else "model_proposed", "needs_review"))
            continue
        of = [(i, label) for i, u, label in senses if u == t]
        heard = {i for i, _ in signals if i in {x for x, _ in of}}
        strong = any(r <= 20 for i, r in signals if i in heard)
        first = next((i for i, label in of if label is None), of[0][0])
        if len(of) == 1:
            rows_.append((t, first, "single", "auto"))
        elif len(heard) == 1 and strong:
            rows_.append((t, heard.pop(), "multi_voted", "auto"))
        else:
            rows_.append((t, first, "multi_flagged", "needs_review"))
    return rows_


def test_resolved_segments_equal_a_loop(spark):
    rng = random.Random(11)
    words = ["actus", "Actus", "essendi", "per", "se", "habitum", "caritas", "Caritas", "virtus", "esse", "unde", "quod", "gratia"]
    phrases = [(1, "actus essendi"), (2, "per se"), (3, "se actus"), (4, "per se actus")]
    lemmas = [("habitum", 0, "habitus"), ("virtus", 0, "vir"), ("virtus", 1, "Virtus2"), ("caritas", 0, "caritas"), ("unde", 0, "undo3"), ("quod", 0, "qui"), ("essendi", 0, "Esse")]
    own = [(5, "habitus"), (6, "caritas"), (7, "virtus2"), (8, "esse")]
    senses = [(10 * t + j, t, None if j == 1 else "x") for t in range(1, 9) for j in range(1 + t % 3)]
    gaps = [("undo", 20, 200), ("gratia", 21, 210), ("qui", 22, 220), ("actus", 23, 230)]
    texts, signals, suppressed, want = [], [], [], []
    for i in range(120):
        text = " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(rng.randrange(12)))
        czech, english = rng.choice([None, "", "text"]), rng.choice([None, "text"])
        own_signals = [(s[0], rng.choice([10, 30])) for s in senses if rng.random() < 0.2]
        gone = {"habitum"} if rng.random() < 0.3 else set()
        texts.append((i, text, czech, english))
        signals += [(i, *x) for x in own_signals]
        suppressed += [(i, x) for x in gone]
        want += [(i, *r) for r in resolved(text, phrases, lemmas, own, senses, own_signals, gaps, gone, (czech, english))]
    frame = spark.createDataFrame
    got = terms.resolve_segments(
        frame(texts, "segment_id long, content string, czech string, english string"), frame(phrases, "phrase_id long, phrase string"), frame(lemmas, "surface string, candidate int, lemma string"), frame(own, "term_id long, lemma string"),
        frame(senses, "sense_id long, term_id long, label string"), frame(signals, "segment_id long, sense_id long, rank int"), frame(gaps, "lemma string, term_id long, sense_id long"), frame(suppressed, "segment_id long, token string"))
    found = {tuple(r) for r in got.select("segment_id", "term_id", "sense_id", "method", "confidence").collect()}
    assert found == set(want) and got.count() == len(want)
    assert {r[3] for r in want} >= {"single", "multi_voted", "multi_flagged", "czech_derived"}


def test_codes_that_must_be_known(spark):
    codes, dimension = spark.createDataFrame([("a",), ("b",)], "code string"), spark.createDataFrame([("a", 1)], "code string, id int")
    assert rows(lookups.ids_of(codes, dimension, "code", "id")) == [("a", 1), ("b", None)]
    with pytest.raises(Exception, match="no id for b"):
        lookups.ids_of(codes, dimension, "code", "id", required=True).collect()
    links = spark.createDataFrame([("/q/st03.pdf",), ("/other",), ("/q/stx.pdf",)], "link string")
    assert rows(acceptance.link_numbers(links, "link", "/q/st", ".pdf", strict=False)) == [("/q/st03.pdf", 3), ("/q/stx.pdf", None)]
    with pytest.raises(Exception, match="unexpected link /q/stx.pdf"):
        acceptance.link_numbers(links, "link", "/q/st", ".pdf").collect()


def test_reports(spark, tmp_path):
    segments = spark.createDataFrame([(i,) for i in range(5)], "segment_id int")
    texts = spark.createDataFrame([(1, "sk", "abc"), (2, "sk", "d"), (1, "en", "x")], "segment_id int, lang string, content string")
    usage = spark.createDataFrame([("auto",), ("auto",), ("needs_review",)], "confidence string")
    text = reports.coverage_report(segments, texts, ["sk", "la"], usage)
    assert "- sk: 2/5 (40.0%); first missing: 0, 3, 4" in text and "- la: 0/5 (0.0%)" in text and "auto | 2" in text and "sk | 4" in text
    runs = spark.createDataFrame([(0, 1, "translated", 1, 10, "arg"), (0, 2, "needs_human", 3, 30, "arg"), (1, 1, "translated", 1, 10, "arg"), (1, 2, "translated", 2, 30, "co")], "run_id int, segment_id int, status string, iterations int, chars int, element_type string")
    assert "- cost: $1.0000 ($0.250000 a segment)" in reports.production_report(runs, 1.0) and "- average iterations: 1.75" in reports.production_report(runs, 1.0)
    assert "$0.000000 a segment" in reports.production_report(runs.limit(0), 0.0)
    assert "- corpus at this price: $10.00" in reports.pilot_report(runs, 800, 1.0) and "1/4 (25.0%)" in reports.pilot_report(runs, 800, 1.0)
    both = reports.comparison_report(runs, 0, 1)
    assert "needs_human | 1 | 0 | -1 | ▼" in both and "2 | needs_human | translated" in both
    polished = spark.createDataFrame([(True, []), (False, ["la", "of"]), (False, ["la"])], "ok boolean, lost array<string>")
    assert "1/3 (33.3%)" in reports.polish_report(polished) and "la | 2\nof | 1" in reports.polish_report(polished)
    notes = spark.createDataFrame([("I.q2", 1, "b"), ("I.q1", 2, "a")], "path string, iteration int, feedback string")
    assert reports.triage_report(notes).endswith("I.q1 | 2 | a\nI.q2 | 1 | b\n") and "... more than 1 lines" in reports.triage_report(notes, 1)
    reports.save_record(spark, {"calls": 3}, "calls int, cost double", str(tmp_path / "stats"))
    assert rows(readers.json_or(spark, str(tmp_path / "stats"), "calls int, cost double", (0, 0.0))) == [(3, None)]
    for _ in range(2):
        reports.append_rows(runs, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 8


def test_ratios_round_as_sql_does(spark):
    import duckdb

    pairs = [(255, 400), (251, 400), (577, 800), (1, 3), (0, 7)] + [(k, n) for n in (160, 400, 800, 8000) for k in range(1, n, 7)]
    df = spark.createDataFrame(pairs, "a int, b int")
    text = lambda c: F.repeat(F.lit("x"), F.col(c))
    got = df.select("a", "b", tx.length_ratio(text("a"), text("b")).alias("r"), tx.percentage(F.col("a"), F.col("b")).alias("p")).collect()
    said = ", ".join(f"({a}, {b})" for a, b in pairs)
    want = duckdb.connect().execute(f"SELECT a, b, round(a / b, 4), round(100 * a / b, 1) FROM (VALUES {said}) AS t(a, b)").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert one(spark, tx.percentage(F.lit(255), F.lit(400))) == 63.8 and one(spark, tx.percentage(F.lit(1), F.lit(0))) == 0.0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rates_go_to_the_rows(spark):
    given = spark.range(10).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("model"), *(F.lit(1.0).alias(c) for c in ("input", "cached", "output")))
    rates = spark.createDataFrame([("a", 1.0, 1.0, 1.0), ("b", 2.0, 2.0, 2.0)], "model string, input_rate double, cached_rate double, output_rate double")
    assert "SortMergeJoin" not in plan_of(rollup.token_cost(given, rates)) and "BroadcastHashJoin" in plan_of(rollup.token_cost(given, rates))


def test_gained_terms_need_no_comparison_of_snapshots(spark):
    pairs = lambda *x: spark.createDataFrame(list(x), "segment_id long, sense_id long")
    targets = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30)], "term_id long, sense_id long")
    got = flows.gained(pairs((1, 10), (1, 99)), pairs((1, 10), (2, 11), (2, 20), (2, 20), (3, 20), (4, 30), (5, 99)), targets, spark.createDataFrame([(2,), (4,)], "segment_id long"))
    assert rows(got, "term_id", "segment_id") == [(2, 2), (3, 4)]
    assert "FullOuter" not in plan_of(got)


def test_proposals_without_a_key_are_dealt_out(spark):
    from florilege.operators import proposals

    given = spark.range(4000).select(F.col("id").alias("proposal_id"), F.when(F.col("id") % 1000 == 0, F.col("id")).alias("sense_id"))
    other = spark.createDataFrame([(0, "zero"), (1000, "one"), (-1, "none")], "sense_id long, label string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = proposals._joined(given, other, "sense_id")
        sizes = [r["n"] for r in got.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("*").alias("n")).collect()]
        assert sorted(r["proposal_id"] for r in got.filter("label IS NOT NULL").collect()) == [0, 1000] and got.count() == 4000
        assert "hashpartitioning(sense_id" in plan_of(got) and "_deal" in plan_of(got).split("hashpartitioning(", 1)[1].split(")", 1)[0], sizes
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cues_that_many_senses_share(spark):
    import time

    texts = spark.range(3000).select(F.col("id").alias("segment_id"), F.concat(F.lit("red wit and bol "), F.when(F.col("id") == 7, "red bolt").otherwise("")).alias("content"))
    cues = spark.range(20_000).select(F.lit(1).alias("term_id"), F.col("id").alias("sense_id"), F.lit("red bolt").alias("cue"))
    begun = time.time()
    got = match.cue_signals(texts.select("segment_id", F.lit(1).alias("term_id")), cues.union(cues.select("term_id", "sense_id", F.lit("wit-x"))), texts, 30)
    assert got.count() == 20_000 and got.select("segment_id").distinct().count() == 1
    assert time.time() - begun < 60
