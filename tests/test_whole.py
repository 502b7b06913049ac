"""Queries over whole tables: small tables whose ids lie far apart, held against loops."""

import datetime

import pytest

from florilege.plans import registry
from florilege.sinks import writers
from florilege.sources import readers
from florilege.sources.model import view


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("whole"))
    day = datetime.date(2024, 1, 2)
    orders = [1, 7, 8, 399, 400, 499, 500, 1999, 2000, 3998, 19999, 20000, 39998, 40000]
    parts = [1, 4, 8, 15, 19, 20, 99, 100, 200, 300, 1499, 1500, 2998, 3000, 4500, 9000]

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")

    put("documents", [(1, "the thing in the box"), (199, None), (200, "the thing"), (300, "x"), (5000, "so in the thing")], "doc_id long, text string")
    put("nation", [(k, k % 2) for k in range(3)], "n_nationkey int, n_regionkey int")
    put("customer", [(k, k % 3) for k in range(5)], "c_custkey long, c_nationkey int")
    put("orders", [(k, i % 5, ["1-URGENT", "2-HIGH"][i % 2], "FOP"[i % 3], day, 1.0 * i) for i, k in enumerate(orders)], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, o_orderdate date, o_totalprice double")
    put("part", [(k, f"Brand#{1 + i % 4}", f"T{i % 2}", i, f"n{i % 3}") for i, k in enumerate(parts)], "p_partkey long, p_brand string, p_type string, p_size int, p_name string")
    put("lineitem", [(o, parts[(i * 5 + n * 3) % len(parts)], n, "ANR"[(i + n) % 3], "FO"[n % 2], [0.01, 0.06, 0.1][(i * n) % 3], day) for i, o in enumerate(orders) for n in range(1, 8)], "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_discount double, l_shipdate date")
    put("labels", [(k, 0, i % 2) for i, k in enumerate(orders[::2])], "doc_id long, quality int, toxic int")
    return d


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


def run(spark, folder, name):
    return registry.queries()[name](spark, folder)


def test_terminology_of_all_documents(spark, folder):
    assert rows(run(spark, folder, "T16_terminology")) == [(1, ""), (199, "the thing,in the"), (200, "in the"), (300, "the thing,in the"), (5000, "")]


def test_carry_forward_of_all_documents(spark, tmp_path):
    texts = {1: "Alpha\nlow\n\nnext\nmore", 299: "Zed\nno tag", 300: "Beta\none", 7000: "Cee\nx\ny\nDee\nz\nz\nCat\n  last "}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for doc, text in texts.items():
        tag, runs = None, {}
        for at, line in enumerate(text.split("\n")):
            if line[:1] and line[0] in "ABCDEFGHIJKLM" and at % 3 == 0:
                tag = line[0]
                runs[tag] = []
            elif tag and line.strip():
                runs[tag].append(line.strip())
        want |= {(doc, k): len(" ".join(x)) for k, x in runs.items() if x}
    assert rows(run(spark, str(tmp_path), "S04_carry_forward")) == sorted(((*k, n) for k, n in want.items()), key=str)


def test_votes_of_all_segments(spark, folder):
    senses, usage = (view(spark, folder, n).collect() for n in ("sense", "usage"))
    want = []
    for (segment,) in view(spark, folder, "segment").select("segment_id").collect():
        term = 1 + segment % 25
        own = [x for x in senses if x.term_id == term]
        if not own:
            continue
        main = min(own, key=lambda x: (x.label is not None, x.sense_id)).sense_id
        heard = [(u.sense_id, 20 if u.used < 4 else 30) for u in usage if u.segment_id == segment and u.sense_id in {x.sense_id for x in own}]
        sure = len({k for k, _ in heard}) == 1 and min(r for _, r in heard) <= 20
        want.append((segment, term, heard[0][0] if sure and len(own) > 1 else main, "auto" if sure or len(own) == 1 else "needs_review"))
    assert max(want)[0] > 300
    assert rows(run(spark, folder, "T08_votes"), "segment_id", "term_id", "sense_id", "confidence") == sorted(want, key=str)


def test_commands_of_all_segments(spark, folder):
    segments, review = view(spark, folder, "segment").collect(), {r.segment_id: r for r in view(spark, folder, "review").collect()}
    reviews = {k: (r.human_version, r.reviewer, f"n{k % 3}") for k, r in review.items()}
    texts, outcomes = {k: "old" for k in review if k % 2 == 0}, []
    known = {s.segment_id for s in segments}
    for s in segments:
        n = s.segment_id
        k, action, expected = n + 10**9 if n % 17 == 0 else n, ("save", "accept", "note", "reset")[n % 4], n % 3
        held = reviews.get(k)
        if k not in known:
            outcomes.append((k, None, "notfound"))
        elif (held is None and action == "reset" and expected) or (held is not None and held[0] != expected):
            outcomes.append((k, None, "conflict"))
        elif action == "reset":
            reviews.pop(k, None)
            texts.pop(k, None)
            outcomes.append((k, 0, "ok"))
        else:
            version = held[0] + 1 if held else 1
            reviews[k] = (version, "boss", "new note" if action == "note" else held[2] if held else None)
            texts |= {k: f"t{n}"} if action == "save" else {}
            outcomes.append((k, version, "ok"))
    want = [("outcome", *x, None) for x in outcomes] + [("review", k, *x) for k, x in reviews.items()] + [("text", k, None, None, x) for k, x in texts.items()]
    assert rows(run(spark, folder, "U04_optimistic_lock"), "what", "segment_id", "version", "who", "said") == sorted(want, key=str)
    assert rows(run(spark, folder, "K03_sheet_merge"), "segment_id", "status", "note") == sorted(((s.segment_id, s.status, review[s.segment_id].reviewer if s.segment_id in review else None) for s in segments), key=str)
    state, reasons = {s.segment_id: s.status for s in segments}, {}
    for s in segments:
        k, to = s.segment_id * 2 - s.segment_id % 2, "translated" if s.segment_id % 3 == 0 else "needs_human"
        now = state.get(k)
        may = now == ("needs_human" if to == "translated" else "translated")
        reason = "notfound" if now is None else "wrong_status" if not may else "already_polished" if to == "needs_human" and k in review else "ok"
        reasons[reason] = reasons.get(reason, 0) + 1
    assert rows(run(spark, folder, "U05_transitions"), "reason", "n") == sorted(reasons.items(), key=str)
    got = run(spark, folder, "K02_exchange_file").collect()
    parts = {}
    for s in segments:
        parts[s.pars] = parts.get(s.pars, 0) + 1
    assert {p: sum(r.pars == p for r in got) for p in parts} == {p: n + 2 for p, n in parts.items()}


def test_exchange_documents_are_put_in_order(spark, folder):
    """The lines of each part, by their places alone, are one document, with its number of units."""
    import xml.etree.ElementTree as et

    segments = view(spark, folder, "segment").collect()
    got = run(spark, folder, "K02_exchange_file").collect()
    for part in {s.pars for s in segments}:
        lines = sorted((r for r in got if r.pars == part), key=lambda r: r["at"])
        units = sorted(s.path.replace(".", "_") for s in segments if s.pars == part)
        assert [r["at"] for r in lines] == list(range(len(units) + 2)) and {r["units"] for r in lines} == {len(units)}
        root = et.fromstring("".join(r.line for r in lines))
        assert len(units) == len(list(root.iter("{urn:oasis:names:tc:xliff:document:2.0}unit")))
        assert [r.path for r in lines[1:-1]] == sorted(s.path for s in segments if s.pars == part)


def test_exchange_documents_in_files(spark, tmp_path):
    import xml.etree.ElementTree as et

    given = spark.range(500).selectExpr("concat('p', id % 3) AS pars", "concat('p', id % 3, '.q', lpad(id, 4, '0')) AS path", "'a < b' AS source", "'x & y' AS target", "CASE WHEN id % 2 = 0 THEN 'said' END AS note")
    writers.write_exchange(given.repartition(7), str(tmp_path / "x"), "la", "sk")
    for part in range(3):
        files = sorted((tmp_path / "x" / f"pars=p{part}").glob("part-*.txt"))
        root = et.fromstring("".join(f.read_text() for f in files))
        ids = [u.get("id") for u in root.iter("{urn:oasis:names:tc:xliff:document:2.0}unit")]
        assert ids == [f"p{part}_q{k:04d}" for k in range(500) if k % 3 == part]


def test_elements_that_markers_open(spark):
    page = """<h1>Top</h1><p>before</p><p>Objection 1. one <b>bold</b>&nbsp;<p>goes on<script>var p = "<p>Objection 9. no</p>"</script></p><h2>minor</h2><p>still on</p>
    <P class=x>On the contrary, two</P><!-- <p>Objection 3. no</p> --><h1>Next</h1><p>loose</p><p>I answer that, three</p><p>Reply to Objection 2. four</p><p></p>"""
    pages = spark.createDataFrame([(1, page), (2, None), (3, "<p>Objection 1. no heading</p>"), (4, "")], "id int, html string")
    got = rows(readers.marked_elements(pages, "id", "html"), "kind", "number", "text")
    assert got == sorted([("arg", 1, "Objection 1. one bold &nbsp; goes on still on"), ("sed_contra", None, "On the contrary, two"), ("respondeo", None, "I answer that, three"), ("reply", 2, "Reply to Objection 2. four")], key=str)
    assert [r.heading for r in readers.marked_elements(pages, "id", "html").orderBy("at").collect()] == [0, 0, 7, 7]


def test_all_senses_retired_and_proposed(spark, folder):
    senses = {r.sense_id: r for r in view(spark, folder, "sense").collect()}
    gone = (4, 8, 15)
    assert rows(run(spark, folder, "U10_retire"), "sense_id", "status", "version") == sorted(((k, "retired" if k in gone else r.status, r.version + (k in gone)) for k, r in senses.items()), key=str)


def test_reasons_of_proposals_of_all_usages(spark, folder):
    senses = {r.sense_id: r for r in view(spark, folder, "sense").collect()}
    usage = view(spark, folder, "usage").collect()
    bound = {(u.segment_id, u.sense_id) for u in usage if u.status != "rejected" and senses[u.sense_id].status == "approved" and senses[u.sense_id].content is not None}
    want = []
    for u in usage:
        n, kind, own = u.segment_id, ("rendering", "sense_here", "remove_here", "retire_sense")[(u.segment_id + u.used) % 4], senses[u.sense_id]
        to = (min(k for k, r in senses.items() if r.term_id == own.term_id), u.sense_id + 1, None)[n % 3]
        text, reason = ("", own.content, "new", None, None)[n % 5], "ok"
        if n % 11 == 0:
            reason = "not_found"
        elif kind == "rendering":
            reason = "proposed_sk_required" if not text else "no_change" if text == own.content else "ok"
        elif kind in ("sense_here", "remove_here") and (n, u.sense_id) not in bound:
            reason = "not_locked_here"
        elif kind == "sense_here" and to is not None:
            reason = "no_change" if to == u.sense_id else "wrong_term" if to not in senses or senses[to].term_id != own.term_id else "ok"
        elif kind == "sense_here":
            reason = "missing_target" if not text else "no_change" if text == own.content else "ok"
        want.append((n * 10 + u.used, reason))
    assert rows(run(spark, folder, "G10_proposal_reasons"), "proposal_id", "reason") == sorted(want, key=str)


def test_roll_ups_of_all_usages(spark, folder):
    senses, path = ({r[k]: r for r in view(spark, folder, n).collect()} for n, k in (("sense", "sense_id"), ("segment", "segment_id")))
    usage = [u for u in view(spark, folder, "usage").collect() if u.status != "rejected"]
    groups, lists = {}, {}
    for u in usage:
        x = senses[u.sense_id]
        groups.setdefault((x.term, x.label, x.content), []).append(u)
        lists.setdefault(u.sense_id, set()).add(u.segment_id)
    want = [(*k, len(g), max(u.confidence for u in g), "|".join(sorted({u.method for u in g})), "|".join(sorted({path[u.segment_id].path for u in g}))) for k, g in groups.items()]
    assert rows(run(spark, folder, "A10_dedup_rollup"), "term", "label", "content", "frequency", "confidence", "methods", "locators") == sorted(want, key=str)
    assert rows(run(spark, folder, "Q16_usage_lists"), "sense_id", "segments") == sorted(((k, ",".join(map(str, sorted(x)))) for k, x in lists.items()), key=str)


def test_absent_numbers_of_all_usages(spark, folder):
    held = {u.sense_id for u in view(spark, folder, "usage").collect()}
    assert rows(run(spark, folder, "O09_absent_numbers"), "sense_id") == sorted(((k,) for k in range(1, 401) if k not in held), key=str)


def test_feed_of_all_usages(spark, folder):
    spark.sql("SELECT 1L AS event_id, 2L AS user_id, 'click' AS event_type, timestamp '2024-01-02 00:00:00' AS ts").write.mode("overwrite").parquet(f"{folder}/events.parquet")
    n = {r.kind: (r.n, r.senses) for r in run(spark, folder, "O06_feed").collect()}
    all_usages = view(spark, folder, "usage").count()
    assert n["usage"] == (all_usages, all_usages) and n["comment"] == (1, 0)
