"""Counts, roll-ups, comparisons, changes of state and validators."""

from __future__ import annotations

from pyspark.sql import functions as F

from florilege.operators import authority, guards, mutate, proposals, rollup, sample, stale
from florilege.plans import flows
from florilege.sources.model import model_sql, view


def _seg(s, d):
    return view(s, d, "segment")


def _radius(s, d):
    return stale.blast_radius(view(s, d, "usage"), _seg(s, d), view(s, d, "review"), view(s, d, "sense"))


def _having(s, d):
    t = view(s, d, "usage").filter("status = 'confirmed'").join(view(s, d, "sense"), "sense_id")
    return t.groupBy("term_id").agg(F.count_distinct("segment_id").alias("n")).filter("n >= 300")


def _minmax(s, d):
    return view(s, d, "sense").groupBy("term_id").agg(F.count_if(F.col("status") == "approved").alias("approved"), F.max("version").cast("bigint").alias("latest"))


def _sample_base(s, d):
    hits = view(s, d, "usage").join(view(s, d, "sense").select("sense_id", "category", F.col("status").alias("sense_status")), "sense_id")
    hits = hits.groupBy("segment_id").agg(F.count_if(F.col("category") == "formula").alias("formulas"), F.count_if(F.col("sense_status") == "approved").alias("approved"))
    return _seg(s, d).select("segment_id", "pars", "question_path").join(hits, "segment_id", "left").fillna(0, ["formulas", "approved"])


def _failures(s, d):
    f = view(s, d, "failure").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    classes = F.concat(F.lit('[{"class":"c'), (F.col("k") % 5).cast("string"), F.lit('","term":"t'), (F.col("k") % 7).cast("string"), F.lit('"},{"class":"d'), (F.col("k") % 3).cast("string"), F.lit('"}]'))
    return rollup.failure_classes(f.withColumn("classes", F.when(F.col("k") % 11 != 0, classes)))


_FAILURES = model_sql("failure") + """, e AS (SELECT run_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM failure),
f AS (SELECT run_id, 'c' || k % 5 || '(t' || k % 7 || ')' AS failure FROM e WHERE k % 11 <> 0 UNION ALL SELECT run_id, 'd' || k % 3 FROM e WHERE k % 11 <> 0),
n AS (SELECT run_id, failure, count(*) AS n FROM f GROUP BY 1, 2)"""


def _example(s, d):
    usage = view(s, d, "usage").filter("status <> 'rejected'").join(_seg(s, d).select("segment_id", "path"), "segment_id")
    first = usage.groupBy("sense_id").agg(F.count("*").alias("n"), F.min("used").cast("bigint").alias("least"), F.min_by("segment_id", "path").alias("first"))
    return first.join(authority.mode_of(usage, "sense_id", "method"), "sense_id")


def _upsert(s, d):
    old = view(s, d, "review").select("segment_id", "reviewer", F.col("human_version").cast("bigint").alias("version"))
    new = view(s, d, "comment").groupBy("segment_id").agg(F.max("author").alias("reviewer"), F.lit(9).cast("bigint").alias("version"))
    return mutate.upsert(old, new, ["segment_id"])


def _insert_missing(s, d):
    old = view(s, d, "review").select("segment_id", "reviewer")
    new = view(s, d, "comment").groupBy("segment_id").agg(F.max("author").alias("reviewer"))
    return mutate.insert_missing(old, new, ["segment_id"])


def _guarded(s, d):
    old = view(s, d, "sense").select("sense_id", "status")
    new = old.filter("sense_id % 3 = 0").select("sense_id", F.lit("flagged").alias("status"))
    return mutate.guarded_upsert(old, new, ["sense_id"], view(s, d, "sense").filter("status = 'approved'"))


def _optimistic(s, d):
    """A command for each segment, and for some that aren't there: outcomes, reviews and texts after them."""
    n = F.col("segment_id")
    reviews = view(s, d, "review").select("segment_id", "reviewer", F.col("human_version").alias("version"), F.concat(F.lit("n"), (n % 3).cast("string")).alias("note"))
    texts = view(s, d, "review").filter("segment_id % 2 = 0").select("segment_id", F.lit("old").alias("content"))
    action = F.get(F.array(*map(F.lit, ("save", "accept", "note", "reset"))), (n % 4).cast("int"))
    commands = _seg(s, d).select(F.when(n % 17 == 0, n + 10**9).otherwise(n).alias("segment_id"), action.alias("action"), (n % 3).cast("int").alias("expected"), F.lit("boss").alias("by"), F.concat(F.lit("t"), n.cast("string")).alias("content"), F.lit("new note").alias("note"))
    out = mutate.review(_seg(s, d), reviews, texts, commands)
    none = F.lit(None).cast("string")
    shown = [out["outcome"].select(F.lit("outcome").alias("what"), "segment_id", F.col("version").cast("bigint").alias("version"), F.col("outcome").alias("who"), none.alias("said")), out["review"].select(F.lit("review"), "segment_id", F.col("version").cast("bigint"), "reviewer", "note")]
    return shown[0].union(shown[1]).union(out["text"].select(F.lit("text"), "segment_id", F.lit(None).cast("bigint"), none, "content"))


_COMMANDS = model_sql("segment", "review") + """, c AS (SELECT CASE WHEN segment_id % 17 = 0 THEN segment_id + 1000000000 ELSE segment_id END AS segment_id, list_extract(['save', 'accept', 'note', 'reset'], CAST(segment_id % 4 + 1 AS INT)) AS action, CAST(segment_id % 3 AS INT) AS expected, 't' || segment_id AS content FROM segment),
o AS (SELECT c.*, human_version AS v, 'n' || c.segment_id % 3 AS old, CASE WHEN s.segment_id IS NULL THEN 'notfound' WHEN human_version IS NULL THEN CASE WHEN action = 'reset' AND expected <> 0 THEN 'conflict' ELSE 'ok' END WHEN human_version = expected THEN 'ok' ELSE 'conflict' END AS outcome
FROM c LEFT JOIN segment s ON s.segment_id = c.segment_id LEFT JOIN review r ON r.segment_id = c.segment_id), k AS (SELECT * FROM o WHERE outcome = 'ok')
SELECT 'outcome' AS what, segment_id, CAST(CASE WHEN outcome <> 'ok' THEN NULL WHEN action = 'reset' THEN 0 ELSE coalesce(v, 0) + 1 END AS BIGINT) AS version, outcome AS who, CAST(NULL AS VARCHAR) AS said FROM o
UNION ALL SELECT 'review', segment_id, CAST(human_version AS BIGINT), reviewer, 'n' || segment_id % 3 FROM review WHERE segment_id NOT IN (SELECT segment_id FROM k)
UNION ALL SELECT 'review', segment_id, CAST(coalesce(v, 0) + 1 AS BIGINT), 'boss', CASE WHEN action = 'note' THEN 'new note' WHEN v IS NOT NULL THEN old END FROM k WHERE action <> 'reset'
UNION ALL SELECT 'text', segment_id, NULL, NULL, 'old' FROM review WHERE segment_id % 2 = 0 AND segment_id NOT IN (SELECT segment_id FROM k WHERE action IN ('reset', 'save')) UNION ALL SELECT 'text', segment_id, NULL, NULL, content FROM k WHERE action = 'save'"""


def _bump(s, d):
    sense = view(s, d, "sense").select("sense_id", "version", "content")
    changes = sense.filter("sense_id % 4 = 0").select("sense_id", F.when(F.col("sense_id") % 8 == 0, F.col("content")).when(F.col("sense_id") % 12 != 0, F.lit("new words")).alias("content"))
    return mutate.bump_on_change(sense, changes, "sense_id", "content").select("sense_id", F.col("version").cast("bigint").alias("version"), "content")


def _reset(s, d):
    old = stale.stale_segments(view(s, d, "usage"), view(s, d, "sense"))
    return stale.guard_and_reset(_seg(s, d), old, view(s, d, "review")).select("segment_id", "status", "note")


def _preview(s, d):
    old = stale.stale_segments(view(s, d, "usage"), view(s, d, "sense"))
    return stale.cost_preview(old, view(s, d, "review"), 300, 0.000056)


def _transition(s, d):
    commands = _seg(s, d).select((F.col("segment_id") * 2 - F.col("segment_id") % 2).alias("segment_id"), F.when(F.col("segment_id") % 3 == 0, "translated").otherwise("needs_human").alias("to"))
    return mutate.transition(_seg(s, d), commands, "segment_id", {"translated": ["needs_human"], "needs_human": ["translated"]}, view(s, d, "review")).groupBy("reason").agg(F.count("*").alias("n"))


def _guesses(s, d):
    old = view(s, d, "usage").select("segment_id", "sense_id", "status").distinct()
    fresh = _seg(s, d).filter("status = 'pending'").select("segment_id", (F.col("segment_id") % 2000).alias("sense_id"), F.lit("model_proposed").alias("status"))
    return mutate.replace_guesses(old, fresh, ["segment_id", "sense_id"]).groupBy("status").agg(F.count("*").alias("n"), F.sum("segment_id").alias("check"))


def _subtree(s, d):
    doomed = _seg(s, d).filter(F.col("path").startswith("r1."))
    left = mutate.delete_subtree({"usage": view(s, d, "usage"), "segment": _seg(s, d)}, doomed)
    return left["usage"].select(F.lit("usage").alias("name")).union(left["segment"].select(F.lit("segment"))).groupBy("name").agg(F.count("*").alias("n"))


def _keys(s, d):
    new = view(s, d, "sense").select("term").distinct()
    return mutate.assign_keys(view(s, d, "sense"), new, "sense_id", ["term"]).select(F.col("sense_id").cast("bigint").alias("sense_id"), "term")


def _update_from(s, d):
    first = authority.best_by_authority(view(s, d, "sense").filter("label is not null"), ["term_id"], ["version", "sense_id"], ["label"])
    return mutate.update_from(view(s, d, "sense").select("sense_id", "term_id", "label"), first, "term_id", "label")


def _duplicates(s, d):
    return mutate.duplicates(view(s, d, "sense"), ["term_id", "label"], F.col("label").isNotNull())


def _checks(s, d):
    t = view(s, d, "usage")
    return mutate.violations(t, (F.col("used") < 7) | (F.col("status") == "confirmed")).groupBy("status").agg(F.count("*").alias("n"))


def _orphans(s, d):
    return mutate.orphans(view(s, d, "comment"), view(s, d, "review"), "segment_id").select("comment_id", "segment_id")


def _sheet(s, d):
    old = view(s, d, "review").select("segment_id", F.col("reviewer").alias("note"))
    new = _seg(s, d).select("segment_id", "status", F.lit(None).cast("string").alias("note"))
    return mutate.merge_sheet(old, new, "segment_id", ["note"])


def _complete(s, d):
    out = guards.completeness(_seg(s, d), "article_path", "element_type", ["1-URGENT", "2-HIGH"], ["3-MEDIUM", "5-LOW"])
    return out.select("article_path", F.array_join("fails", ",").alias("fails"), F.array_join("warns", ",").alias("warns"))


def _extremes(s, d):
    t = _seg(s, d).groupBy("question_path", "article_path").agg(F.count("*").alias("n"))
    return t.groupBy("question_path").agg(F.min_by("article_path", F.struct("n", "article_path")).alias("short"), F.max_by("article_path", F.struct("n", "article_path")).alias("long"))


def _last_file(s, d):
    t = view(s, d, "segment_text").groupBy("segment_id", "source").agg(F.max("doc_id").alias("doc_id"))
    return t.groupBy("segment_id").agg(F.max_by("doc_id", "source").alias("doc_id"))


def _sample(s, d):
    return sample.stratified(sample.categories(_sample_base(s, d)), 100, {"formula": 0.3, "rich": 0.4, "plain": 0.3}, 7, ["r1.q1"])


def _resume(s, d):
    return flows.pending_batches(_seg(s, d).filter("status = 'pending'").select("segment_id"), view(s, d, "review"), 40).groupBy("batch").agg(F.count("*").alias("n"))


def _extrapolate(s, d):
    chars = view(s, d, "run_segment")
    done = chars.filter("run_id = 0").agg(F.sum("chars").alias("c"), F.lit(0.5).alias("usd"))
    return rollup.text_volume(view(s, d, "segment_text")).crossJoin(F.broadcast(done)).select("lang", F.round(F.col("chars") * F.col("usd") / F.col("c"), 6).alias("usd"))


def _drift(s, d):
    old = view(s, d, "sense").select("sense_id", F.when(F.col("sense_id") % 7 == 0, None).otherwise(F.col("content")).alias("snapshot"))
    now = view(s, d, "sense").select("sense_id", F.when(F.col("sense_id") % 5 == 0, F.lit("other")).otherwise(F.col("content")).alias("live"))
    return old.join(now, "sense_id").filter(~F.col("live").eqNullSafe(F.col("snapshot"))).select("sense_id", "live", "snapshot")


def _display(s, d):
    """Proposals of all usages as they are shown: the rendering that they have seen, targets of the same term or another."""
    n = F.col("segment_id")
    kind = F.get(F.array(*map(F.lit, ("rendering", "sense_here", "remove_here", "retire_sense", "add_term"))), ((n + F.col("used")) % 5).cast("int"))
    used = view(s, d, "usage").groupBy("segment_id", "used").agg(F.min("sense_id").alias("sense_id"))
    own = used.select((n * 10 + F.col("used")).alias("proposal_id"), kind.alias("kind"), F.when(kind != "add_term", F.col("sense_id")).alias("sense_id"), F.when(n % 3 == 0, F.col("sense_id") + 25).alias("target_id"), n.alias("origin"), F.when(n % 7 > 0, F.when(n % 5 == 0, "other").otherwise("red widget")).alias("snapshot"))
    radius = stale.blast_radius(view(s, d, "usage"), _seg(s, d), view(s, d, "review"), view(s, d, "sense"))
    return proposals.display(own, view(s, d, "sense"), view(s, d, "segment"), radius)


_DISPLAY = model_sql("usage", "sense", "segment", "review") + """, st AS (SELECT DISTINCT segment_id FROM usage JOIN sense USING (sense_id) WHERE usage.status <> 'rejected' AND used < version),
p AS (SELECT segment_id * 10 + used AS proposal_id, k AS kind, CASE WHEN k <> 'add_term' THEN sense_id END AS sense_id, CASE WHEN segment_id % 3 = 0 THEN sense_id + 25 END AS target_id, segment_id AS origin, CASE WHEN segment_id % 7 > 0 THEN CASE WHEN segment_id % 5 = 0 THEN 'other' ELSE 'red widget' END END AS snapshot
FROM (SELECT *, list_extract(['rendering', 'sense_here', 'remove_here', 'retire_sense', 'add_term'], CAST((segment_id + used) % 5 + 1 AS INT)) AS k FROM (SELECT segment_id, used, min(sense_id) AS sense_id FROM usage GROUP BY 1, 2) AS g) AS x),
r AS (SELECT sense_id, count(*) AS total, count(*) FILTER (WHERE status = 'translated') AS translated, count(*) FILTER (WHERE status = 'needs_human') AS needs_human, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE segment_id IN (SELECT segment_id FROM review)) AS reviewed, count(*) FILTER (WHERE segment_id NOT IN (SELECT segment_id FROM st)) AS marginal
FROM (SELECT DISTINCT sense_id, segment_id FROM usage WHERE status <> 'rejected') AS t JOIN (SELECT segment_id, status FROM segment) AS s USING (segment_id) GROUP BY 1)
SELECT p.*, s.label, CASE WHEN t.term_id = s.term_id THEN t.label END AS target_label, CASE WHEN t.term_id = s.term_id THEN t.content END AS target_content, CASE WHEN kind IN ('sense_here', 'remove_here') THEN g.path END AS locator, s.content AS live, s.sense_id IS NOT NULL AND s.content IS DISTINCT FROM p.snapshot AS drift,
""" + ", ".join(f"CASE WHEN kind IN ('rendering', 'retire_sense') THEN coalesce(r.{c}, 0) END AS {c}" for c in ("total", "translated", "needs_human", "pending", "reviewed", "marginal")) + " FROM p LEFT JOIN sense s ON s.sense_id = p.sense_id LEFT JOIN sense t ON t.sense_id = p.target_id LEFT JOIN segment g ON g.segment_id = p.origin LEFT JOIN r ON r.sense_id = p.sense_id"


_S, _U, _N = model_sql("segment"), model_sql("usage"), model_sql("sense")
_STALE = ", stale AS (SELECT DISTINCT segment_id FROM usage JOIN sense USING (sense_id) WHERE usage.status <> 'rejected' AND used < version)"
QUERIES = {
    "A03_status_counts": (lambda s, d: _seg(s, d).groupBy("status").agg(F.count("*").alias("n")), _S + " SELECT status, count(*) AS n FROM segment GROUP BY 1"),
    "A04_progress": (lambda s, d: rollup.progress(_seg(s, d), view(s, d, "review")), model_sql("segment", "review") + " SELECT count(*) AS total, count(*) FILTER (WHERE status = 'translated') AS translated, count(*) FILTER (WHERE status = 'needs_human') AS needs_human, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM review r WHERE r.segment_id = segment.segment_id)) AS reviewed FROM segment"),
    "A05_article_progress": (lambda s, d: rollup.article_progress(_seg(s, d), view(s, d, "review")), model_sql("segment", "review") + " SELECT pars, question_path, article_path, a_num, count(*) FILTER (WHERE status = 'translated') AS translated, count(*) FILTER (WHERE status = 'needs_human') AS needs_human, count(*) FILTER (WHERE status = 'pending') AS pending, count(reviewer) AS reviewed, count(*) AS total FROM segment LEFT JOIN review USING (segment_id) GROUP BY 1, 2, 3, 4"),
    "A06_questions_by_status": (lambda s, d: rollup.questions_by_status(_seg(s, d), view(s, d, "pars_order"), "pending"), model_sql("segment", "pars_order") + " SELECT pars, question_path, count(*) AS n, CAST(coalesce(max(ordinal), 9999) AS BIGINT) AS ordinal FROM segment LEFT JOIN pars_order USING (pars) WHERE status = 'pending' GROUP BY 1, 2"),
    "A07_distinct_count": (lambda s, d: view(s, d, "usage").agg(F.count_distinct("segment_id").alias("segments"), F.count_distinct("sense_id").alias("senses")), _U + " SELECT count(DISTINCT segment_id) AS segments, count(DISTINCT sense_id) AS senses FROM usage"),
    "A08_distinct_per_group": (lambda s, d: view(s, d, "usage").join(view(s, d, "sense").select("sense_id", "category"), "sense_id").groupBy("category").agg(F.count_distinct("segment_id").alias("n")), model_sql("usage", "sense") + " SELECT category, count(DISTINCT segment_id) AS n FROM usage JOIN sense USING (sense_id) GROUP BY 1"),
    "A09_having_distinct": (_having, model_sql("usage", "sense") + " SELECT term_id, count(DISTINCT segment_id) AS n FROM usage JOIN sense USING (sense_id) WHERE usage.status = 'confirmed' GROUP BY 1 HAVING count(DISTINCT segment_id) >= 300"),
    "A10_dedup_rollup": (lambda s, d: rollup.dedup_rollup(view(s, d, "usage"), view(s, d, "sense"), _seg(s, d)), model_sql("usage", "sense", "segment") + " SELECT term, label, content, count(*) AS frequency, max(confidence) AS confidence, string_agg(DISTINCT method, '|' ORDER BY method) AS methods, string_agg(DISTINCT path, '|' ORDER BY path) AS locators FROM usage JOIN sense USING (sense_id) JOIN segment USING (segment_id) WHERE usage.status <> 'rejected' GROUP BY 1, 2, 3"),
    "A11_mode_and_first": (_example, model_sql("usage", "segment") + ", u AS (SELECT sense_id, method, used, segment_id, path FROM usage JOIN segment USING (segment_id) WHERE usage.status <> 'rejected'), m AS (SELECT sense_id, method, row_number() OVER (PARTITION BY sense_id ORDER BY count(*) DESC, method) AS k FROM u GROUP BY 1, 2) SELECT u.sense_id, count(*) AS n, CAST(min(used) AS BIGINT) AS least, arg_min(segment_id, path) AS first, max(m.method) AS mode FROM u JOIN m ON m.sense_id = u.sense_id AND k = 1 GROUP BY 1"),
    "A12_run_summary": (lambda s, d: rollup.run_summary(s.range(3).withColumnRenamed("id", "run_id"), view(s, d, "run_segment")), model_sql("run_segment") + " SELECT r AS run_id, count(segment_id) AS segments, round(avg(iterations), 6) AS avg_iterations, count(*) FILTER (WHERE status = 'needs_human') AS needs_human FROM range(3) AS t(r) LEFT JOIN run_segment ON run_id = r GROUP BY 1"),
    "A13_failure_classes": (_failures, _FAILURES + " SELECT * FROM n"),
    "A14_snapshot": (_minmax, _N + " SELECT term_id, count(*) FILTER (WHERE status = 'approved') AS approved, CAST(max(version) AS BIGINT) AS latest FROM sense GROUP BY 1"),
    "A16_sample_base": (lambda s, d: _sample_base(s, d), model_sql("usage", "sense", "segment") + ", h AS (SELECT segment_id, count(*) FILTER (WHERE category = 'formula') AS formulas, count(*) FILTER (WHERE sense.status = 'approved') AS approved FROM usage JOIN sense USING (sense_id) GROUP BY 1) SELECT segment_id, pars, question_path, coalesce(formulas, 0) AS formulas, coalesce(approved, 0) AS approved FROM segment LEFT JOIN h USING (segment_id)"),
    "A17_text_volume": (lambda s, d: rollup.text_volume(view(s, d, "segment_text")), model_sql("segment_text") + " SELECT lang, CAST(sum(length(content)) AS BIGINT) AS chars FROM segment_text GROUP BY 1"),
    "A22_run_totals": (lambda s, d: view(s, d, "run_segment").groupBy("run_id").agg(F.sum("chars").alias("chars"), F.round(F.coalesce(F.try_divide(F.sum("iterations"), F.count("*")), F.lit(0.0)), 6).alias("average")), model_sql("run_segment") + " SELECT run_id, CAST(sum(chars) AS BIGINT) AS chars, round(coalesce(sum(iterations) / count(*), 0.0), 6) AS average FROM run_segment GROUP BY 1"),
    "A23_thread_state": (lambda s, d: rollup.thread_state(view(s, d, "comment")), model_sql("comment") + " SELECT segment_id, bool_and(resolved) AS resolved FROM comment GROUP BY 1"),
    "A24_nested_senses": (lambda s, d: authority.nested(view(s, d, "sense"), "term", ["sense_id", "content"], "s").select("term", F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["sense_id"], x["content"])), ";").alias("senses")), _N + " SELECT term, string_agg(sense_id || ':' || content, ';' ORDER BY sense_id) AS senses FROM sense GROUP BY 1"),
    "A25_blast_radius": (_radius, model_sql("usage", "segment", "review", "sense") + _STALE + ", t AS (SELECT DISTINCT sense_id, segment_id FROM usage WHERE status <> 'rejected') SELECT t.sense_id, count(*) AS total, count(*) FILTER (WHERE s.status = 'translated') AS translated, count(*) FILTER (WHERE s.status = 'needs_human') AS needs_human, count(*) FILTER (WHERE s.status = 'pending') AS pending, count(r.segment_id) AS reviewed, count(*) FILTER (WHERE st.segment_id IS NULL) AS marginal FROM t JOIN segment s ON s.segment_id = t.segment_id LEFT JOIN review r ON r.segment_id = t.segment_id LEFT JOIN stale st ON st.segment_id = t.segment_id GROUP BY 1"),
    "A27_pass_rates": (lambda s, d: guards.pass_rates(_seg(s, d).withColumn("ok", F.col("status") == "translated"), "element_type"), _S + " SELECT element_type, count(*) AS n, round(avg(CASE WHEN status = 'translated' THEN 1 ELSE 0 END), 6) AS rate FROM segment GROUP BY 1"),
    "A28_coverage": (lambda s, d: rollup.coverage(view(s, d, "segment"), view(s, d, "segment_text").filter("authority = 5"), "es"), model_sql("segment", "segment_text") + ", h AS (SELECT DISTINCT segment_id FROM segment_text WHERE lang = 'es' AND authority = 5) SELECT count(h.segment_id) AS \"with\", count(*) AS total FROM segment s LEFT JOIN h ON h.segment_id = s.segment_id"),
    "A28_uncovered": (lambda s, d: rollup.uncovered(view(s, d, "segment"), view(s, d, "segment_text").filter("authority = 5"), "es"), model_sql("segment", "segment_text") + " SELECT segment_id FROM segment WHERE segment_id NOT IN (SELECT segment_id FROM segment_text WHERE lang = 'es' AND authority = 5)"),
    "J07_flips": (lambda s, d: rollup.flips(view(s, d, "run_segment"), 0, 1), model_sql("run_segment") + " SELECT a.segment_id, a.status AS status_a, b.status AS status_b FROM run_segment a JOIN run_segment b ON a.segment_id = b.segment_id AND a.run_id = 0 AND b.run_id = 1 WHERE a.status <> b.status"),
    "T19_completeness": (_complete, _S + ", h AS (SELECT article_path, list(DISTINCT element_type) AS has FROM segment GROUP BY 1) SELECT article_path, array_to_string(list_sort(list_filter(['1-URGENT', '2-HIGH'], lambda k: NOT list_contains(has, k))), ',') AS fails, array_to_string(list_sort(list_filter(['3-MEDIUM', '5-LOW'], lambda k: NOT list_contains(has, k))), ',') AS warns FROM h"),
    "T20_extremes": (_extremes, _S + ", t AS (SELECT question_path, article_path, count(*) AS n FROM segment GROUP BY 1, 2) SELECT question_path, arg_min(article_path, (n, article_path)) AS short, arg_max(article_path, (n, article_path)) AS long FROM t GROUP BY 1"),
    "T21_last_file": (_last_file, model_sql("segment_text") + " SELECT segment_id, doc_id FROM (SELECT segment_id, doc_id, row_number() OVER (PARTITION BY segment_id ORDER BY source DESC, doc_id DESC) AS n FROM segment_text) AS x WHERE n = 1"),
    "T22_stratified_sample": (_sample, None),
    "T23_cost_extrapolation": (_extrapolate, model_sql("segment_text", "run_segment") + " SELECT lang, round(sum(length(content)) * 0.5 / (SELECT sum(chars) FROM run_segment WHERE run_id = 0), 6) AS usd FROM segment_text GROUP BY 1"),
    "T26_resumed_batches": (_resume, model_sql("segment", "review") + " SELECT CAST(floor((n - 1) / 40) AS BIGINT) AS batch, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY segment_id) AS n FROM segment WHERE status = 'pending' AND segment_id NOT IN (SELECT segment_id FROM review)) AS x GROUP BY 1"),
    "T28_drift": (_drift, _N + " SELECT * FROM (SELECT sense_id, CASE WHEN sense_id % 5 = 0 THEN 'other' ELSE content END AS live, CASE WHEN sense_id % 7 = 0 THEN NULL ELSE content END AS snapshot FROM sense) AS x WHERE live IS DISTINCT FROM snapshot"),
    "T28_display": (_display, _DISPLAY),
    "T29_run_deltas": (lambda s, d: rollup.compare_runs(_failures(s, d), "failure", 0, 1), _FAILURES + ", a AS (SELECT failure, n AS n_a FROM n WHERE run_id = 0), b AS (SELECT failure, n AS n_b FROM n WHERE run_id = 1) SELECT coalesce(a.failure, b.failure) AS failure, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b, coalesce(n_b, 0) - coalesce(n_a, 0) AS change, CASE WHEN coalesce(n_b, 0) > coalesce(n_a, 0) THEN '▲' WHEN coalesce(n_b, 0) < coalesce(n_a, 0) THEN '▼' ELSE '=' END AS sign FROM a FULL JOIN b ON a.failure = b.failure"),
    "T30_cost_preview": (_preview, model_sql("usage", "sense", "review") + _STALE + " SELECT count(*) AS payable, round(count(*) * CAST(0.000056 AS DOUBLE), 6) AS usd FROM (SELECT segment_id FROM stale ORDER BY segment_id LIMIT 300) AS x WHERE segment_id NOT IN (SELECT segment_id FROM review)"),
    "U01_upsert": (_upsert, model_sql("review", "comment") + ", n AS (SELECT segment_id, max(author) AS reviewer, CAST(9 AS BIGINT) AS version FROM comment GROUP BY 1) SELECT segment_id, reviewer, CAST(human_version AS BIGINT) AS version FROM review WHERE segment_id NOT IN (SELECT segment_id FROM n) UNION ALL SELECT * FROM n"),
    "U02_insert_missing": (_insert_missing, model_sql("review", "comment") + " SELECT segment_id, reviewer FROM review UNION ALL SELECT segment_id, max(author) FROM comment WHERE segment_id NOT IN (SELECT segment_id FROM review) GROUP BY 1"),
    "U03_guarded_upsert": (_guarded, _N + " SELECT sense_id, CASE WHEN sense_id % 3 = 0 AND status <> 'approved' THEN 'flagged' ELSE status END AS status FROM sense"),
    "U04_optimistic_lock": (_optimistic, _COMMANDS),
    "U05_transitions": (_transition, model_sql("segment", "review") + ", c AS (SELECT segment_id * 2 - segment_id % 2 AS id, CASE WHEN segment_id % 3 = 0 THEN 'translated' ELSE 'needs_human' END AS goal FROM segment) SELECT CASE WHEN status IS NULL THEN 'notfound' WHEN NOT ((goal = 'translated' AND status = 'needs_human') OR (goal = 'needs_human' AND status = 'translated')) THEN 'wrong_status' WHEN goal = 'needs_human' AND id IN (SELECT segment_id FROM review) THEN 'already_polished' ELSE 'ok' END AS reason, count(*) AS n FROM c LEFT JOIN segment ON segment_id = id GROUP BY 1"),
    "U06_replace_guesses": (_guesses, model_sql("usage", "segment") + ", o AS (SELECT DISTINCT segment_id, sense_id, status FROM usage WHERE status <> 'model_proposed'), f AS (SELECT segment_id, segment_id % 2000 AS sense_id, 'model_proposed' AS status FROM segment s WHERE status = 'pending' AND NOT EXISTS (SELECT 1 FROM o WHERE o.segment_id = s.segment_id AND o.sense_id = s.segment_id % 2000)) SELECT status, count(*) AS n, CAST(sum(segment_id) AS BIGINT) AS \"check\" FROM (SELECT * FROM o UNION ALL SELECT * FROM f) AS x GROUP BY 1"),
    "U07_version_bump": (_bump, _N + ", c AS (SELECT sense_id, version, content, sense_id % 4 = 0 AS hit, CASE WHEN sense_id % 8 = 0 THEN content WHEN sense_id % 12 <> 0 THEN 'new words' END AS new FROM sense) SELECT sense_id, CAST(CASE WHEN hit AND content IS DISTINCT FROM new THEN version + 1 ELSE version END AS BIGINT) AS version, CASE WHEN hit THEN new ELSE content END AS content FROM c"),
    "U10_retire": (lambda s, d: mutate.retire(view(s, d, "sense"), [4, 8, 15]).select("sense_id", "status", F.col("version").cast("bigint").alias("version")), _N + " SELECT sense_id, CASE WHEN sense_id IN (4, 8, 15) THEN 'retired' ELSE status END AS status, CAST(version + CASE WHEN sense_id IN (4, 8, 15) THEN 1 ELSE 0 END AS BIGINT) AS version FROM sense"),
    "U12_guard_and_reset": (_reset, model_sql("usage", "sense", "segment", "review") + _STALE + " SELECT s.segment_id, CASE WHEN st.segment_id IS NULL THEN status WHEN r.segment_id IS NOT NULL THEN 'needs_human' ELSE 'pending' END AS status, CASE WHEN st.segment_id IS NOT NULL AND r.segment_id IS NOT NULL THEN 'edited by a person' END AS note FROM segment s LEFT JOIN stale st ON st.segment_id = s.segment_id LEFT JOIN review r ON r.segment_id = s.segment_id"),
    "U13_delete_subtree": (_subtree, model_sql("usage", "segment") + ", g AS (SELECT segment_id FROM segment WHERE path LIKE 'r1.%') SELECT 'usage' AS name, count(*) AS n FROM usage WHERE segment_id NOT IN (SELECT segment_id FROM g) UNION ALL SELECT 'segment', count(*) FROM segment WHERE segment_id NOT IN (SELECT segment_id FROM g)"),
    "U21_update_from": (_update_from, _N + ", f AS (SELECT term_id, label FROM (SELECT term_id, label, row_number() OVER (PARTITION BY term_id ORDER BY version, sense_id) AS n FROM sense WHERE label IS NOT NULL) AS x WHERE n = 1) SELECT sense_id, term_id, coalesce(f.label, sense.label) AS label FROM sense LEFT JOIN f USING (term_id)"),
    "M02_assigned_keys": (_keys, _N + " SELECT CAST((SELECT max(sense_id) FROM sense) + row_number() OVER (ORDER BY term) AS BIGINT) AS sense_id, term FROM (SELECT DISTINCT term FROM sense) AS x"),
    "K03_sheet_merge": (_sheet, model_sql("segment", "review") + " SELECT segment_id, status, reviewer AS note FROM segment LEFT JOIN review USING (segment_id)"),
    "X01_duplicates": (_duplicates, _N + " SELECT term_id, label, count(*) AS n FROM sense WHERE label IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"),
    "X02_violations": (_checks, _U + " SELECT status, count(*) AS n FROM usage WHERE NOT (used < 7 OR status = 'confirmed') GROUP BY 1"),
    "X03_orphans": (_orphans, model_sql("comment", "review") + " SELECT comment_id, segment_id FROM comment WHERE segment_id NOT IN (SELECT segment_id FROM review)"),
}
