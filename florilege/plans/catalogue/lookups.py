"""Look-ups, single writes, proposals, links and batch state."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from florilege.operators import authority, glossary, match, mining, mutate, proposals, rollup, stale
from florilege.sources.model import model_sql, view
from florilege.sources.readers import table


def _seg(s, d):
    return view(s, d, "segment")


def _validate(s, d):
    """Proposals of all usages: kinds by number, other senses of the term or of another, texts that are and aren't new."""
    n = F.col("segment_id")
    first = view(s, d, "sense").groupBy("term_id").agg(F.min("sense_id").alias("first"))
    own = view(s, d, "usage").join(view(s, d, "sense").select("sense_id", "term_id", F.col("content").alias("now")).join(first, "term_id"), "sense_id")
    kind = F.get(F.array(*map(F.lit, ("rendering", "sense_here", "remove_here", "retire_sense"))), ((n + F.col("used")) % 4).cast("int"))
    p = own.select(
        (n * 10 + F.col("used")).alias("proposal_id"), kind.alias("kind"), F.when(n % 11 == 0, F.col("sense_id") + 1000000000).otherwise(F.col("sense_id")).alias("sense_id"),
        F.when(n % 3 == 0, F.col("first")).when(n % 3 == 1, F.col("sense_id") + 1).alias("target_id"), F.when(n % 5 == 0, "").when(n % 5 == 1, F.col("now")).when(n % 5 == 2, "new").alias("content"), "segment_id")
    return proposals.validate(p, view(s, d, "sense"), proposals.locked_terms(view(s, d, "usage"), view(s, d, "sense"))).select("proposal_id", "reason")


_VALIDATE = model_sql("sense", "usage") + """, f AS (SELECT term_id, min(sense_id) AS first FROM sense GROUP BY 1),
p AS (SELECT segment_id * 10 + used AS proposal_id, list_extract(['rendering', 'sense_here', 'remove_here', 'retire_sense'], CAST((segment_id + used) % 4 + 1 AS INT)) AS kind, u.sense_id + CASE WHEN segment_id % 11 = 0 THEN 1000000000 ELSE 0 END AS sense_id,
CASE segment_id % 3 WHEN 0 THEN first WHEN 1 THEN u.sense_id + 1 END AS target_id, CASE segment_id % 5 WHEN 0 THEN '' WHEN 1 THEN n.content WHEN 2 THEN 'new' END AS content, segment_id FROM usage u JOIN sense n USING (sense_id) JOIN f USING (term_id)),
k AS (SELECT DISTINCT segment_id, sense_id FROM usage u JOIN (SELECT sense_id FROM sense WHERE status = 'approved' AND content IS NOT NULL) AS a USING (sense_id) WHERE status <> 'rejected')
SELECT proposal_id, CASE WHEN s.sense_id IS NULL THEN 'not_found' WHEN kind = 'rendering' AND coalesce(p.content, '') = '' THEN 'proposed_sk_required' WHEN kind = 'rendering' AND p.content = coalesce(s.content, '') THEN 'no_change'
WHEN kind IN ('sense_here', 'remove_here') AND k.sense_id IS NULL THEN 'not_locked_here' WHEN kind = 'sense_here' AND target_id IS NOT NULL THEN CASE WHEN target_id = p.sense_id THEN 'no_change' WHEN t.term_id IS DISTINCT FROM s.term_id THEN 'wrong_term' ELSE 'ok' END
WHEN kind = 'sense_here' THEN CASE WHEN coalesce(p.content, '') = '' THEN 'missing_target' WHEN p.content = coalesce(s.content, '') THEN 'no_change' ELSE 'ok' END ELSE 'ok' END AS reason
FROM p LEFT JOIN sense s ON s.sense_id = p.sense_id LEFT JOIN sense t ON t.sense_id = target_id LEFT JOIN k ON k.segment_id = p.segment_id AND k.sense_id = p.sense_id"""


def _cues(s, d):
    """Cues of all senses: what their content says, and pieces of all benchmark texts; a document is a candidate of two terms."""
    n = F.col("segment_id")
    candidates = _texts(s, d).select("segment_id", F.explode(F.array((1 + n % 25).cast("int"), (1 + (n + 7) % 25).cast("int"))).alias("term_id"))
    own = view(s, d, "sense").select("term_id", "sense_id", F.col("content").alias("cue"))
    items = table(s, d, "benchmark").select((1 + F.col("item_id") % 25).cast("int").alias("term_id"), (F.col("item_id") + 10**9).alias("sense_id"), F.explode(F.array(F.upper(F.substring("text", 5, 12)), F.substring("text", 1, 9), F.substring("text", 3, 2))).alias("cue"))
    return match.cue_signals(candidates, own.union(items), _texts(s, d), 30).select("segment_id", F.col("sense_id").cast("bigint").alias("sense_id"))


_CUES = model_sql("sense") + """, c AS (SELECT term_id, sense_id, lower(content) AS cue FROM sense UNION SELECT CAST(1 + item_id % 25 AS INT), item_id + 1000000000, lower(unnest([substr(text, 5, 12), substr(text, 1, 9), substr(text, 3, 2)])) FROM benchmark),
k AS (SELECT doc_id, CAST(1 + doc_id % 25 AS INT) AS term_id FROM documents UNION SELECT doc_id, CAST(1 + (doc_id + 7) % 25 AS INT) FROM documents)
SELECT DISTINCT doc_id AS segment_id, CAST(sense_id AS BIGINT) AS sense_id FROM k JOIN c USING (term_id) JOIN documents USING (doc_id) WHERE cue <> '' AND contains(lower(text), cue)"""


def _texts(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("segment_id"), F.col("text").alias("content"))


def _replies(s, d):
    t = _seg(s, d).withColumn("kind", F.when(F.col("element_type") == "1-URGENT", "arg").when(F.col("element_type") == "2-HIGH", "reply")).filter("kind is not null")
    w = Window.partitionBy("article_path", "kind").orderBy("segment_id")
    t = t.select("segment_id", "article_path", "kind", (F.row_number().over(w) - F.when(F.col("kind") == "reply", 1).otherwise(0)).alias("number"))
    return match.link_replies(t, "article_path", "kind", "number", "segment_id").select("segment_id", "reply_to")


def _overlay(s, d):
    elements = view(s, d, "review").select((F.col("segment_id") * 50).alias("segment_id"), "reviewer")
    found, missing = match.overlay(elements, _seg(s, d), "segment_id")
    return found.select("segment_id", F.lit("found").alias("state")).union(missing.select("segment_id", F.lit("missing")))


def _contexts(s, d):
    members = mining.lemma_sets(_texts(s, d), "segment_id", "content", 5).withColumn("term_id", F.lit(1))
    return mining.sample_contexts(members).groupBy("lemma").agg(F.array_join(F.transform(F.array_sort(F.collect_list("segment_id")), lambda x: x.cast("string")), ",").alias("ids"))


def _proposed(s, d):
    new = view(s, d, "sense").select(F.col("sense_id").alias("position"), F.upper("content").alias("label"))
    known = view(s, d, "sense").filter("term_id = 3").select(F.col("content").alias("label"))
    return mining.drop_known(new, known, ["label"]).select("position", "label")


def _constraints(s, d):
    t = view(s, d, "usage").filter("status = 'confirmed'").join(view(s, d, "sense").select("sense_id", "label", "content", "term"), "sense_id")
    return proposals.constraints_block(t.select(F.col("content").alias("required"), "label", F.col("term").alias("surface")))


def _repoint(s, d):
    """Usages of retired senses move to the first sense of the term that isn't."""
    n, u = view(s, d, "sense"), view(s, d, "usage")
    goal = n.filter("status <> 'retired'").groupBy("term_id").agg(F.min("sense_id").alias("target_id"))
    old = n.filter("status = 'retired'").select("sense_id", "term_id").join(goal, "term_id").drop("term_id")
    moves = u.filter("status <> 'rejected'").select("segment_id", "sense_id").distinct().join(old, "sense_id")
    use, senses = glossary.repoint(u, n, moves)
    return use.select(F.lit("usage").alias("what"), "sense_id", "status", F.col("used").cast("bigint").alias("n")).union(senses.select(F.lit("sense"), "sense_id", "status", F.col("version").cast("bigint")))


def _tombstones(s, d):
    out = mutate.update_where(view(s, d, "usage"), (F.col("used") == 4) & (F.col("method") == "R"), {"status": F.lit("rejected")})
    return out.groupBy("status").agg(F.count("*").alias("n"))


def _threads(s, d):
    c = mutate.update_where(view(s, d, "comment"), F.col("segment_id") == 7, {"resolved": F.lit(True)})
    return mutate.delete_where(c, (F.col("author") == "u1") & (F.col("segment_id") == 9)).select("comment_id", "resolved")


def _snapshots(s, d):
    return _texts(s, d).groupBy((F.col("segment_id") % 100).alias("segment_id")).agg(F.sum(F.length("content")).alias("chars"))


def _lookup(s, d):
    t = view(s, d, "sense")
    best = authority.best_by_authority(t.filter("status = 'approved'"), ["term_id"], ["version", "sense_id"], ["sense_id", "content"])
    return best.join(t.groupBy("term_id").agg(F.count_if(F.col("label").isNull()).alias("primary")), "term_id")


def _usage_lists(s, d):
    t = view(s, d, "usage").filter("status <> 'rejected'").select("sense_id", "segment_id").distinct()
    return t.groupBy("sense_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("segment_id")), lambda x: x.cast("string")), ",").alias("segments"))


def _editors(s, d):
    editors = s.createDataFrame([("u1", True), ("u2", None)], "reviewer string, admin boolean")
    return view(s, d, "review").select("reviewer").distinct().join(editors, "reviewer", "left").select("reviewer", F.coalesce("admin", F.lit(False)).alias("admin"))


def _open_runs(s, d):
    runs = s.range(4).select(F.col("id").alias("run_id"), F.when(F.col("id") < 2, "done").alias("finished"))
    closed = mutate.update_where(runs, (F.col("run_id") == 2) & F.col("finished").isNull(), {"finished": F.lit("late")})
    return closed.join(rollup.run_summary(closed.select("run_id"), view(s, d, "run_segment")), "run_id").select("run_id", "finished", "segments", F.col("finished").isNull().alias("crashed"))


_S, _U, _N, _C = model_sql("segment"), model_sql("usage"), model_sql("sense"), model_sql("comment")
QUERIES = {
    "G10_proposal_reasons": (_validate, _VALIDATE),
    "J08_reply_links": (_replies, _S + ", t AS (SELECT segment_id, article_path, CASE element_type WHEN '1-URGENT' THEN 'arg' ELSE 'reply' END AS kind FROM segment WHERE element_type IN ('1-URGENT', '2-HIGH')), n AS (SELECT *, row_number() OVER (PARTITION BY article_path, kind ORDER BY segment_id) - CASE kind WHEN 'reply' THEN 1 ELSE 0 END AS number FROM t) SELECT r.segment_id, a.segment_id AS reply_to FROM n r LEFT JOIN n a ON a.article_path = r.article_path AND a.number = r.number AND a.kind = 'arg' AND a.number <> 0 WHERE r.kind = 'reply'"),
    "J13_overlay": (_overlay, model_sql("review", "segment") + " SELECT r.segment_id * 50 AS segment_id, CASE WHEN s.segment_id IS NULL THEN 'missing' ELSE 'found' END AS state FROM review r LEFT JOIN segment s ON s.segment_id = r.segment_id * 50"),
    "J17_cue_signals": (_cues, _CUES),
    "T12_contexts": (_contexts, r"WITH t AS (SELECT DISTINCT doc_id, w AS lemma FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents) AS x WHERE length(w) >= 5), n AS (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY doc_id) AS k FROM t) SELECT lemma, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids FROM n WHERE k <= 3 GROUP BY 1"),
    "T14_new_labels": (_proposed, _N + " SELECT min(sense_id) AS position, upper(content) AS label FROM sense WHERE lower(content) NOT IN (SELECT lower(content) FROM sense WHERE term_id = 3) GROUP BY upper(content)"),
    "A26_constraint_block": (_constraints, model_sql("usage", "sense") + " SELECT content AS required, label, string_agg(DISTINCT term, ', ' ORDER BY term) AS surfaces FROM usage JOIN sense USING (sense_id) WHERE usage.status = 'confirmed' GROUP BY 1, 2"),
    "A18_text_lengths": (_snapshots, "SELECT doc_id % 100 AS segment_id, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1"),
    "U08_repointed": (_repoint, model_sql("usage", "sense") + """, t AS (SELECT term_id, min(sense_id) AS goal FROM sense WHERE status <> 'retired' GROUP BY 1), o AS (SELECT sense_id, goal FROM sense JOIN t USING (term_id) WHERE status = 'retired'),
m AS (SELECT DISTINCT segment_id, sense_id, goal FROM usage JOIN o USING (sense_id) WHERE status <> 'rejected') SELECT 'usage' AS what, coalesce(goal, u.sense_id) AS sense_id, CASE WHEN goal IS NOT NULL THEN 'confirmed' ELSE u.status END AS status, CAST(coalesce(n.version, used) AS BIGINT) AS n
FROM usage u LEFT JOIN m ON m.segment_id = u.segment_id AND m.sense_id = u.sense_id LEFT JOIN sense n ON n.sense_id = goal UNION ALL SELECT 'sense', sense_id, CASE WHEN status = 'proposed' AND sense_id IN (SELECT goal FROM m) THEN 'approved' ELSE status END, CAST(version AS BIGINT) FROM sense"""),
    "U09_tombstones": (_tombstones, _U + " SELECT CASE WHEN used = 4 AND method = 'R' THEN 'rejected' ELSE status END AS status, count(*) AS n FROM usage GROUP BY 1"),
    "U14_delete_using": (lambda s, d: mutate.delete_using(view(s, d, "usage"), view(s, d, "review"), ["segment_id"]).groupBy("method").agg(F.count("*").alias("n")), model_sql("usage", "review") + " SELECT method, count(*) AS n FROM usage WHERE segment_id NOT IN (SELECT segment_id FROM review) GROUP BY 1"),
    "U18_threads": (_threads, _C + " SELECT comment_id, resolved OR segment_id = 7 AS resolved FROM comment WHERE NOT (author = 'u1' AND segment_id = 9)"),
    "U20_runs": (_open_runs, model_sql("run_segment") + ", r AS (SELECT n AS run_id, CASE WHEN n < 2 THEN 'done' WHEN n = 2 THEN 'late' END AS finished FROM range(4) AS t(n)) SELECT r.run_id, finished, count(segment_id) AS segments, finished IS NULL AS crashed FROM r LEFT JOIN run_segment g ON g.run_id = r.run_id GROUP BY 1, 2"),
    "Q08_winning_sense": (_lookup, _N + ", w AS (SELECT term_id, sense_id, content, row_number() OVER (PARTITION BY term_id ORDER BY version, sense_id) AS n FROM sense WHERE status = 'approved') SELECT w.term_id, sense_id, content, (SELECT count(*) FROM sense s WHERE s.term_id = w.term_id AND label IS NULL) AS \"primary\" FROM w WHERE n = 1"),
    "Q16_usage_lists": (_usage_lists, _U + " SELECT sense_id, string_agg(DISTINCT CAST(segment_id AS VARCHAR), ',' ORDER BY segment_id) AS segments FROM (SELECT DISTINCT sense_id, segment_id FROM usage WHERE status <> 'rejected') AS x GROUP BY 1".replace("DISTINCT CAST(segment_id", "CAST(segment_id")),
    "Q19_editors": (_editors, model_sql("review") + " SELECT DISTINCT reviewer, reviewer = 'u1' AS admin FROM review"),
    "Q14_edited": (lambda s, d: stale.stale_segments(view(s, d, "usage"), view(s, d, "sense")).join(view(s, d, "review"), "segment_id", "left_semi"), model_sql("usage", "sense", "review") + " SELECT DISTINCT segment_id FROM usage JOIN sense USING (sense_id) WHERE usage.status <> 'rejected' AND used < version AND segment_id IN (SELECT segment_id FROM review)"),
}
