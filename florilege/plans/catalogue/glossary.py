"""Look-ups, glossary writes, acceptance of sources, terms in texts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from florilege.functions import text as tx
from florilege.functions.paths import labels
from florilege.operators import acceptance, glossary, imports, lookups, mutate, stale, terms
from florilege.plans import flows
from florilege.sources.model import model_sql, view
from florilege.sources.readers import preferred_source, table
from florilege.store import TableSet, shared_folder, table_once


def _v(*names):
    """A query over views, by name."""
    return lambda f: lambda s, d: f(*(view(s, d, n) for n in names))


def _sha(c):
    return F.md5(F.col(c).cast("binary")).alias(c)


def _notes(s, d):
    said = F.array_join(F.transform(F.sequence(F.lit(1), F.col("iterations")), lambda i: F.format_string('{"iteration": %d, "feedback": "f%d"}', i, i * 2)), ", ")
    notes = F.when(F.col("segment_id") % 3 == 0, "none").otherwise(F.concat(F.lit('{"iterations": ['), said, F.lit("]}")))
    return lookups.review_notes(view(s, d, "run_segment").withColumn("notes", notes), "notes").select("segment_id", F.col("iteration").cast("bigint").alias("iteration"), "feedback")


def _proposals(s, d):
    """Proposals made of usages: kind, target and text by their numbers, the state by the usage's."""
    n, first = F.col("segment_id"), view(s, d, "sense").groupBy("term_id").agg(F.min("sense_id").alias("first"))
    used = view(s, d, "usage").groupBy("segment_id", "used").agg(F.min("sense_id").alias("sense_id"), F.min("status").alias("status"))
    own = used.join(view(s, d, "sense").select("sense_id", "term_id").join(first, "term_id"), "sense_id")
    kind = F.get(F.array(*map(F.lit, _KINDS)), ((n + F.col("used")) % 5).cast("int"))
    status = F.when(F.col("status") == "model_proposed", "pending").when(F.col("status") == "confirmed", "approved").otherwise("rejected")
    return own.select(
        (n * 10 + F.col("used")).alias("proposal_id"), kind.alias("kind"), F.concat(F.lit("u"), (n % 7).cast("string")).alias("proposed_by"), F.when(kind != "add_term", F.col("sense_id")).alias("sense_id"),
        F.when(n % 3 == 0, F.col("first")).when(n % 3 == 1, F.col("sense_id") + 1).alias("target_id"), F.when(n % 7 == 0, n + 1).otherwise(n).alias("origin"),
        F.concat(F.when(n % 2 == 0, "Term").otherwise("term"), (n % 1000).cast("string")).alias("lemma"), F.when(n % 13 == 0, " ").otherwise(F.concat(F.lit("text "), (n % 11).cast("string"))).alias("content"),
        status.alias("status"), (n * 7919 % 1000).alias("decided_at"))


_KINDS = ("rendering", "sense_here", "remove_here", "retire_sense", "add_term")
_PROPOSALS = model_sql("sense", "usage", "segment", "review") + """, f AS (SELECT term_id, min(sense_id) AS first FROM sense GROUP BY 1),
p0 AS (SELECT u.*, term_id, first, list_extract(['rendering', 'sense_here', 'remove_here', 'retire_sense', 'add_term'], CAST((segment_id + used) % 5 + 1 AS INT)) AS kind FROM (SELECT segment_id, used, min(sense_id) AS sense_id, min(status) AS status FROM usage GROUP BY 1, 2) AS u JOIN (SELECT sense_id, term_id FROM sense) AS n USING (sense_id) JOIN f USING (term_id)),
p AS (SELECT segment_id * 10 + used AS proposal_id, kind, 'u' || segment_id % 7 AS proposed_by, CASE WHEN kind <> 'add_term' THEN sense_id END AS sense_id, CASE segment_id % 3 WHEN 0 THEN first WHEN 1 THEN sense_id + 1 END AS target_id,
CASE WHEN segment_id % 7 = 0 THEN segment_id + 1 ELSE segment_id END AS origin, CASE WHEN segment_id % 2 = 0 THEN 'Term' ELSE 'term' END || segment_id % 1000 AS lemma, CASE WHEN segment_id % 13 = 0 THEN ' ' ELSE 'text ' || segment_id % 11 END AS content,
CASE status WHEN 'model_proposed' THEN 'pending' WHEN 'confirmed' THEN 'approved' ELSE 'rejected' END AS status, segment_id * 7919 % 1000 AS decided_at FROM p0)"""
_APPROVED = _PROPOSALS + """, c AS (SELECT proposal_id + CASE WHEN proposal_id % 10 = 7 THEN 100000000000 ELSE 0 END AS proposal_id, CASE proposal_id % 4 WHEN 0 THEN ' edited ' WHEN 1 THEN '  ' END AS edited FROM p),
us AS (SELECT DISTINCT segment_id, sense_id FROM usage),
j AS (SELECT c.proposal_id, edited, kind, p.sense_id, target_id, origin, lemma, coalesce(trim(edited), p.content) AS content, p.status, s.term_id, t.term_id AS target_term, t.status AS target_status, us.segment_id IS NOT NULL AS is_used
FROM c LEFT JOIN p USING (proposal_id) LEFT JOIN sense s ON s.sense_id = p.sense_id LEFT JOIN sense t ON t.sense_id = target_id LEFT JOIN us ON us.segment_id = origin AND us.sense_id = p.sense_id),
o0 AS (SELECT *, CASE WHEN kind IS NULL THEN 'not_found' WHEN status <> 'pending' THEN 'not_pending' WHEN edited IS NOT NULL AND NOT (kind IN ('rendering', 'add_term') OR (kind = 'sense_here' AND target_id IS NULL)) THEN 'no_edit' WHEN trim(edited) = '' THEN 'empty_edit'
WHEN kind = 'rendering' AND trim(content) = '' THEN 'empty' WHEN kind = 'sense_here' AND target_id IS NOT NULL AND target_term IS DISTINCT FROM term_id THEN 'wrong_term' WHEN kind = 'sense_here' AND target_status = 'retired' THEN 'retired'
WHEN ((kind = 'sense_here' AND target_id IS NOT NULL) OR kind = 'remove_here') AND NOT is_used THEN 'stale' WHEN kind = 'add_term' AND lower(lemma) IN ('term1', 'term4') THEN 'term_exists' ELSE 'ok' END AS outcome FROM j),
o AS (SELECT * EXCLUDE outcome, CASE WHEN kind = 'add_term' AND outcome = 'ok' AND proposal_id > min(proposal_id) FILTER (WHERE kind = 'add_term' AND outcome = 'ok') OVER (PARTITION BY lower(lemma)) THEN 'term_exists' ELSE outcome END AS outcome FROM o0),
e AS (SELECT proposal_id, outcome, CASE WHEN outcome = 'ok' THEN CASE kind WHEN 'rendering' THEN 'change' WHEN 'sense_here' THEN CASE WHEN target_id IS NULL THEN 'acknowledge' ELSE 'repoint' END WHEN 'remove_here' THEN 'reject_usage' WHEN 'retire_sense' THEN 'retire' ELSE 'add' END END AS effect,
sense_id, target_id, origin, lemma, content, kind FROM o)"""


def _terms(s):
    return s.createDataFrame([(7, "Term1"), (9, "TERM4")], "term_id int, lemma string")


def _approvals(s, d, p=None):
    p, n = p if p is not None else table_once(_proposals(s, d)), F.col("proposal_id")
    chosen = p.select(F.when(n % 10 == 7, n + 100000000000).otherwise(n).alias("proposal_id"), F.when(n % 4 == 0, " edited ").when(n % 4 == 1, "  ").alias("edited"))
    return glossary.approvals(p, chosen, _terms(s), view(s, d, "sense"), view(s, d, "usage"))


def _applied(s, d):
    """All tables after the approvals, as sums by status; committed as one and read again."""
    p, sense = table_once(_proposals(s, d)), view(s, d, "sense").drop("term", "label", "category")
    out = glossary.applied(p, _terms(s), sense, view(s, d, "usage"), view(s, d, "segment").select("segment_id", "status"), view(s, d, "review").select("segment_id"), _approvals(s, d, p))
    tables = TableSet(s, f"{shared_folder(s)}/glossary-{uuid.uuid4().hex}")
    tables.commit(0, out)
    out = tables.read()[1]
    count = lambda name, key, status="status": out[name].groupBy(F.col(status) if status else F.lit("all").alias("status")).agg(F.count("*").alias("n"), F.sum(key).cast("bigint").alias("ids")).select(F.lit(name).alias("what"), "status", "n", "ids")
    sums = out["sense"].agg(F.count("*").alias("n"), F.sum("version").cast("bigint").alias("ids")).select(F.lit("version").alias("what"), F.lit("all").alias("status"), "n", "ids")
    stamps = out["usage"].agg(F.count("*").alias("n"), F.sum("used").cast("bigint").alias("ids")).select(F.lit("used").alias("what"), F.lit("all").alias("status"), "n", "ids")
    return count("proposal", "proposal_id").union(count("sense", "sense_id")).union(count("usage", "sense_id")).union(count("segment", "segment_id")).union(count("term", "term_id", None)).union(sums).union(stamps)


_APPLIED = _APPROVED + """, w AS (SELECT sense_id, max_by(effect, proposal_id) AS effect, max_by(content, proposal_id) AS content FROM e WHERE effect IN ('change', 'retire') GROUP BY 1),
h AS (SELECT origin AS segment_id, sense_id, max_by(effect, proposal_id) AS effect, max_by(coalesce(target_id, -1), proposal_id) AS target_id FROM e WHERE effect IN ('repoint', 'reject_usage') GROUP BY 1, 2),
ad AS (SELECT row_number() OVER (ORDER BY proposal_id) AS k FROM e WHERE effect = 'add'),
s2 AS (SELECT s.sense_id, version + CASE WHEN w.effect = 'retire' OR (w.effect = 'change' AND w.content IS DISTINCT FROM s.content) THEN 1 ELSE 0 END AS version,
CASE WHEN w.effect = 'retire' THEN 'retired' WHEN status = 'proposed' AND s.sense_id IN (SELECT target_id FROM h WHERE effect = 'repoint') THEN 'approved' ELSE status END AS status FROM sense s LEFT JOIN w USING (sense_id)
UNION ALL SELECT (SELECT max(sense_id) FROM sense) + k, 1, 'approved' FROM ad),
u2 AS (SELECT u.segment_id, CASE h.effect WHEN 'reject_usage' THEN 'rejected' WHEN 'repoint' THEN 'confirmed' ELSE u.status END AS status, CASE WHEN h.effect = 'repoint' THEN h.target_id ELSE u.sense_id END AS sense_id, CASE WHEN h.effect = 'repoint' THEN t.version ELSE used END AS used
FROM usage u LEFT JOIN h ON h.segment_id = u.segment_id AND h.sense_id = u.sense_id LEFT JOIN sense t ON t.sense_id = h.target_id),
k AS (SELECT DISTINCT sense_id FROM e WHERE outcome = 'ok' AND kind IN ('rendering', 'retire_sense')),
p2 AS (SELECT p.proposal_id, CASE WHEN e.outcome = 'ok' THEN 'approved' WHEN k.sense_id IS NOT NULL AND p.status = 'pending' AND p.kind IN ('rendering', 'retire_sense') THEN 'superseded' ELSE p.status END AS status FROM p LEFT JOIN e USING (proposal_id) LEFT JOIN k ON k.sense_id = p.sense_id),
g2 AS (SELECT segment_id, CASE WHEN segment_id NOT IN (SELECT segment_id FROM h) THEN status WHEN segment_id IN (SELECT segment_id FROM review) THEN 'needs_human' ELSE 'pending' END AS status FROM segment)
SELECT 'proposal' AS what, status, count(*) AS n, CAST(sum(proposal_id) AS BIGINT) AS ids FROM p2 GROUP BY 2 UNION ALL SELECT 'sense', status, count(*), CAST(sum(sense_id) AS BIGINT) FROM s2 GROUP BY 2
UNION ALL SELECT 'usage', status, count(*), CAST(sum(sense_id) AS BIGINT) FROM u2 GROUP BY 2 UNION ALL SELECT 'segment', status, count(*), CAST(sum(segment_id) AS BIGINT) FROM g2 GROUP BY 2
UNION ALL SELECT 'term', 'all', count(*), CAST(sum(x) AS BIGINT) FROM (SELECT 7 AS x UNION ALL SELECT 9 UNION ALL SELECT 9 + k FROM ad) AS t
UNION ALL SELECT 'version', 'all', count(*), CAST(sum(version) AS BIGINT) FROM s2 UNION ALL SELECT 'used', 'all', count(*), CAST(sum(used) AS BIGINT) FROM u2"""


def _reopened(s, d):
    p = _proposals(s, d).drop("decided_at")
    out, _ = glossary.reopen(p, p.filter("proposal_id % 2 = 0"), view(s, d, "sense"), view(s, d, "segment"))
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("proposal_id", "sense_id", "target_id", "origin")})


_REOPENED = _PROPOSALS + """, r AS (SELECT *, CASE WHEN kind = 'add_term' THEN lower(lemma) ELSE CAST(sense_id AS VARCHAR) END AS x FROM p),
a AS (SELECT kind, proposed_by, x, origin, min(proposal_id) AS of, max(proposal_id) AS source FROM r WHERE proposal_id % 2 = 0 AND status = 'rejected' AND origin IN (SELECT segment_id FROM segment) GROUP BY 1, 2, 3, 4),
o AS (SELECT r.proposal_id, a.source, a.of FROM a LEFT JOIN r ON r.status = 'pending' AND r.kind = a.kind AND r.proposed_by = a.proposed_by AND r.x = a.x AND r.origin = a.origin),
n AS (SELECT (SELECT max(proposal_id) FROM p) + row_number() OVER (ORDER BY of) AS proposal_id, source FROM o WHERE proposal_id IS NULL)
SELECT p.proposal_id, p.kind, p.proposed_by, p.sense_id, CASE WHEN o.source IS NULL THEN p.target_id ELSE q.target_id END AS target_id, p.origin, p.lemma, coalesce(q.content, p.content) AS content, p.status FROM p LEFT JOIN o ON o.proposal_id = p.proposal_id LEFT JOIN p q ON q.proposal_id = o.source
UNION ALL SELECT n.proposal_id, kind, proposed_by, sense_id, target_id, origin, lemma, content, 'pending' FROM n JOIN p ON p.proposal_id = source"""


def _sheet(s, d):
    """A sheet of two kinds of rows: for each sense one that names a sense, or one of a new term."""
    n = F.col("sense_id")
    own = view(s, d, "sense").filter(n % 5 < 3).select(
        (n * 10).alias("place"), (n * 2).alias("sense_id"), F.when(n % 5 > 0, 3).alias("version"), F.lit("ignored").alias("lemma"), F.lit(None).cast("string").alias("surface"), F.when(n % 3 > 0, F.concat(F.lit(" l"), (n % 3).cast("string"))).alias("label"),
        F.when(n % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("c"), (n % 3).cast("string"))).alias("content"), F.lit("term").alias("category"))
    new = view(s, d, "sense").filter(n % 5 >= 3).select(
        (n * 10 + 1).alias("place"), F.lit(None).cast("bigint").alias("sense_id"), F.lit(None).cast("int").alias("version"), F.when(n % 11 == 0, " ").otherwise(F.concat(F.when(n % 2 == 0, "NEW ").otherwise("New "), (n % 70).cast("string"))).alias("lemma"),
        F.lit("s").alias("surface"), F.when(n % 3 > 0, F.concat(F.lit("l"), (n % 3).cast("string"))).alias("label"), F.when(n % 7 == 0, "").otherwise(F.concat(F.lit("c"), (n % 2).cast("string"))).alias("content"), F.lit("term").alias("category"))
    terms_ = view(s, d, "sense").select("term_id", F.col("term").alias("lemma")).distinct().withColumns({"category": F.lit(None).cast("string"), "surface": F.lit(None).cast("string")})
    return imports.import_approvals(own.union(new), terms_, view(s, d, "sense"))


_SHEET = model_sql("sense") + """, a AS (SELECT sense_id * 10 AS place, sense_id * 2 AS id, CASE WHEN sense_id % 5 > 0 THEN 3 END AS v, CASE WHEN sense_id % 3 > 0 THEN 'l' || sense_id % 3 END AS l, CASE WHEN sense_id % 4 > 0 THEN 'c' || sense_id % 3 END AS c FROM sense WHERE sense_id % 5 < 3),
ao AS (SELECT a.*, n.*, CASE WHEN n.sense_id IS NULL THEN 'NOT_FOUND' WHEN v IS NULL THEN 'CONFLICT' WHEN status = 'approved' AND (c IS NULL OR c = content) THEN 'ALREADY_CONFIRMED' ELSE 'OK' END AS outcome FROM a LEFT JOIN sense n ON n.sense_id = id),
b AS (SELECT sense_id * 10 + 1 AS place, CASE WHEN sense_id % 11 <> 0 THEN 'new ' || sense_id % 70 END AS k, CASE WHEN sense_id % 3 > 0 THEN 'l' || sense_id % 3 END AS l, CASE WHEN sense_id % 7 <> 0 THEN 'c' || sense_id % 2 END AS c FROM sense WHERE sense_id % 5 >= 3),
bo AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY place) AS of_k, row_number() OVER (PARTITION BY k, l ORDER BY place) AS of_l, lag(c IGNORE NULLS) OVER (PARTITION BY k, l ORDER BY place) AS was FROM b),
bb AS (SELECT *, CASE WHEN k IS NULL THEN 'NO_LEMMA' WHEN of_k = 1 THEN 'CREATED' WHEN of_l = 1 THEN 'SENSE_ADDED' ELSE 'UPDATED' END AS outcome, k IS NOT NULL AND of_l > 1 AND c IS NOT NULL AND c IS DISTINCT FROM was AS bumped FROM bo)"""
_IMPORTED = _SHEET + """, t AS (SELECT k, (SELECT max(term_id) FROM sense) + row_number() OVER (ORDER BY place) AS term_id FROM bb WHERE outcome = 'CREATED'),
g AS (SELECT k, l, min(place) AS place, 1 + count(*) FILTER (WHERE bumped) AS version, max_by(c, place) AS content FROM bb WHERE k IS NOT NULL GROUP BY 1, 2)
SELECT n.sense_id, n.term_id, CASE WHEN o.outcome IN ('OK', 'ALREADY_CONFIRMED') THEN o.l ELSE n.label END AS label, CASE WHEN o.outcome = 'OK' THEN 'approved' ELSE n.status END AS status, n.version + CASE WHEN o.outcome = 'OK' THEN 1 ELSE 0 END AS version, CASE WHEN o.outcome = 'OK' THEN coalesce(o.c, '') ELSE n.content END AS content
FROM sense n LEFT JOIN ao o ON o.id = n.sense_id UNION ALL SELECT (SELECT max(sense_id) FROM sense) + row_number() OVER (ORDER BY place), term_id, l, 'approved', version, content FROM g JOIN t USING (k)"""


def _imported(s, d):
    return _sheet(s, d)["sense"].select(*(F.col(c).cast("bigint").alias(c) for c in ("sense_id", "term_id", "version")), "label", "status", "content")


def _entries(s, d):
    own = view(s, d, "sense").select(F.when(F.col("sense_id") % 3 == 0, F.concat("term", F.lit(" x"))).otherwise(F.col("term")).alias("lemma"), F.col("content"), F.col("label")).distinct()
    return own.groupBy("lemma", "content").agg(F.min("label").alias("label")).withColumn("position", F.col("content"))


def _replaced(s, d):
    out = glossary.replace_glossary(_entries(s, d))
    own = out["rendering"].withColumnRenamed("lemma", "form").join(out["sense"], "sense_id").join(out["term"], "term_id")
    return own.select("term_id", "sense_id", "lang", "lemma", "form", "content", "label", "is_multiword", "status")


_REPLACED = model_sql("sense") + """, e AS (SELECT CASE WHEN sense_id % 3 = 0 THEN term || ' x' ELSE term END AS lemma, content, min(label) AS label FROM sense GROUP BY 1, 2),
t AS (SELECT lemma, row_number() OVER (ORDER BY lemma) AS term_id FROM (SELECT DISTINCT lemma FROM e) AS x), n AS (SELECT *, row_number() OVER (ORDER BY lemma, content) AS sense_id FROM e)
SELECT term_id, sense_id, lang, lemma, CASE WHEN lang = 'cs' THEN content END AS form, content, label, contains(lemma, ' ') AS is_multiword, 'approved' AS status FROM n JOIN t USING (lemma), (VALUES ('cs'), ('sk')) AS l(lang)"""


def _merged(s, d):
    n = F.when(F.col("segment_id") % 3 == 0, F.lit(None)).when(F.col("segment_id") % 3 == 1, F.lit("no object")).otherwise(F.lit('{"by":"u1","iteration":"0"}'))
    return view(s, d, "run_segment").select("run_id", "segment_id", glossary.merged_note(n, "iteration", F.col("iterations")).alias("notes"))


def _preambles(s, d):
    rows = view(s, d, "segment").select("segment_id", "path", F.when(F.col("segment_id") % 5 == 0, "preamble").otherwise("body").alias("element_type"))
    fresh = view(s, d, "segment").select(F.concat("question_path", F.lit(".preamble")).alias("path"))
    return glossary.replace_preambles(rows, fresh).select(F.col("segment_id").cast("bigint").alias("segment_id"), "path", "element_type")


def _reset(s, d):
    """Translated bodies with a usage of a flagged sense: people's go to review, others anew; who is run again, by status."""
    seg = view(s, d, "segment")
    flagged = view(s, d, "usage").join(view(s, d, "sense").filter("status = 'flagged'").select("sense_id"), "sense_id", "left_semi").select("segment_id").distinct()
    ids = lookups.translated_bodies(seg).join(flagged, "segment_id", "left_semi")
    after = stale.guard_and_reset(seg.select("segment_id", "status"), ids, view(s, d, "review").select("segment_id").distinct())
    return after.join(ids, "segment_id", "left_semi").groupBy("status").agg(F.count("*").alias("n"), F.sum("segment_id").cast("bigint").alias("ids"))


def gained_segments(s, d):
    """Segments that senses without an earlier usage have gained since a day, if translated."""
    usage, seg = view(s, d, "usage").filter("status <> 'rejected'"), view(s, d, "segment")
    before = usage.filter(F.col("made_at") < F.lit(GAINED_SINCE).cast("date"))
    return flows.gained(before.select("segment_id", "sense_id"), usage.select("segment_id", "sense_id"), view(s, d, "sense").select("sense_id", F.col("sense_id").alias("term_id")), lookups.translated_bodies(seg))


GAINED_SINCE = "1992-09-01"
GAINED = f""", ub AS (SELECT DISTINCT segment_id, sense_id FROM usage WHERE status <> 'rejected' AND made_at < DATE '{GAINED_SINCE}'), ua AS (SELECT DISTINCT segment_id, sense_id FROM usage WHERE status <> 'rejected'),
gs AS (SELECT DISTINCT sense_id AS term_id, segment_id FROM ua WHERE sense_id NOT IN (SELECT sense_id FROM ub) AND sense_id IN (SELECT sense_id FROM sense) AND segment_id IN (SELECT segment_id FROM segment WHERE status = 'translated' AND len(string_split(path, '.')) >= 4))"""


def _gained(s, d):
    seg = view(s, d, "segment")
    after = stale.guard_and_reset(seg.select("segment_id", "status"), gained_segments(s, d), view(s, d, "review").select("segment_id").distinct())
    return after.groupBy("status").agg(F.count("*").alias("n"), F.sum("segment_id").cast("bigint").alias("ids"))


_GUARDED = ", x AS (SELECT s.segment_id, CASE WHEN i.segment_id IS NULL THEN s.status WHEN r.segment_id IS NOT NULL THEN 'needs_human' ELSE 'pending' END AS status FROM segment s LEFT JOIN i ON i.segment_id = s.segment_id LEFT JOIN (SELECT DISTINCT segment_id FROM review) AS r ON r.segment_id = s.segment_id) SELECT status, count(*) AS n, CAST(sum(segment_id) AS BIGINT) AS ids FROM x"


def _links(s, d):
    pages = table(s, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    own = pages.select("page_id", F.concat(F.lit("/q/st"), "page_id", F.when(F.length("link") % 2 == 0, ".pdf").otherwise(".htm")).alias("link"))
    return acceptance.link_numbers(own, "link", "/q/st", ".pdf", strict=False).groupBy("page_id").agg(F.count("*").alias("links"), F.count("number").alias("numbered"), F.max("number").alias("number"))


def _overlay(s, d):
    seg = view(s, d, "segment")
    el = seg.select("path", "segment_id", F.col("element_type").alias("content"))
    el = el.union(seg.select("question_path", "segment_id", "status")).union(seg.select(F.concat("question_path", F.lit(".preamble")), "segment_id", "element_type"))
    asked = seg.join(view(s, d, "review").select("segment_id"), "segment_id", "left_semi").select("article_path")
    return acceptance.overlay_elements(el.toDF("path", "at", "content"), asked)


_OVERLAY = model_sql("segment", "review") + """, e AS (SELECT path, segment_id AS place, element_type AS content FROM segment UNION ALL SELECT question_path, segment_id, status FROM segment UNION ALL SELECT question_path || '.preamble', segment_id, element_type FROM segment),
l AS (SELECT path, max_by(content, place) AS content FROM e GROUP BY 1), a AS (SELECT DISTINCT article_path, question_path FROM segment WHERE segment_id IN (SELECT segment_id FROM review))
SELECT path, content FROM l WHERE path IN (SELECT question_path FROM a UNION SELECT question_path || '.preamble' FROM a) UNION ALL SELECT path, content FROM l WHERE EXISTS (SELECT 1 FROM a WHERE path = article_path OR starts_with(path, article_path || '.'))"""


def _sources(s, d):
    files = view(s, d, "segment").select("pars", "q_num", F.when(F.col("segment_id") % 4 == 0, "first").otherwise("second").alias("source"), F.when(F.col("segment_id") % 4 == 0, 1).otherwise(2).alias("rank")).filter("q_num % 5 <> 0").distinct()
    found, gaps = preferred_source(view(s, d, "segment"), files, ["pars", "q_num"], view(s, d, "segment").filter("q_num % 2 = 0").select("pars", "q_num"))
    return found.union(gaps.select("pars", "q_num", "gap"))


_SOURCES = model_sql("segment") + """, f AS (SELECT DISTINCT pars, q_num, CASE WHEN segment_id % 4 = 0 THEN 1 ELSE 2 END AS rank FROM segment WHERE q_num % 5 <> 0), b AS (SELECT pars, q_num, min(rank) AS rank FROM f GROUP BY 1, 2), w AS (SELECT DISTINCT pars, q_num FROM segment)
SELECT pars, q_num, CASE rank WHEN 1 THEN 'first' ELSE 'second' END AS source FROM b UNION ALL SELECT pars, q_num, 'none' FROM w WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.pars = w.pars AND b.q_num = w.q_num) UNION ALL SELECT pars, q_num, 'fallback' FROM b WHERE rank > 1 AND q_num % 2 = 0"""

_WORDS = r"regexp_extract_all({}, '\p{{L}}+')"


def _forms(s, d):
    """A dictionary: each benchmark word with two endings as forms."""
    words = table(s, d, "benchmark").select(F.explode(tx.ascii_tokens(F.lower("text"))).alias("lemma")).distinct().filter("length(lemma) > 3")
    return words.withColumn("form", F.explode(F.array(F.concat("lemma", F.lit("S")), F.concat(F.lit("ge"), "lemma"))))


def _term_forms(s, d):
    asked = table(s, d, "documents").select(F.explode(tx.ascii_tokens(F.col("text"))).alias("lemma")).distinct()
    return terms.forms_of(asked, _forms(s, d)).select("lemma", F.array_join("forms", ",").alias("forms"))


def _constraints(s, d):
    """For each document two terms of its number and one formula."""
    docs = table(s, d, "documents").select(F.col("doc_id").alias("segment_id"), F.col("doc_id"))
    each = F.explode(F.array(
        F.struct(F.get(F.array(*map(F.lit, _TERMS)), (F.col("doc_id") % 6).cast("int")).alias("required"), F.lit("term").alias("category")),
        F.struct(F.get(F.array(*map(F.lit, _TERMS)), ((F.col("doc_id") + 2) % 6).cast("int")).alias("required"), F.lit(None).cast("string").alias("category")),
        F.struct(F.lit("of the.").alias("required"), F.lit("formula").alias("category"))))
    return docs.select("segment_id", each.alias("c")).select("segment_id", "c.*")


_TERMS = ("thing", "other", "with that", "an", "leur", "über")


def _checked(s, d):
    texts = table(s, d, "documents").select(F.col("doc_id").alias("segment_id"), F.col("text").alias("content"))
    return terms.term_check(texts, _constraints(s, d), _forms(s, d))


_CHECKED = r"""WITH d AS (SELECT doc_id, text, list_distinct(regexp_extract_all(lower(text), '\p{L}+')) AS t FROM documents), n AS (SELECT *, list_transform(t, lambda x: regexp_replace(strip_accents(x), '[^\x00-\x7F]', '', 'g')) AS m FROM d),
v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zA-Z]+')) AS lemma FROM benchmark), k AS (SELECT lemma FROM v WHERE length(lemma) > 3),
l AS (SELECT ['thing', 'other', 'with that', 'an', 'leur', 'über'] AS l), c AS (SELECT DISTINCT doc_id, r AS required FROM (SELECT doc_id, unnest([l[doc_id % 6 + 1], l[(doc_id + 2) % 6 + 1]]) AS r FROM documents, l) AS x),
w AS (SELECT c.doc_id, required, unnest(string_split(required, ' ')) AS w FROM c),
st AS (SELECT w, lower(regexp_replace(strip_accents(w), '[^\x00-\x7F]', '', 'g')) AS b FROM (SELECT DISTINCT w FROM w) AS x),
ct AS (SELECT w, b, CASE WHEN length(b) >= 5 AND (b LIKE '%us' OR b LIKE '%en') THEN left(b, length(b) - 2) ELSE regexp_replace(b, '[aeiouy]+$', '') END AS s FROM st),
ok AS (SELECT w.doc_id, required, bool_and(list_contains(t, w.w) OR (w.w IN (SELECT lemma FROM k) AND (list_contains(t, w.w || 's') OR list_contains(t, 'ge' || w.w))) OR len(list_filter(m, lambda x: starts_with(x, CASE WHEN length(s) < 3 THEN b ELSE s END))) > 0) AS ok FROM w JOIN n USING (doc_id) JOIN ct ON ct.w = w.w GROUP BY 1, 2)
SELECT doc_id AS segment_id, required, ok FROM ok UNION ALL SELECT doc_id, 'of the.', regexp_matches(trim(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')), '\s+', ' ', 'g')), '\bof the\b') FROM documents"""


def _surfaces(s, d):
    texts = table(s, d, "documents").select(F.col("doc_id").alias("segment_id"), F.col("text").alias("content"))
    own = _constraints(s, d).withColumnRenamed("required", "lemma")
    lemmas = s.createDataFrame([("things", "thing2"), ("Thing", "thing"), ("The", "other"), ("of", "other"), ("le", "leur")], "surface string, lemma string")
    return terms.surface_constraints(own, texts, lemmas).distinct()


_SURFACES = r"""WITH l AS (SELECT ['thing', 'other', 'with that', 'an', 'leur', 'über'] AS l), c AS (SELECT DISTINCT doc_id, r AS lemma, g AS category FROM (SELECT doc_id, unnest([l[doc_id % 6 + 1], l[(doc_id + 2) % 6 + 1], 'of the.']) AS r, unnest(['term', NULL, 'formula']) AS g FROM documents, l) AS x),
k(surface, lemma) AS (VALUES ('things', 'thing'), ('Thing', 'thing'), ('The', 'other'), ('of', 'other'), ('le', 'leur')), t AS (SELECT DISTINCT doc_id, w AS surface FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS w FROM documents) AS x),
f AS (SELECT t.doc_id, t.surface, coalesce(k.lemma, t.surface) AS lemma FROM t LEFT JOIN k USING (surface)), one AS (SELECT * FROM c WHERE NOT contains(lemma, ' '))
SELECT DISTINCT one.doc_id AS segment_id, coalesce(f.surface, one.lemma) AS lemma, category FROM one LEFT JOIN f ON f.doc_id = one.doc_id AND f.lemma = one.lemma UNION ALL SELECT doc_id, lemma, category FROM c WHERE contains(lemma, ' ')"""


def _resolved(s, d):
    """Phrases, words and gaps of all documents, with the documents' own language as context."""
    docs = table(s, d, "documents")
    texts = docs.select(F.col("doc_id").alias("segment_id"), F.col("text").alias("content"), F.when(F.col("lang") == "de", F.col("text")).alias("czech"), F.when(F.col("lang") == "en", F.col("text")).alias("english"))
    phrases = s.createDataFrame([(1, "of the"), (2, "the thing"), (3, "in the"), (4, "le la")], "phrase_id long, phrase string")
    own = s.createDataFrame([(5, "the"), (6, "of"), (7, "der"), (8, "que")], "term_id long, lemma string")
    lemmas = s.createDataFrame([("The", 0, "nothing"), ("the", 0, "the"), ("of", 0, "de"), ("of", 1, "Of"), ("das", 0, "der2"), ("and", 0, "And3")], "surface string, candidate int, lemma string")
    senses = s.createDataFrame([(k * 10 + j, k, None if j == 0 else "x") for k in range(1, 9) for j in range(1 + k % 2)], "sense_id long, term_id long, label string")
    signals = docs.select(F.col("doc_id").alias("segment_id"), F.lit(51).cast("bigint").alias("sense_id"), F.when(F.col("doc_id") % 2 == 0, 20).otherwise(30).alias("rank"))
    gaps = s.createDataFrame([("with", 90, 900), ("dans", 91, 910), ("des", 92, 920)], "lemma string, term_id long, sense_id long")
    return terms.resolve_segments(texts, phrases, lemmas, own, senses, signals, gaps)


def _labels(s, d):
    sense = view(s, d, "sense")
    said = sense.select("term_id", F.col("content").alias("lemma"), "label", F.when(F.col("sense_id") % 7 > 0, "cue").otherwise("").alias("cue"))
    return terms.valid_labels(said, sense.filter("status = 'approved'").select("term_id", F.col("content").alias("lemma")), ["lemma", "label", "cue"])


def _hashes(s, d):
    parts = table(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))  # a conversation's turns
    return parts.select("conv_id", F.sha2(F.array_join(F.transform("t", lambda x: x["text"]), "").cast("binary"), 256).alias("sha256"))


_SE, _N, _U, _T = model_sql("segment"), model_sql("sense"), model_sql("usage", "sense", "segment_text"), model_sql("segment_text")
_PAGE = {"body": "<body", "article": "<article", "heading": "<h1>.+</h1>", "table": "<table"}
QUERIES = {
    "Q01_dimension_ids": (_v("segment", "pars_order")(lambda seg, o: lookups.ids_of(seg, o, "pars", "ordinal")), model_sql("segment", "pars_order") + " SELECT DISTINCT s.pars, ordinal FROM segment s LEFT JOIN pars_order o ON o.pars = s.pars"),
    "Q02_source_rank": (lambda s, d: lookups.ids_of(table(s, d, "documents"), view(s, d, "segment_text").groupBy("source").agg(F.min("authority").alias("authority")), "source", "authority", required=True), _T + " SELECT source, min(authority) AS authority FROM segment_text GROUP BY 1"),
    "Q04_winner_of_segment": (_v("segment_text")(lambda t: lookups.winners_of(7, t)), _T + " SELECT 7 AS segment_id, lang, (min(ROW(authority, doc_id, source))).doc_id AS doc_id, min_by(source, (authority, doc_id)) AS source FROM segment_text WHERE segment_id = 7 GROUP BY lang".replace("(min(ROW(authority, doc_id, source))).doc_id", "min_by(doc_id, (authority, doc_id))")),
    "Q05_sense_by_id": (_v("sense", "usage")(lambda n, u: lookups.by_ids(n, u.filter("used = 1"), "sense_id", ["version", "status", "term_id", "term", "content"])), model_sql("sense", "usage") + " SELECT sense_id, version, status, term_id, term, content FROM sense WHERE sense_id IN (SELECT sense_id FROM usage WHERE used = 1)"),
    "Q06_sense_by_label": (_v("sense")(lambda n: lookups.by_label(n.filter("sense_id % 3 = 0"), n)), _N + " SELECT DISTINCT n.term_id, n.label, n.sense_id, n.status FROM sense n JOIN (SELECT DISTINCT term_id, label FROM sense WHERE sense_id % 3 = 0) AS r ON r.term_id = n.term_id AND r.label IS NOT DISTINCT FROM n.label"),
    "Q06_senses_of_term": (_v("sense")(lambda n: n.filter("term_id = 13").select("sense_id", "label", "status")), _N + " SELECT sense_id, label, status FROM sense WHERE term_id = 13"),
    "Q07_labels": (_v("sense", "usage")(lambda n, u: lookups.by_ids(n, u.filter("status = 'confirmed'"), "sense_id", ["label"])), model_sql("sense", "usage") + " SELECT sense_id, label FROM sense WHERE sense_id IN (SELECT sense_id FROM usage WHERE status = 'confirmed')"),
    "Q09_formulas": (_v("sense")(lambda n: lookups.formulas(n, ["Brand#11", "Brand#12", "Brand#13"])), _N + " SELECT term, min_by(sense_id, (-version, sense_id)) AS sense_id, min_by(content, (-version, sense_id)) AS content FROM sense WHERE category = 'formula' AND status = 'approved' AND term IN ('Brand#11', 'Brand#12', 'Brand#13') GROUP BY term"),
    "Q10_titles": (_v("segment")(lambda seg: lookups.titles(seg).withColumn("depth", F.col("depth").cast("bigint"))), _SE + " SELECT question_path AS path, CAST(2 AS BIGINT) AS depth FROM segment UNION SELECT article_path, 3 FROM segment"),
    "Q11_at_paths": (_v("segment", "review")(lambda seg, r: lookups.at_paths(seg, seg.join(r.select("segment_id"), "segment_id", "left_semi").select("path")).select("segment_id", "path", "status")), model_sql("segment", "review") + " SELECT segment_id, path, status FROM segment WHERE path IN (SELECT path FROM segment WHERE segment_id IN (SELECT segment_id FROM review))"),
    "Q12_translated_bodies": (_v("segment")(lookups.translated_bodies), _SE + " SELECT segment_id FROM segment WHERE status = 'translated' AND len(string_split(path, '.')) >= 4"),
    "Q13_review_notes": (_notes, model_sql("run_segment") + " SELECT segment_id, i AS iteration, 'f' || i * 2 AS feedback FROM run_segment, unnest(range(1, iterations + 1)) AS t(i) WHERE status = 'needs_human' AND segment_id % 3 <> 0"),
    "Q15_text_of_source": (_v("segment_text")(lambda t: t.filter("lang = 'de' and source = 'src3'").select("doc_id", "segment_id", _sha("content"))), _T + " SELECT doc_id, segment_id, md5(content) AS content FROM segment_text WHERE lang = 'de' AND source = 'src3'"),
    "Q17_pending": (lambda s, d: lookups.in_order(_proposals(s, d), F.col("status") == "pending", ["proposal_id"]).select("place", "proposal_id", "kind"), _PROPOSALS + " SELECT row_number() OVER (ORDER BY proposal_id) AS place, proposal_id, kind FROM p WHERE status = 'pending'"),
    "Q17_approved_terms": (lambda s, d: lookups.in_order(_proposals(s, d), (F.col("status") == "approved") & (F.col("kind") == "add_term"), ["decided_at", "proposal_id"]).select("place", "proposal_id", "lemma"), _PROPOSALS + " SELECT row_number() OVER (ORDER BY decided_at, proposal_id) AS place, proposal_id, lemma FROM p WHERE status = 'approved' AND kind = 'add_term'"),
    "Q20_term_segments": (_v("usage", "sense", "segment_text")(lambda u, n, t: lookups.term_segments(u, n, t, ["en", "de"]).select("term_id", "segment_id", _sha("en"), _sha("de"))), _U + ", t AS (SELECT segment_id, max(content) FILTER (WHERE lang = 'en') AS en, max(content) FILTER (WHERE lang = 'de') AS de FROM segment_text GROUP BY 1) SELECT x.term_id, x.segment_id, md5(en) AS en, md5(de) AS de FROM (SELECT DISTINCT term_id, segment_id FROM usage JOIN sense USING (sense_id)) AS x LEFT JOIN t ON t.segment_id = x.segment_id"),
    "Q21_senses_with_renderings": (_v("sense", "usage")(lambda n, u: lookups.senses_with_renderings(n, u.select("sense_id", F.col("method").alias("lang"), F.col("status").alias("content")), ["A", "R"])), model_sql("sense", "usage") + " SELECT n.sense_id, n.label, n.status, max(u.status) FILTER (WHERE u.method = 'A') AS A, max(u.status) FILTER (WHERE u.method = 'R') AS R FROM sense n LEFT JOIN usage u ON u.sense_id = n.sense_id GROUP BY 1, 2, 3"),
    "Q22_counts": (_v("segment", "usage")(lookups.counts), model_sql("segment", "usage") + " SELECT 'body_segments' AS what, count(*) AS n FROM segment UNION ALL SELECT 'model_proposed', count(*) FROM usage WHERE status = 'model_proposed'"),
    "Q23_first_locators": (_v("usage", "segment")(lambda u, seg: lookups.first_locators(u.filter("status = 'rejected'"), seg, 20)), model_sql("usage", "segment") + " SELECT segment_id, path FROM segment WHERE segment_id IN (SELECT DISTINCT segment_id FROM usage WHERE status = 'rejected' ORDER BY 1 LIMIT 20)"),
    "Q25_status_snapshot": (_v("sense", "segment", "usage")(lambda n, seg, u: lookups.status_snapshot({"sense": n, "segment": seg, "usage": u})), model_sql("sense", "segment", "usage") + " SELECT 'sense' AS what, status, count(*) AS n FROM sense GROUP BY 2 UNION ALL SELECT 'segment', status, count(*) FROM segment GROUP BY 2 UNION ALL SELECT 'usage', status, count(*) FROM usage GROUP BY 2"),
    "M01_set_label": (_v("sense")(lambda n: mutate.update_from(n, n.filter("status = 'flagged'").groupBy("sense_id").agg(F.max(F.concat("term", F.lit("!"))).alias("label")), "sense_id", "label").select("sense_id", "label")), _N + " SELECT sense_id, CASE WHEN status = 'flagged' THEN term || '!' ELSE label END AS label FROM sense"),
    "M03_merged_notes": (_merged, model_sql("run_segment") + """ SELECT run_id, segment_id, CASE WHEN segment_id % 3 = 2 THEN '{"by":"u1","iteration":"' ELSE '{"iteration":"' END || iterations || '"}' AS notes FROM run_segment"""),
    "M04_insert_comments": (_v("comment")(lambda c: c.select("comment_id", "segment_id", "author").unionByName(mutate.assign_keys(c, c.filter("resolved").select("segment_id", F.lit("new").alias("author")).distinct(), "comment_id", ["segment_id"])).select(F.col("comment_id").cast("bigint").alias("comment_id"), F.col("segment_id").cast("bigint").alias("segment_id"), "author")), model_sql("comment") + " SELECT comment_id, segment_id, author FROM comment UNION ALL SELECT (SELECT max(comment_id) FROM comment) + row_number() OVER (ORDER BY segment_id), segment_id, 'new' FROM (SELECT DISTINCT segment_id FROM comment WHERE resolved) AS x"),
    "M05_replaced_glossary": (_replaced, _REPLACED),
    "M06_preambles": (_preambles, _SE + " SELECT segment_id, path, 'body' AS element_type FROM segment WHERE segment_id % 5 <> 0 UNION ALL SELECT (SELECT max(segment_id) FROM segment) + row_number() OVER (ORDER BY q), q, 'preamble' FROM (SELECT DISTINCT question_path || '.preamble' AS q FROM segment) AS x"),
    "M07_apply_gained": (_gained, model_sql("segment", "usage", "review", "sense") + GAINED + ", i AS (SELECT DISTINCT segment_id FROM gs)" + _GUARDED + " GROUP BY 1"),
    "T27_gained": (gained_segments, model_sql("segment", "usage", "review", "sense") + GAINED + " SELECT term_id, segment_id FROM gs"),
    "M09_reset_corpus": (_reset, model_sql("segment", "usage", "review", "sense") + ", i AS (SELECT segment_id FROM segment WHERE status = 'translated' AND segment_id IN (SELECT segment_id FROM usage WHERE sense_id IN (SELECT sense_id FROM sense WHERE status = 'flagged')))" + _GUARDED + " WHERE segment_id IN (SELECT segment_id FROM i) GROUP BY 1"),
    "U11_add_terms": (_v("sense")(lambda n: glossary.add_terms(n.groupBy("term").agg(F.min("term_id").alias("term_id")), n.select(F.when(F.col("sense_id") % 2 == 0, F.upper("term")).otherwise(F.col("content")).alias("term"))).select(F.col("term_id").cast("bigint").alias("term_id"), "term")), _N + ", t AS (SELECT term, min(term_id) AS term_id FROM sense GROUP BY 1), f AS (SELECT min(x) AS term FROM (SELECT CASE WHEN sense_id % 2 = 0 THEN upper(term) ELSE content END AS x FROM sense) AS y WHERE lower(x) NOT IN (SELECT lower(term) FROM t) GROUP BY lower(x)) SELECT CAST(term_id AS BIGINT) AS term_id, term FROM t UNION ALL SELECT (SELECT max(term_id) FROM t) + row_number() OVER (ORDER BY term), term FROM f"),
    "U16_reopened": (_reopened, _REOPENED),
    "U17_approvals": (_approvals, _APPROVED + " SELECT * FROM e"),
    "U17_applied": (_applied, _APPLIED),
    "U19_import_outcomes": (lambda s, d: _sheet(s, d)["outcome"], _SHEET + " SELECT place, outcome, outcome = 'OK' AS bumped FROM ao UNION ALL SELECT place, outcome, bumped FROM bb"),
    "U19_imported_senses": (_imported, _IMPORTED.replace("n.sense_id, n.term_id, CASE", "CAST(n.sense_id AS BIGINT) AS sense_id, CAST(n.term_id AS BIGINT) AS term_id, CASE").replace("ELSE 0 END AS version", "ELSE 0 END AS version")),
    "X04_acceptance": (lambda s, d: acceptance.checks(view(s, d, "segment").agg(F.count_distinct("article_path").alias("articles"), F.count("*").alias("segments"), F.count_distinct("pars").alias("parts")), {"articles": 10, "segments": 10**9, "parts": 5}), _SE + " SELECT c.check, c.found, c.least, c.found >= c.least AS ok FROM (SELECT unnest([{'check': 'articles', 'found': count(DISTINCT article_path), 'least': CAST(10 AS BIGINT)}, {'check': 'segments', 'found': count(*), 'least': 1000000000}, {'check': 'parts', 'found': count(DISTINCT pars), 'least': 5}]) AS c FROM segment) AS x".replace("c.check", 'c."check"')),
    "E01_articles": (_v("segment")(acceptance.articles), _SE + " SELECT article_path AS article, pars AS part, q_num AS question, a_num AS number, count(*) AS n FROM segment GROUP BY 1, 2, 3, 4"),
    "E02_overlay_elements": (_overlay, _OVERLAY),
    "E03_spot_check": (_v("segment")(lambda seg: acceptance.spot_check(seg, "article_path", "segment_id").select("article_path", "segment_id", F.col("at").cast("bigint").alias("at"))), _SE + " SELECT article_path, segment_id, place AS \"at\" FROM (SELECT *, row_number() OVER (PARTITION BY article_path ORDER BY segment_id) AS place FROM segment) AS x WHERE place <= 2"),
    "E05_file_names": (_v("segment")(lambda seg: seg.select("pars", "q_num").distinct().select("pars", "q_num", acceptance.file_name(F.col("pars"), F.col("q_num"), {f"r{k}": k + 1 for k in range(5)}).alias("file"))), _SE + " SELECT DISTINCT pars, q_num, CAST(right(pars, 1) AS INT) + 1 || lpad(CAST(q_num AS VARCHAR), 3, '0') || '.html' AS file FROM segment"),
    "E06_known_senses": (_v("sense")(lambda n: acceptance.known_senses(n, n.select(F.when(F.col("sense_id") % 2 == 0, F.col("term")).otherwise(F.concat(F.lit("no "), "term")).alias("term")))), _N + ", k AS (SELECT DISTINCT CASE WHEN sense_id % 2 = 0 THEN term ELSE 'no ' || term END AS term FROM sense), c AS (SELECT term, count(*) AS n FROM sense GROUP BY 1) SELECT k.term, CASE WHEN n IS NULL THEN 'absent' WHEN n = 1 THEN 'single' ELSE 'multi' END AS state FROM k LEFT JOIN c ON c.term = k.term"),
    "E06_summary": (_v("sense")(lambda n: acceptance.glossary_summary(n.select("term_id", F.col("term").alias("lemma")).distinct(), n.filter("status <> 'retired'"))), _N + ", t AS (SELECT DISTINCT term_id, term FROM sense), c AS (SELECT term_id, count(*) AS n FROM sense WHERE status <> 'retired' GROUP BY 1) SELECT count(*) AS terms, CAST(coalesce(sum(n), 0) AS BIGINT) AS senses, count(*) FILTER (WHERE n = 1) AS single, count(*) FILTER (WHERE n > 1) AS multi, count(*) FILTER (WHERE contains(term, ' ')) AS multiword FROM t LEFT JOIN c USING (term_id)"),
    "E07_missing_kinds": (lambda s, d: acceptance.missing_kinds(table(s, d, "pages"), "page_id", "html", "<([a-z]+[0-9]?)[ >]", ["article", "h1", "nav", "footer", "table", "aside"]).select("page_id", F.array_join("missing", ",").alias("missing")), "SELECT page_id, array_to_string(list_sort(list_filter(['article', 'h1', 'nav', 'footer', 'table', 'aside'], lambda k: NOT regexp_matches(html, '<' || k || '[ >]'))), ',') AS missing FROM pages"),
    "E08_marker_counts": (lambda s, d: acceptance.marker_counts(table(s, d, "pages"), "page_id", "html", "<p>", 10), "SELECT page_id, CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS n, len(regexp_extract_all(html, '<p>')) >= 10 AS ok FROM pages"),
    "E08_absent_files": (lambda s, d: acceptance.absent_files(table(s, d, "documents").select(F.col("doc_id").alias("page_id")), table(s, d, "pages"), "page_id"), "SELECT DISTINCT doc_id AS page_id FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages)"),
    "E09_page_identity": (lambda s, d: acceptance.page_identity(table(s, d, "pages"), "page_id", "html", _PAGE), "SELECT page_id, contains(html, '<body') AS body, contains(html, '<article') AS article, regexp_matches(html, '<h1>.+</h1>') AS heading, contains(html, '<table') AS \"table\", concat_ws(',', CASE WHEN NOT contains(html, '<body') THEN 'body' END, CASE WHEN NOT contains(html, '<article') THEN 'article' END, CASE WHEN NOT regexp_matches(html, '<h1>.+</h1>') THEN 'heading' END, CASE WHEN NOT contains(html, '<table') THEN 'table' END) AS anomalies FROM pages"),
    "E10_link_numbers": (_links, "WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages) SELECT page_id, count(*) AS links, count(*) FILTER (WHERE length(link) % 2 = 0) AS numbered, max(CASE WHEN length(link) % 2 = 0 THEN page_id END) AS number FROM l GROUP BY 1"),
    "S07_preferred_source": (_sources, _SOURCES),
    "J19_shared_records": (_v("run_segment")(lambda r: terms.shared_records(r.filter("run_id = 0"), r.filter("run_id = 1"), "segment_id", "status")), model_sql("run_segment") + " SELECT a.segment_id, a.status AS prior, b.status AS current FROM run_segment a JOIN run_segment b ON a.segment_id = b.segment_id AND a.run_id = 0 AND b.run_id = 1"),
    "T02_forms": (_term_forms, "WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zA-Z]+')) AS l FROM benchmark), k AS (SELECT l FROM v WHERE length(l) > 3), a AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS lemma FROM documents) SELECT lemma, CASE WHEN l IS NULL THEN '' ELSE array_to_string(list_sort(['ge' || l, l || 's']), ',') END AS forms FROM a LEFT JOIN k ON l = lower(lemma)"),
    "T09_resolved_segments": (_resolved, None),
    "T13_valid_labels": (_labels, _N + " SELECT term_id, content AS lemma, label, 'cue' AS cue FROM sense n WHERE label IS NOT NULL AND sense_id % 7 > 0 AND EXISTS (SELECT 1 FROM sense a WHERE a.status = 'approved' AND a.term_id = n.term_id AND a.content = n.content)"),
    "T15_surface_constraints": (_surfaces, _SURFACES),
    "T16_term_check": (_checked, _CHECKED),
    "F05_word_tokens": (lambda s, d: table(s, d, "documents").select("doc_id", F.size(tx.word_tokens(F.col("text"))).cast("bigint").alias("words")), r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}\p{M}_]+')) AS BIGINT) AS words FROM documents"),
    "F16_text_hashes": (_hashes, "SELECT conv_id, sha256(string_agg(text, '' ORDER BY turn)) AS sha256 FROM conversations GROUP BY 1"),
    "F24_last_label": (_v("segment")(lambda seg: seg.select("segment_id", F.element_at(labels(F.col("path")), -1).alias("label"))), _SE + " SELECT segment_id, list_extract(string_split(path, '.'), -1) AS label FROM segment"),
}
