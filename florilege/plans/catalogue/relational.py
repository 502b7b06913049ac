"""Views, filters, joins, windows, order and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from florilege.functions import paths
from florilege.operators import activity, authority, navigation, rollup, stale
from florilege.sources.model import model_sql, view
from florilege.sources.readers import table


def _best(s, d):
    return authority.best_by_authority(view(s, d, "segment_text"), ["segment_id", "lang"], ["authority", "doc_id"], ["doc_id", "content"])


def _pivot(s, d):
    return authority.pivot_winners(view(s, d, "segment_text"), "segment_id", "lang", ["en", "de", "fr", "es"], "content", ["authority", "doc_id"])


def _pivot_max(s, d):
    t = view(s, d, "segment_text")
    is_ = lambda lang: F.col("lang") == lang
    return authority.pivot_max(t, "segment_id", {"en": (is_("en"), "content"), "de": (is_("de"), "content"), "en_low": (is_("en") & (F.col("authority") < 5), "content")})


def _sense_view(s, d):
    t = view(s, d, "sense")
    return t.groupBy("term_id").agg(*(F.max(F.when(F.col("status") == x, F.col("content"))).alias(x) for x in ("approved", "proposed")), F.max(F.when(F.col("category") == "formula", F.col("label"))).alias("formula_label"))


def _v_segment(s, d):
    return view(s, d, "segment").join(view(s, d, "pars_order"), "pars").join(view(s, d, "review"), "segment_id").select("segment_id", "path", "ordinal", "reviewer")


def _left_text(s, d):
    return view(s, d, "segment").join(view(s, d, "segment_text").filter("lang = 'en' and authority < 3").groupBy("segment_id").agg(F.min("doc_id").alias("doc_id")), "segment_id", "left").select("segment_id", "element_type", "doc_id")


def _neighbours(s, d):
    a = view(s, d, "segment").select("q_num", "a_num", "article_path").distinct()
    return navigation.neighbours(a, ["q_num", "a_num"], "article_path").select("article_path", "previous", "next")


def _numbering(s, d):
    t = view(s, d, "segment").filter("element_type = '1-URGENT'")
    return navigation.number_within(t, "article_path", "segment_id").select("segment_id", "article_path", "number")


def _inherit(s, d):
    t = view(s, d, "segment")
    numbered = navigation.number_within(t.filter("element_type = '1-URGENT'"), "article_path", "segment_id")
    links = t.filter("element_type = '2-HIGH'").select("segment_id", (F.col("segment_id") - 1).alias("reply_to"))
    return navigation.inherit_number(links, numbered, "reply_to", "segment_id").select("segment_id", "reply_to", "number")


def _pick_order(s, d):
    w = Window.partitionBy("question_path").orderBy("price", "segment_id")
    return view(s, d, "segment").withColumn("nth", F.row_number().over(w)).orderBy((F.col("nth") > 1), "price", "segment_id").limit(40).select("segment_id", "question_path", F.col("nth").cast("bigint").alias("nth"))


def _running(s, d):
    w = Window.partitionBy("question_path").orderBy("segment_id").rowsBetween(Window.unboundedPreceding, 0)
    return view(s, d, "segment").select("segment_id", F.round(F.avg((F.col("status") == "needs_human").cast("int")).over(w), 6).alias("rate"))


def _feed(s, d):
    c = view(s, d, "comment").select(F.lit("comment").alias("kind"), "segment_id", F.col("author").alias("who"), F.col("created_at").alias("at"))
    u = view(s, d, "usage").select(F.lit("usage").alias("kind"), "segment_id", "sense_id", F.col("made_at").alias("at"))
    g = view(s, d, "segment").filter("status = 'pending'").select(F.lit("change").alias("kind"), "segment_id", F.col("changed_at").alias("at"), "price")
    rows = activity.feed(c, u, g)
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.count("who").alias("who"), F.count("sense_id").alias("senses"), F.max("at").cast("string").alias("latest"))


def _keyset(s, d):
    return navigation.page(view(s, d, "comment"), "created_at", "comment_id", 50, F.lit("2024-01-10").cast("timestamp")).select("comment_id", "segment_id", "author")


def _unread(s, d):
    return rollup.comment_badges(view(s, d, "comment"), view(s, d, "reads"), "u3")


def _digest(s, d):
    c = view(s, d, "comment")
    return activity.digests(activity.unseen(c, activity.participants(c, view(s, d, "review")), view(s, d, "reads")))


def _article_filter(s, d):
    return view(s, d, "segment").filter(paths.article_filter(F.col("path"), "r1.q1.a1") | paths.under_range(F.col("path"), "r2")).select("segment_id", "path")


def _paths(s, d):
    t = paths.with_path_columns(view(s, d, "segment").select("segment_id", "path"))
    return t.select("segment_id", F.col("nlevel").cast("bigint").alias("nlevel"), "pars", "question_path", "article_path", F.col("q_num").cast("bigint").alias("q_num"), F.col("tail_num").cast("bigint").alias("tail_num"), paths.parent(F.col("path")).alias("parent"), paths.to_locator(F.col("path")).alias("locator"))


def _prefixes(s, d):
    return view(s, d, "segment").select(paths.group_prefix(F.col("path")).alias("prefix")).distinct()


def _locators(s, d):
    return view(s, d, "segment").filter(~F.col("pars").isin("r0", "r1") & (F.coalesce(F.col("q_num"), F.lit(0)) <= 12)).select("question_path").distinct()


def _optional(s, d, types=("1-URGENT", "5-LOW"), limit=25):
    t = view(s, d, "segment").filter("status = 'translated'")
    t = t.filter(F.col("element_type").isin(*types)) if types else t
    return t.orderBy("segment_id").limit(limit).select("segment_id", "element_type")


def _report_filter(s, d):
    return view(s, d, "sense").filter("status = 'flagged' OR (category <> 'formula' AND status <> 'retired')").filter("NOT (label IS NULL AND version > 5)").select("sense_id", "status", "category", "label")


def _display(s, d):
    t = view(s, d, "segment").join(view(s, d, "review"), "segment_id", "left")
    return t.select("segment_id", F.coalesce("reviewer", F.when(F.col("status") == "translated", F.col("element_type")), F.lit("none")).alias("shown"), F.when(F.col("reviewer").isNotNull(), "human").when(F.col("status") == "translated", "model").otherwise("none").alias("origin"))


def _exists(s, d):
    reviewed = view(s, d, "segment").join(view(s, d, "review").filter("human_version = 1"), "segment_id", "left_semi")
    return reviewed.select("segment_id", "status")


def _anti(s, d):
    t = view(s, d, "segment").filter("status = 'pending'").join(view(s, d, "review"), "segment_id", "left_anti")
    return t.join(view(s, d, "usage").filter("status = 'rejected'").select("segment_id"), "segment_id", "left_anti").select("segment_id", "path")


def _installment(s, d):
    return view(s, d, "segment").orderBy("segment_id").limit(200).join(view(s, d, "review").select("segment_id"), "segment_id", "left_anti").select("segment_id")


def _null_order(s, d):
    w = Window.partitionBy("term_id").orderBy(F.col("label").asc_nulls_last(), F.col("sense_id"))
    v = Window.partitionBy("term_id").orderBy(F.col("label").desc_nulls_first(), F.col("sense_id"))
    return view(s, d, "sense").select("sense_id", F.row_number().over(w).cast("bigint").alias("up"), F.row_number().over(v).cast("bigint").alias("down"))


def _case_order(s, d):
    rank = F.when(F.col("element_type") == "2-HIGH", 0).when(F.col("element_type") == "1-URGENT", 1).otherwise(9)
    w = Window.partitionBy("article_path").orderBy(rank, F.col("segment_id"))
    return view(s, d, "segment").select("segment_id", F.row_number().over(w).cast("bigint").alias("place"))


def _union_distinct(s, d):
    return activity.participants(view(s, d, "comment"), view(s, d, "review"))


def _absent(s, d):
    return navigation.absent((1, 400), view(s, d, "usage").withColumn("sense_id", F.col("sense_id").cast("bigint")), "sense_id")


def _batches(s, d):
    return navigation.batches(view(s, d, "segment").filter("status = 'pending'").select("segment_id"), "segment_id", 50).groupBy("batch").agg(F.count("*").alias("n"), F.min("segment_id").alias("first"))


def _null_safe(s, d):
    a, b = view(s, d, "sense").select("term_id", "label", "sense_id"), view(s, d, "sense").select(F.col("term_id").alias("t"), F.col("label").alias("l"), "version")
    own = b.filter("version = 1").select("t", "l").distinct()
    return a.join(own, (F.col("term_id") == F.col("t")) & F.col("label").eqNullSafe(F.col("l")), "left_semi").select("sense_id")


def _folded(s, d):
    return view(s, d, "sense").filter(F.lower("content") == F.lower(F.lit("RED Widget"))).select("sense_id")


def _last_run(s, d):
    return view(s, d, "segment").orderBy(F.col("changed_at").desc(), F.col("segment_id").desc()).limit(1).select("segment_id")


def _stamps(s, d):
    n = table(s, d, "events").filter("event_type = 'view'").groupBy((F.col("event_id") % 200).alias("segment_id")).agg(F.max("ts").alias("read"))
    m = table(s, d, "events").filter("event_type = 'click'").groupBy((F.col("event_id") % 150).alias("segment_id")).agg(F.max("ts").alias("notified"))
    return n.join(m, "segment_id", "left").select("segment_id", F.greatest("read", "notified").cast("string").alias("mark"))


_SEG, _TXT = model_sql("segment"), model_sql("segment_text")
QUERIES = {
    "W01_best_by_authority": (_best, _TXT + " SELECT segment_id, lang, doc_id, content FROM (SELECT *, row_number() OVER (PARTITION BY segment_id, lang ORDER BY authority, doc_id) AS n FROM segment_text) AS x WHERE n = 1"),
    "J03_winners_by_language": (_pivot, _TXT + ", w AS (SELECT *, row_number() OVER (PARTITION BY segment_id, lang ORDER BY authority, doc_id) AS n FROM segment_text) SELECT segment_id, "
      + ", ".join(f"max(content) FILTER (WHERE lang = '{x}' AND n = 1) AS {x}" for x in ("en", "de", "fr", "es")) + " FROM w GROUP BY segment_id"),
    "A01_language_pivot": (_pivot_max, _TXT + " SELECT segment_id, max(content) FILTER (WHERE lang = 'en') AS en, max(content) FILTER (WHERE lang = 'de') AS de, max(content) FILTER (WHERE lang = 'en' AND authority < 5) AS en_low FROM segment_text GROUP BY segment_id"),
    "A02_sense_pivot": (_sense_view, model_sql("sense") + " SELECT term_id, max(content) FILTER (WHERE status = 'approved') AS approved, max(content) FILTER (WHERE status = 'proposed') AS proposed, max(label) FILTER (WHERE category = 'formula') AS formula_label FROM sense GROUP BY term_id"),
    "J01_segment_joins": (_v_segment, model_sql("segment", "pars_order", "review") + " SELECT segment_id, path, ordinal, reviewer FROM segment JOIN pars_order USING (pars) JOIN review USING (segment_id)"),
    "J02_left_text": (_left_text, model_sql("segment", "segment_text") + ", t AS (SELECT segment_id, min(doc_id) AS doc_id FROM segment_text WHERE lang = 'en' AND authority < 3 GROUP BY 1) SELECT segment_id, element_type, doc_id FROM segment LEFT JOIN t USING (segment_id)"),
    "J04_semi_join": (_exists, model_sql("segment", "review") + " SELECT segment_id, status FROM segment WHERE EXISTS (SELECT 1 FROM review r WHERE r.segment_id = segment.segment_id AND human_version = 1)"),
    "J05_anti_joins": (_anti, model_sql("segment", "review", "usage") + " SELECT segment_id, path FROM segment s WHERE status = 'pending' AND NOT EXISTS (SELECT 1 FROM review r WHERE r.segment_id = s.segment_id) AND NOT EXISTS (SELECT 1 FROM usage u WHERE u.segment_id = s.segment_id AND u.status = 'rejected')"),
    "J06_fresh_segments": (lambda s, d: stale.fresh_segments(view(s, d, "segment"), view(s, d, "usage"), view(s, d, "sense")).select("segment_id", "path"), model_sql("segment", "usage", "sense") + " SELECT segment_id, path FROM segment s WHERE NOT EXISTS (SELECT 1 FROM usage u JOIN sense USING (sense_id) WHERE u.segment_id = s.segment_id AND u.status <> 'rejected' AND used < version)"),
    "J09_stale_segments": (lambda s, d: stale.stale_segments(view(s, d, "usage"), view(s, d, "sense")), model_sql("usage", "sense") + " SELECT DISTINCT segment_id FROM usage JOIN sense USING (sense_id) WHERE usage.status <> 'rejected' AND used < version"),
    "J10_default_ordinal": (lambda s, d: view(s, d, "segment").join(view(s, d, "pars_order"), "pars", "left").select("segment_id", F.coalesce("ordinal", F.lit(9999)).cast("bigint").alias("ordinal")), model_sql("segment", "pars_order") + " SELECT segment_id, CAST(coalesce(ordinal, 9999) AS BIGINT) AS ordinal FROM segment LEFT JOIN pars_order USING (pars)"),
    "J11_comment_badges": (_unread, model_sql("comment", "reads") + " SELECT c.segment_id, count(*) AS total, count(*) FILTER (WHERE NOT resolved) AS open, count(*) FILTER (WHERE author <> 'u3' AND (last_read_at IS NULL OR created_at > last_read_at)) AS unread FROM comment c LEFT JOIN reads r ON r.segment_id = c.segment_id AND reader = 'u3' GROUP BY 1"),
    "T31_digests": (_digest, model_sql("comment", "review", "reads") + ", p AS (SELECT segment_id, author AS person FROM comment UNION SELECT segment_id, reviewer FROM review) SELECT person AS \"user\", c.segment_id, count(*) AS n, string_agg(CAST(comment_id AS VARCHAR), ',' ORDER BY created_at, comment_id) AS comment_ids FROM comment c JOIN p ON p.segment_id = c.segment_id AND person <> author LEFT JOIN reads r ON r.segment_id = c.segment_id AND reader = person WHERE last_read_at IS NULL OR created_at > last_read_at GROUP BY 1, 2"),
    "W02_neighbours": (_neighbours, _SEG + " SELECT article_path, lag(article_path) OVER (ORDER BY q_num, a_num) AS previous, lead(article_path) OVER (ORDER BY q_num, a_num) AS next FROM (SELECT DISTINCT q_num, a_num, article_path FROM segment) AS a"),
    "W03_synonym_groups": (lambda s, d: authority.synonym_groups(view(s, d, "sense"), "category", "label").select("sense_id", "group_id"), model_sql("sense") + " SELECT sense_id, CAST(dense_rank() OVER (PARTITION BY category ORDER BY label NULLS LAST) AS BIGINT) AS group_id FROM sense"),
    "W04_numbers": (_numbering, _SEG + " SELECT segment_id, article_path, CAST(row_number() OVER (PARTITION BY article_path ORDER BY segment_id) AS BIGINT) AS number FROM segment WHERE element_type = '1-URGENT'"),
    "W04_inherited_numbers": (_inherit, _SEG + ", n AS (SELECT segment_id, CAST(row_number() OVER (PARTITION BY article_path ORDER BY segment_id) AS BIGINT) AS number FROM segment WHERE element_type = '1-URGENT') SELECT s.segment_id, s.segment_id - 1 AS reply_to, number FROM segment s LEFT JOIN n ON n.segment_id = s.segment_id - 1 WHERE element_type = '2-HIGH'"),
    "W06_one_per_question": (_pick_order, _SEG + " SELECT segment_id, question_path, nth FROM (SELECT segment_id, question_path, price, CAST(row_number() OVER (PARTITION BY question_path ORDER BY price, segment_id) AS BIGINT) AS nth FROM segment) AS x ORDER BY nth > 1, price, segment_id LIMIT 40"),
    "W07_running_rate": (_running, _SEG + " SELECT segment_id, round(avg(CASE WHEN status = 'needs_human' THEN 1 ELSE 0 END) OVER (PARTITION BY question_path ORDER BY segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS rate FROM segment"),
    "O01_null_order": (_null_order, model_sql("sense") + " SELECT sense_id, CAST(row_number() OVER (PARTITION BY term_id ORDER BY label ASC NULLS LAST, sense_id) AS BIGINT) AS up, CAST(row_number() OVER (PARTITION BY term_id ORDER BY label DESC NULLS FIRST, sense_id) AS BIGINT) AS down FROM sense"),
    "O02_case_order": (_case_order, _SEG + " SELECT segment_id, CAST(row_number() OVER (PARTITION BY article_path ORDER BY CASE element_type WHEN '2-HIGH' THEN 0 WHEN '1-URGENT' THEN 1 ELSE 9 END, segment_id) AS BIGINT) AS place FROM segment"),
    "O03_latest": (_last_run, _SEG + " SELECT segment_id FROM segment ORDER BY changed_at DESC, segment_id DESC LIMIT 1"),
    "O04_installment": (_installment, model_sql("segment", "review") + " SELECT segment_id FROM (SELECT segment_id FROM segment ORDER BY segment_id LIMIT 200) AS x WHERE segment_id NOT IN (SELECT segment_id FROM review)"),
    "O05_keyset_page": (_keyset, model_sql("comment") + " SELECT comment_id, segment_id, author FROM comment WHERE created_at < TIMESTAMP '2024-01-10' ORDER BY created_at DESC, comment_id DESC LIMIT 50"),
    "O06_feed": (_feed, model_sql("comment", "usage", "segment") + ", f AS (SELECT 'comment' AS kind, author AS who, NULL AS sense_id, created_at AS made FROM comment UNION ALL SELECT 'usage', NULL, sense_id, made_at FROM usage UNION ALL SELECT 'change', NULL, NULL, changed_at FROM segment WHERE status = 'pending') SELECT kind, count(*) AS n, count(who) AS who, count(sense_id) AS senses, CAST(max(made) AS VARCHAR) AS latest FROM f GROUP BY kind"),
    "O07_participants": (_union_distinct, model_sql("comment", "review") + " SELECT segment_id, author AS \"user\" FROM comment UNION SELECT segment_id, reviewer FROM review"),
    "O08_distinct_questions": (lambda s, d: view(s, d, "segment").select("pars", "question_path").distinct(), _SEG + " SELECT DISTINCT pars, question_path FROM segment"),
    "O09_absent_numbers": (_absent, model_sql("usage") + " SELECT CAST(n AS BIGINT) AS sense_id FROM range(1, 401) AS t(n) WHERE n NOT IN (SELECT sense_id FROM usage)"),
    "O11_batches": (_batches, _SEG + " SELECT CAST(floor((n - 1) / 50) AS BIGINT) AS batch, count(*) AS n, min(segment_id) AS first FROM (SELECT segment_id, row_number() OVER (ORDER BY segment_id) AS n FROM segment WHERE status = 'pending') AS x GROUP BY 1"),
    "P01_membership": (lambda s, d: view(s, d, "segment").filter(F.col("segment_id").isin(3, 5, 8, 13, 99999999)).select("segment_id", "path"), _SEG + " SELECT segment_id, path FROM segment WHERE segment_id IN (3, 5, 8, 13, 99999999)"),
    "P02_subtree": (_article_filter, _SEG + " SELECT segment_id, path FROM segment WHERE path = 'r1.q1.a1' OR path LIKE 'r1.q1.a1.%' OR path = 'r2' OR path LIKE 'r2.%'"),
    "P03_existence": (lambda s, d: view(s, d, "segment").groupBy("pars").agg(F.bool_or(F.col("status") == "pending").alias("pending")), _SEG + " SELECT pars, bool_or(status = 'pending') AS pending FROM segment GROUP BY pars"),
    "P04_display_precedence": (_display, model_sql("segment", "review") + " SELECT segment_id, coalesce(reviewer, CASE WHEN status = 'translated' THEN element_type END, 'none') AS shown, CASE WHEN reviewer IS NOT NULL THEN 'human' WHEN status = 'translated' THEN 'model' ELSE 'none' END AS origin FROM segment LEFT JOIN review USING (segment_id)"),
    "P05_group_prefix": (_prefixes, _SEG + " SELECT DISTINCT article_path AS prefix FROM segment"),
    "P06_path_columns": (_paths, _SEG + " SELECT segment_id, CAST(len(string_split(path, '.')) AS BIGINT) AS nlevel, pars, question_path, article_path, CAST(q_num AS BIGINT) AS q_num, segment_id AS tail_num, article_path AS parent, '~ST.' || upper(path) AS locator FROM segment"),
    "P07_null_safe": (_null_safe, model_sql("sense") + " SELECT sense_id FROM sense a WHERE EXISTS (SELECT 1 FROM sense b WHERE b.version = 1 AND b.term_id = a.term_id AND b.label IS NOT DISTINCT FROM a.label)"),
    "P08_case_insensitive": (_folded, model_sql("sense") + " SELECT sense_id FROM sense WHERE lower(content) = lower('RED Widget')"),
    "P09_optional_predicates": (_optional, _SEG + " SELECT segment_id, element_type FROM segment WHERE status = 'translated' AND element_type IN ('1-URGENT', '5-LOW') ORDER BY segment_id LIMIT 25"),
    "P11_locator_filter": (_locators, _SEG + " SELECT DISTINCT question_path FROM segment WHERE pars NOT IN ('r0', 'r1') AND coalesce(q_num, 0) <= 12"),
    "P12_report_predicate": (_report_filter, model_sql("sense") + " SELECT sense_id, status, category, label FROM sense WHERE (status = 'flagged' OR (category <> 'formula' AND status <> 'retired')) AND NOT (label IS NULL AND version > 5)"),
    "F19_greatest_mark": (_stamps, "WITH n AS (SELECT event_id % 200 AS segment_id, max(ts) AS read FROM events WHERE event_type = 'view' GROUP BY 1), m AS (SELECT event_id % 150 AS segment_id, max(ts) AS notified FROM events WHERE event_type = 'click' GROUP BY 1) SELECT segment_id, CAST(greatest(read, notified) AS VARCHAR) AS mark FROM n LEFT JOIN m USING (segment_id)"),
}
