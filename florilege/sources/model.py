"""The text model as views over the tables of a data folder.

Segments hang in a tree of part, question, article and segment; usages point
from segments to versioned senses; texts, reviews, comments, reads, runs and
failures belong to segments.  Each view is a lazy projection, so that pruning
and pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Each view as a SELECT that Spark and other engines read alike; ``{}`` places are tables of the folder.
VIEWS: dict[str, str] = {
    "segment": """SELECT o_orderkey AS segment_id, concat('r', n_regionkey, '.q', n_nationkey, '.a', c_custkey, '.s', o_orderkey) AS path,
      concat('r', n_regionkey) AS pars, concat('r', n_regionkey, '.q', n_nationkey) AS question_path,
      concat('r', n_regionkey, '.q', n_nationkey, '.a', c_custkey) AS article_path, n_nationkey AS q_num, c_custkey AS a_num, o_orderpriority AS element_type,
      CASE o_orderstatus WHEN 'F' THEN 'translated' WHEN 'O' THEN 'needs_human' ELSE 'pending' END AS status, o_orderdate AS changed_at, o_totalprice AS price
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "pars_order": "SELECT concat('r', r_regionkey) AS pars, (r_regionkey * 3) % 5 AS ordinal FROM region WHERE r_regionkey < 4",
    "usage": """SELECT l_orderkey AS segment_id, l_partkey AS sense_id, l_linenumber AS used, l_returnflag AS method,
      CASE l_linestatus WHEN 'F' THEN 'auto' ELSE 'needs_review' END AS confidence,
      CASE WHEN l_discount >= 0.09 THEN 'rejected' WHEN l_discount >= 0.05 THEN 'confirmed' ELSE 'model_proposed' END AS status, l_shipdate AS made_at FROM lineitem""",
    "sense": """SELECT p_partkey AS sense_id, CAST(substr(p_brand, 7) AS INT) AS term_id, p_brand AS term, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS label,
      1 + p_size % 7 AS version, CASE p_size % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'flagged' WHEN 2 THEN 'proposed' ELSE 'retired' END AS status,
      CASE p_size % 3 WHEN 0 THEN 'term' WHEN 1 THEN 'name' ELSE 'formula' END AS category, p_name AS content FROM part""",
    "segment_text": """SELECT doc_id, doc_id % 100 AS segment_id, lang, source, CAST(substr(source, 4) AS INT) AS authority, text AS content FROM documents""",
    "review": "SELECT doc_id AS segment_id, concat('u', toxic) AS reviewer, quality + 1 AS human_version FROM labels",
    "comment": """SELECT event_id AS comment_id, event_id % 200 AS segment_id, concat('u', user_id % 20) AS author, ts AS created_at, event_id % 3 = 0 AS resolved
      FROM events WHERE event_type = 'click'""",
    "reads": "SELECT event_id % 200 AS segment_id, concat('u', user_id % 20) AS reader, max(ts) AS last_read_at FROM events WHERE event_type = 'view' GROUP BY 1, 2",
    "run_segment": """SELECT turn % 2 AS run_id, conv_id AS segment_id, count(*) AS iterations, sum(length(text)) AS chars,
      CASE sum(length(text)) % 3 WHEN 0 THEN 'translated' WHEN 1 THEN 'needs_human' ELSE 'error' END AS status FROM conversations GROUP BY 1, 2""",
    "failure": "SELECT event_id % 2 AS run_id, event_id AS segment_id, props FROM events",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view of the model, as a DataFrame."""
    text = VIEWS[name]
    words = set(text.replace(",", " ").split())
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation", "region", "lineitem", "part", "documents", "labels", "events", "conversations") if t in words}
    for t in words & {"orders", "lineitem", "events"}:
        stamps = [f.name for f in frames[t].schema if f.dataType.simpleString() == "timestamp_ntz"]
        frames[t] = frames[t].withColumns({c: F.col(c).cast("timestamp") for c in stamps})
    for t in frames:
        text = _placed(text, t)
    return spark.sql(text, **frames)


def _placed(text: str, table: str) -> str:
    out = []
    for word in text.split(" "):
        bare = word.strip("\n")
        out.append(word.replace(bare, "{" + table + "}") if bare == table else word)
    return " ".join(out)


def model_sql(*names: str) -> str:
    """The views as the beginning of a WITH query."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
