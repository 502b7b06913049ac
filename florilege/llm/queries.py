"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.html_blocks import extract

    return extract(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.quality import apply_rules

    return apply_rules(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.lm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.near import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"))


def op9_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.chat import digests

    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], own.schema)
    return digests(own.union(more), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.decontaminate import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_expiring_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.clicks import dedupe_clicks

    return dedupe_clicks(table(spark, sf_dir, "clicks"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.suffixes import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from florilege.llm.negatives import hard_negatives

    return hard_negatives(table(spark, sf_dir, "embeddings"))


_PLAIN = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN} AS w FROM documents),
i AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
wi AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS g
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(s) WHERE len(w) > 0),
wd AS (
  SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
  FROM d, (SELECT DISTINCT n FROM wi) AS k, unnest(range(1, len(w) - n + 2)) AS t(s)),
h AS (SELECT r, wd.n, s, item_id FROM wd JOIN wi ON wd.g = wi.g AND wd.n = wi.n),
p AS (SELECT r, count(DISTINCT s + k) AS n_hit FROM h, unnest(range(0, n)) AS t(k) GROUP BY r),
q AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM h) AS x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN q USING (r)
"""

OP6_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, text, {_PLAIN} AS w FROM documents),
k AS (SELECT doc_id, w, CASE WHEN len(w) > 0 THEN 'w ' || array_to_string(w, ' ') ELSE coalesce('t ' || text, 'n') END AS k FROM d),
c AS (SELECT k, min(doc_id) AS least, count(*) AS n_copies, any_value(w) AS w FROM k GROUP BY k),
s AS (SELECT DISTINCT least AS c, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM c, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT c, count(*) AS n FROM s GROUP BY c),
p AS (SELECT a.c AS a, b.c AS b, count(*) AS m FROM s AS a JOIN s AS b ON a.g = b.g AND a.c <> b.c GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n AS x ON x.c = a JOIN n AS y ON y.c = b WHERE m >= 0.8 * (x.n + y.n - m) - 1e-9),
r(c, o) AS (SELECT least, least FROM c UNION SELECT r.c, l.b FROM r JOIN l ON l.a = r.o),
m AS (SELECT c, min(o) AS class_id FROM r GROUP BY c),
z AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, n_copies
FROM k JOIN c USING (k) JOIN m ON m.c = least LEFT JOIN z ON z.a = least
"""


OP13_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.r <> b.r),
p AS (SELECT a, anchor_id, b, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id, s.b) AS INTEGER) AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extraction, op2_token_counts, op3_quality_rules, op4_ppm_scores, op5_license_scan, op6_jaccard_join, op7_sharding, op8_packing, op9_chat_trees, op10_decontamination, op11_expiring_clicks, op12_suffix_dedup, op13_hard_negatives, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op6_jaccard_join": OP6_SQL, "op10_decontamination": OP10_SQL, "op13_hard_negatives": OP13_SQL}
