"""Look-ups by code, id, label and path: each takes its requests as a table, so that many are one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.functions.paths import nlevel
from florilege.operators.authority import best_by_authority
from florilege.operators.navigation import numbered


def ids_of(codes: DataFrame, dimension: DataFrame, code: str, value: str, required: bool = False) -> DataFrame:
    """code, value of distinct codes.  Null where the dimension has none, or an error when it is computed."""
    own = codes.select(code).distinct().join(dimension.select(code, value, F.lit(True).alias("_known")), code, "left")
    missing = F.raise_error(F.concat(F.lit(f"no {value} for "), F.coalesce(F.col(code).cast("string"), F.lit("null")))).cast(dimension.schema[value].dataType)
    found = F.when(F.col("_known"), F.col(value)).otherwise(missing) if required else F.col(value)
    return own.select(code, found.alias(value))


def winners_of(segment_id: int, texts: DataFrame) -> DataFrame:
    """Best text of one segment in each language: the filter comes before the choice."""
    return best_by_authority(texts.filter(F.col("segment_id") == segment_id), ["segment_id", "lang"], ["authority", "doc_id"], ["doc_id", "source"])


def by_ids(rows: DataFrame, ids: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return rows.select(key, *columns).join(ids.select(key), key, "left_semi")


def by_label(requests: DataFrame, senses: DataFrame) -> DataFrame:
    """Senses of a term with a label; no label asks for senses without one."""
    own = senses.select("term_id", F.col("label").alias("_label"), "sense_id", "status")
    asked = requests.select("term_id", "label").distinct()
    return asked.join(own, (asked["term_id"] == own["term_id"]) & asked["label"].eqNullSafe(own["_label"])).select(asked["term_id"], "label", "sense_id", "status")


def formulas(senses: DataFrame, terms: list[str]) -> DataFrame:
    """Approved formula of each of the terms: the latest version, then the first id."""
    own = senses.filter((F.col("category") == "formula") & (F.col("status") == "approved") & F.col("term").isin(terms)).withColumn("rank", -F.col("version"))
    return best_by_authority(own, ["term"], ["rank", "sense_id"], ["sense_id", "content"])


def titles(segments: DataFrame) -> DataFrame:
    """Distinct locators of questions and articles."""
    return segments.select("question_path").union(segments.select("article_path")).distinct().select(F.col("question_path").alias("path")).withColumn("depth", nlevel(F.col("path")))


def at_paths(segments: DataFrame, paths: DataFrame) -> DataFrame:
    """Segments that stand exactly at the paths."""
    return segments.join(paths.select("path").distinct(), "path", "left_semi")


def translated_bodies(segments: DataFrame, depth: int = 4) -> DataFrame:
    """Ids of translated segments below articles, titles left out."""
    return segments.filter((F.col("status") == "translated") & (nlevel(F.col("path")) >= depth)).select("segment_id")


def review_notes(rows: DataFrame, notes: str) -> DataFrame:
    """segment_id, iteration, feedback of rows for people, from their notes; notes that are no object have none."""
    schema = "iterations array<struct<iteration:int,feedback:string>>"
    own = rows.filter("status = 'needs_human'").withColumn("_n", F.from_json(F.when(F.ltrim(F.col(notes)).startswith("{"), F.col(notes)), schema))
    return own.select("segment_id", F.explode("_n.iterations").alias("i")).select("segment_id", "i.iteration", "i.feedback")


def in_order(rows: DataFrame, where: Column, order: list[str]) -> DataFrame:
    """The rows of a condition with their place (from 1) in an order."""
    return numbered(rows.filter(where), order, "place").withColumn("place", F.col("place") + 1)


def term_segments(usage: DataFrame, senses: DataFrame, texts: DataFrame, languages: list[str]) -> DataFrame:
    """term_id, segment_id and a column per language: texts of all segments that use a sense of the term."""
    own = usage.join(senses.select("sense_id", "term_id"), "sense_id").select("term_id", "segment_id").distinct()
    pivot = texts.filter(F.col("lang").isin(languages)).groupBy("segment_id").agg(*(F.max(F.when(F.col("lang") == x, F.col("content"))).alias(x) for x in languages))
    return own.join(pivot, "segment_id", "left").select("term_id", "segment_id", *languages)


def senses_with_renderings(senses: DataFrame, renderings: DataFrame, languages: list[str]) -> DataFrame:
    """sense_id, label, status and the rendering in each language, senses without any too."""
    own = renderings.groupBy("sense_id").agg(*(F.max(F.when(F.col("lang") == x, F.col("content"))).alias(x) for x in languages))
    return senses.select("sense_id", "label", "status").join(own, "sense_id", "left")


def counts(segments: DataFrame, usage: DataFrame) -> DataFrame:
    """What there is, in rows: body segments and proposed usages."""
    bodies = segments.filter(nlevel(F.col("path")) >= 4).agg(F.count("*").alias("n")).select(F.lit("body_segments").alias("what"), "n")
    return bodies.union(usage.filter("status = 'model_proposed'").agg(F.count("*").alias("n")).select(F.lit("model_proposed"), "n"))


def first_locators(ids: DataFrame, segments: DataFrame, k: int) -> DataFrame:
    """Locators of the first ``k`` ids: a top-k before the join."""
    return ids.select("segment_id").distinct().orderBy("segment_id").limit(k).join(segments.select("segment_id", "path"), "segment_id")


def status_snapshot(tables: dict[str, DataFrame]) -> DataFrame:
    """what, status, n of each table."""
    out = None
    for name, df in tables.items():
        own = df.groupBy("status").agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "status", "n")
        out = own if out is None else out.union(own)
    return out
