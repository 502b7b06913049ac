"""Acceptance of sources: structure of pages, expected files, overlay elements, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florilege.functions.paths import child, nlevel, subpath


def missing_kinds(pages: DataFrame, key: str, text: str, pattern: str, required: list[str]) -> DataFrame:
    """key, missing (sorted): kinds that a page lacks; the pattern's first group names a kind."""
    found = F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(pattern), F.lit(1)), F.lower)
    return pages.select(key, F.array_sort(F.array_except(F.array(*map(F.lit, required)), found)).alias("missing"))


def marker_counts(pages: DataFrame, key: str, text: str, pattern: str, least: int) -> DataFrame:
    """key, n, ok: pages must hold ``least`` markers."""
    n = F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(pattern), F.lit(0)))
    return pages.select(key, n.cast("bigint").alias("n")).withColumn("ok", F.col("n") >= least)


def absent_files(expected: DataFrame, found: DataFrame, name: str) -> DataFrame:
    return expected.select(name).distinct().join(found.select(name), name, "left_anti")


def page_identity(pages: DataFrame, key: str, text: str, checks: dict[str, str]) -> DataFrame:
    """key and, per check, whether its pattern holds; ``anomalies`` lists those that don't."""
    own = F.coalesce(F.col(text), F.lit(""))
    flags = {name: own.rlike(pattern) for name, pattern in checks.items()}
    broken = F.filter(F.array(*(F.when(~flag, F.lit(name)) for name, flag in flags.items())), lambda x: x.isNotNull())
    return pages.select(key, *(flag.alias(name) for name, flag in flags.items()), F.array_join(broken, ",").alias("anomalies"))


def link_numbers(links: DataFrame, link: str, prefix: str, suffix: str, strict: bool = True) -> DataFrame:
    """Links below the prefix with their number; one of another shape is an error, or null if not ``strict``."""
    under = links.filter(F.startswith(F.col(link), F.lit(prefix)))
    tail = F.substr(F.col(link), F.lit(len(prefix) + 1))
    digits = F.when(F.endswith(tail, F.lit(suffix)), F.substr(tail, F.lit(1), F.length(tail) - len(suffix)))
    number = F.when(digits.rlike("^[0-9]+$"), digits.try_cast("bigint"))
    odd = F.raise_error(F.concat(F.lit("unexpected link "), F.col(link))).cast("bigint")
    return under.withColumn("number", F.when(number.isNotNull(), number).otherwise(odd if strict else F.lit(None)))


def file_name(part: Column, question: Column, digits: dict[str, int]) -> Column:
    """Digit of the part, then the question in three digits."""
    table = F.create_map(*(F.lit(x) for pair in digits.items() for x in pair))
    return F.concat(table[part].cast("string"), F.lpad(question.cast("string"), 3, "0"), F.lit(".html"))


def checks(measures: DataFrame, least: dict[str, int]) -> DataFrame:
    """check, found, least, ok of one row of measures."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.col(k).cast("bigint").alias("found"), F.lit(v).cast("bigint").alias("least")) for k, v in least.items())))
    return measures.select(each.alias("c")).select("c.*").withColumn("ok", F.coalesce(F.col("found") >= F.col("least"), F.lit(False)))


def articles(segments: DataFrame, depth: int = 4) -> DataFrame:
    """article, part, question, number, n of segments at or below a depth."""
    own = segments.filter(nlevel(F.col("path")) >= depth).withColumn("article", subpath(F.col("path"), 0, 3))
    return own.groupBy("article", F.col("pars").alias("part"), F.col("q_num").alias("question"), F.col("a_num").alias("number")).agg(F.count("*").alias("n"))


def overlay_elements(elements: DataFrame, requested: DataFrame) -> DataFrame:
    """The last element (by ``at``) of each path that requested articles need: their question, its preamble, the article and all below."""
    last = elements.groupBy("path").agg(F.max_by("content", "at").alias("content"))
    wanted = requested.select(F.col("article_path").alias("article")).distinct()
    question = wanted.select(subpath(F.col("article"), 0, 2).alias("q")).distinct()
    above = last.join(question.select(F.explode(F.array("q", child(F.col("q"), "preamble"))).alias("path")), "path", "left_semi")
    below = last.withColumn("article", subpath(F.col("path"), 0, 3)).filter(nlevel(F.col("path")) >= 3).join(wanted, "article", "left_semi")
    return above.select("path", "content").union(below.select("path", "content"))


def spot_check(rows: DataFrame, group: str, order: str, most: int = 2) -> DataFrame:
    return rows.withColumn("at", F.row_number().over(Window.partitionBy(group).orderBy(order))).filter(F.col("at") <= most)


def known_senses(senses: DataFrame, known: DataFrame) -> DataFrame:
    """term, state of terms known to have several senses: ``multi``, ``single`` or ``absent``."""
    n = senses.groupBy("term").agg(F.count("*").alias("n"))
    state = F.when(F.col("n").isNull(), "absent").when(F.col("n") == 1, "single").otherwise("multi")
    return known.select("term").distinct().join(n, "term", "left").select("term", state.alias("state"))


def glossary_summary(terms: DataFrame, senses: DataFrame) -> DataFrame:
    """terms, senses, single, multi, multiword in one row."""
    n = senses.groupBy("term_id").agg(F.count("*").alias("n"))
    return terms.join(n, "term_id", "left").agg(
        F.count("*").alias("terms"), F.coalesce(F.sum("n"), F.lit(0)).alias("senses"), F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("multi"), F.count_if(F.contains("lemma", F.lit(" "))).alias("multiword")
    )
