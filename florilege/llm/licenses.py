"""License scan by ordered signature rules, in DataFrame operations only.

A text first meets a cheap gate: a few literals and short words, one of which
every rule's match and every base phrase holds.  Texts that pass are cut into
plain words and into segments of ``SEGMENT`` words with ``EDGE`` more behind
them (no rule can match more), and a segment meets the rules whose keyword it
holds.  A match is an interval of words.

An interval that lies within another's is suppressed: of equal intervals the
rule of lower number stays.  What is left is taken in the order of rules: a
match goes only if one that stays, of a lower rule, overlaps it.  That gives the labels, beside those of the
base phrases, which always stay; the score is the highest weight among them
(``BASE_WEIGHT`` for a base phrase).

Matches belong to texts, by a hash of the whole text; rows without words get
a key of their own, so that they don't meet anywhere.  Null texts and texts
without words have no matches and score 0; repeated rows repeat; an empty table
gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florilege.llm.license_rules import GATE_WORDS, GATES, build
from florilege.llm.shared import materialize, redealt
from florilege.llm.words import PLAIN_GAP, lead, lower_ascii, n_words, raw_words, text_key

SEGMENT, EDGE = 1024, 64
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
BASE_WEIGHT = 0.5


def gate(text: Column) -> Column:
    """True for all texts in which a rule or a base phrase may match."""
    words = "(?:^|[^0-9a-z])(?:" + "|".join(GATE_WORDS) + ")(?:[^0-9a-z]|$)"
    parts = [w.split("[")[0] for w in GATE_WORDS]  # literals that a gate word begins with

    def holds(low: Column) -> Column:
        found = [F.contains(low, F.lit(literal)) for literal in GATES]
        return reduce(or_, found) | (reduce(or_, [F.contains(low, F.lit(x)) for x in parts]) & low.rlike(words))

    return F.exists(F.array(F.lower(text)), holds)  # lowers the text once, not for each literal


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def intervals(text: str, pattern: str) -> Column:
    """(first, last) word places of all matches of a pattern; both are names of columns, words have one space before each."""
    between, found = F.split(text, F.col(pattern), -1), F.regexp_extract_all(text, F.col(pattern), F.lit(0))
    n_between, n_found = F.transform(between, _spaces), F.transform(found, _spaces)

    def add(acc: Column, x: Column) -> Column:
        first = acc["at"] + x["a"]
        return F.struct((first + x["b"]).alias("at"), F.concat(acc["out"], F.array(F.struct(first.alias("first"), (first + x["b"] - 1).alias("last")))).alias("out"))

    pairs = F.zip_with(F.slice(n_between, F.lit(1), F.size(n_found)), n_found, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))
    return F.aggregate(pairs, start, add)["out"]


def matches(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """key, first, last, rule, label, weight of all matches; rule -1 are base phrases."""
    spark = docs.sparkSession
    rules = [(-1, label, phrase, f" {phrase}(?= )", BASE_WEIGHT) for phrase, label in BASE]
    rules += [(r.rule, r.label, r.keyword, r.pattern, r.weight) for r in build()]
    table = spark.createDataFrame(rules, "rule int, label string, keyword string, pattern string, weight double")
    keywords = sorted({r[2] for r in rules})
    passed = docs.select(F.col(text_col).alias("text")).filter(gate(F.col("text")))
    words = F.split(lower_ascii(F.col("text")), PLAIN_GAP, -1)
    passed = passed.select(text_key(F.col("text")).alias("key"), words.alias("w"))
    passed = passed.select("key", "w", lead(F.col("w")).alias("lead"), n_words(F.col("w")).alias("n")).filter("n > 0")

    def cut(core: Column) -> Column:
        own = F.slice("w", core + F.col("lead") + 1, F.least(F.lit(SEGMENT + EDGE), F.col("n") - core))
        return F.struct(core.alias("core"), F.concat(F.lit(" "), F.array_join(own, " "), F.lit(" ")).alias("s"))

    segments = passed.select("key", F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1, F.lit(SEGMENT)), cut)).alias("x")).select("key", "x.*")
    held = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.col("s"), k))
    met = segments.select("key", "core", "s", F.explode(held).alias("keyword")).join(F.broadcast(table), "keyword")  # the table is fixed
    met = met.filter(F.regexp_like("s", F.col("pattern")))
    found = met.select("key", "core", "rule", "label", "weight", F.explode(intervals("s", "pattern")).alias("i")).filter(F.col("i.first") < SEGMENT)
    return found.select("key", (F.col("core") + F.col("i.first")).alias("first"), (F.col("core") + F.col("i.last")).alias("last"), "rule", "label", "weight").distinct()


def resolve(found: DataFrame) -> DataFrame:
    """The matches of rules that no other suppresses: those inside another go, the rest are taken by rule, each unless one already taken overlaps it.

    Matches that hang together by overlaps are a chain, which alone is folded
    as an array: no more of a text than that meets.
    """
    order = Window.partitionBy("key").orderBy("first", F.col("last").desc(), "rule")
    outer = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    kept = found.filter("rule >= 0").withColumn("outer", outer).filter("outer is null or outer < last")
    begins = (F.col("outer").isNull() | (F.col("outer") < F.col("first"))).cast("int")
    kept = kept.withColumn("chain", F.sum(begins).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    match = F.struct("rule", "first", "last", "label", "weight")
    chains = kept.groupBy("key", "chain").agg(F.array_sort(F.collect_list(match)).alias("m"))

    def take(taken: Column, x: Column) -> Column:
        lost = F.exists(taken, lambda t: (t["first"] <= x["last"]) & (t["last"] >= x["first"]) & (t["rule"] < x["rule"]))
        return F.when(lost, taken).otherwise(F.concat(taken, F.array(x)))

    chosen = F.when(F.size("m") == 1, F.col("m")).otherwise(F.aggregate("m", F.slice("m", 1, 0), take))
    return chains.select("key", F.explode(chosen).alias("x")).select("key", "x.first", "x.last", "x.rule", "x.label", "x.weight")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score of each row of ``docs``."""
    found = materialize(matches(docs, text_col)).repartition("key")  # read twice
    marked = resolve(found).select("key", "first", "label", "weight", F.lit(False).alias("base"))
    marked = marked.union(found.filter("rule < 0").select("key", "first", "label", "weight", F.lit(True).alias("base")))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.when(F.col("base"), F.col("first"))
    per_text = marked.groupBy("key").agg(
        F.count(base).alias("n_base"), F.min(base).cast("bigint").alias("first_word"), F.max(base).cast("bigint").alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"), F.max("weight").alias("score"),
    )
    text = F.col(text_col)
    rows = docs.select(F.col(id_col), n_words(raw_words(text)).cast("bigint").alias("n_words"), text_key(text, n_words(raw_words(text)) > 0).alias("key"))
    return rows.join(redealt(per_text), "key", "left").select(
        id_col, "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
