"""Deterministic checks of drafts and of polished texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.functions.text import holds_phrase, length_ratio, letter_tokens, sentences, stem, strip_marks


def polish_guards(df: DataFrame, before: str, after: str, particles: list[str], most_delta: int = 1, ratio: tuple[float, float] = (0.5, 2.0)) -> DataFrame:
    """sentence_delta, length_ratio, lost (particles that went), ok of each row."""
    listed = F.array(*map(F.lit, particles)).cast("array<string>")
    words = lambda c: F.transform(letter_tokens(F.col(c)), F.lower)
    out = df.withColumn("sentence_delta", F.abs(sentences(F.col(after)) - sentences(F.col(before))))
    out = out.withColumn("length_ratio", length_ratio(F.col(after), F.col(before)))
    out = out.withColumn("lost", F.array_except(F.array_intersect(listed, words(before)), words(after)))
    ok = (F.col("sentence_delta") <= most_delta) & F.col("length_ratio").between(*ratio) & (F.size("lost") == 0)
    return out.withColumn("ok", ok)


def holds_term(draft: Column, term: Column) -> Column:
    """Every word of the term stands in the draft: as it is, or as a word that begins with its stem."""
    tokens = F.transform(letter_tokens(draft), strip_marks)
    return F.forall(letter_tokens(term), lambda w: F.exists(tokens, lambda t: (t == strip_marks(w)) | F.startswith(t, stem(strip_marks(w)))))


def holds_exactly(draft: Column, required: Column) -> Column:
    return F.contains(strip_marks(draft), strip_marks(required))


def terminology(df: DataFrame, draft: str, constraints: str) -> DataFrame:
    """Constraints (structs of required, category) that a draft does not meet: formulas as phrases, others word by word."""
    met = lambda c: F.when(c["category"] == "formula", holds_phrase(F.col(draft), c["required"])).otherwise(holds_term(F.col(draft), c["required"]))
    return df.withColumn("unmet", F.filter(constraints, lambda c: ~F.coalesce(met(c), F.lit(False))))


def completeness(rows: DataFrame, group: str, kind: str, hard: list[str], soft: list[str]) -> DataFrame:
    """Kinds that a group lacks: hard ones fail it, soft ones warn."""
    has = rows.groupBy(group).agg(F.collect_set(kind).alias("has"))
    lacks = lambda kinds: F.array_sort(F.array_except(F.array(*map(F.lit, kinds)), F.col("has")))
    return has.select(group, lacks(hard).alias("fails"), lacks(soft).alias("warns"))


def pass_rates(df: DataFrame, kind: str) -> DataFrame:
    return df.groupBy(kind).agg(F.count("*").alias("n"), F.round(F.avg(F.col("ok").cast("int")), 6).alias("rate"))
