"""Terms in texts: inflected forms, constraints, the terminology check and the segment resolver.

Dictionaries are tables: ``lemmas`` (surface, candidate, lemma) and ``forms``
(lemma, form), so that any morphology can stand behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.functions.text import ascii_tokens, canonical_lemma, holds_phrase, letter_tokens, stem, strip_marks
from florilege.operators.match import leftmost_longest, token_terms, vote
from florilege.operators.phrases import masked, phrase_spans
from florilege.store import computed_once

#: How a usage was found.
SINGLE, VOTED, FLAGGED = "single", "multi_voted", "multi_flagged"
#: Words that stand for a term and go to the tasks whole; beyond that, they are joined by a shuffle.
MOST_KNOWN = 200_000


def forms_of(lemmas: DataFrame, forms: DataFrame) -> DataFrame:
    """lemma, forms (lower case, sorted; empty for lemmas that the dictionary lacks)."""
    own = forms.groupBy(F.lower("lemma").alias("_l")).agg(F.array_sort(F.collect_set(F.lower("form"))).alias("forms"))
    asked = lemmas.select("lemma").distinct().withColumn("_l", F.lower("lemma"))
    return asked.join(own, "_l", "left").select("lemma", F.coalesce("forms", F.array().cast("array<string>")).alias("forms"))


def surface_constraints(constraints: DataFrame, texts: DataFrame, lemmas: DataFrame, key: str = "segment_id", text: str = "content") -> DataFrame:
    """Constraints (key, lemma, category, ...) in the words of the text: each token whose lemma is meant, or the lemma if there is none.

    Formulas and lemmas of several words stay as they are.
    """
    single = ~F.contains("lemma", F.lit(" ")) & ~F.coalesce(F.col("category") == "formula", F.lit(False))
    stripped = F.regexp_replace("lemma", r"\d+$", "")
    tokens = texts.select(key, F.explode(F.array_distinct(ascii_tokens(F.coalesce(F.col(text), F.lit(""))))).alias("surface"))
    known = lemmas.select("surface", stripped.alias("_l")).distinct()
    found = tokens.join(known, "surface", "left").select(key, "surface", F.coalesce("_l", "surface").alias("_l"))
    own = constraints.filter(single).withColumn("_l", stripped).join(found, [key, "_l"], "left")
    own = own.withColumn("lemma", F.coalesce("surface", "lemma")).select(*constraints.columns)
    return own.union(constraints.filter(~F.coalesce(single, F.lit(False))).select(*constraints.columns))


def term_check(drafts: DataFrame, constraints: DataFrame, forms: DataFrame, key: str = "segment_id", draft: str = "content") -> DataFrame:
    """key, required, ok of each constraint (key, required, category): words are joined with their forms, texts are never analysed.

    A formula must stand as a phrase between word boundaries.  Of other terms
    every word must be there: itself, one of its forms, or a word that begins
    with its stem.
    """
    words = letter_tokens(F.coalesce(F.col(draft), F.lit("")))
    distinct = F.array_distinct(words)
    tokens = drafts.select(key, F.array_distinct(F.transform(distinct, F.lower)).alias("_t"), F.array_distinct(F.transform(distinct, strip_marks)).alias("_n"))
    is_formula = F.coalesce(F.col("category") == "formula", F.lit(False))
    phrases = constraints.filter(is_formula).join(drafts.select(key, F.col(draft).alias("_d")), key).select(key, "required", F.coalesce(holds_phrase(F.col("_d"), F.col("required")), F.lit(False)).alias("ok"))
    each = constraints.filter(~is_formula).select(key, "required", F.explode_outer(letter_tokens(F.col("required"))).alias("lemma"))
    known = each.select("lemma").distinct().join(forms_of(each, forms), "lemma", "left").withColumn("_stem", stem(strip_marks(F.col("lemma"))))
    each = each.join(known, "lemma", "left").join(tokens, key)
    begins = F.exists("_n", lambda t: F.startswith(t, F.col("_stem")))
    met = F.col("lemma").isNull() | F.array_contains("_t", F.lower("lemma")) | F.coalesce(F.arrays_overlap("_t", "forms"), F.lit(False)) | begins
    return phrases.union(each.groupBy(key, "required").agg(F.bool_and(met).alias("ok")))


def resolve_segments(texts: DataFrame, phrases: DataFrame, lemmas: DataFrame, terms: DataFrame, senses: DataFrame, signals: DataFrame, gaps: DataFrame, suppressed: DataFrame | None = None, least: int = 4, strong: int = 20) -> DataFrame:
    """segment_id, term_id, sense_id, method, confidence: one row per term of a segment.

    ``texts``: segment_id, content, czech, english.  Phrases (phrase_id is the
    term) are matched first, leftmost and longest; those found are masked wherever
    they stand.
    Of the words left, the first candidate lemma that is a term hits, whatever
    its case; a hit that ``suppressed`` (segment_id, token) names is consumed
    without result.  Words without a hit fall back to their first candidate
    lemma, of ``least`` letters or more, if ``gaps`` (lemma, term_id, sense_id)
    has a proposal for it.  Phrases go before words, words before gaps; terms
    with several senses are voted on by ``signals``.  Words are looked up once
    for all texts; texts meet only those that stand for a term.
    """
    kept = texts.select("segment_id", F.coalesce("content", F.lit("")).alias("content"))
    places = computed_once(phrase_spans(kept, phrases))
    spans = leftmost_longest(places)
    cut = masked(kept, places.join(spans.select("segment_id", "phrase_id").distinct(), ["segment_id", "phrase_id"], "left_semi"))
    words = computed_once(cut.select("segment_id", F.array_distinct(F.transform(ascii_tokens(F.col("content")), F.lower)).alias("words")))
    tokens = words.select("segment_id", F.explode("words").alias("token"))
    vocabulary = computed_once(tokens.select("token").distinct())
    hit = computed_once(token_terms(vocabulary, lemmas, terms))
    first = lemmas.groupBy(F.lower("surface").alias("token")).agg(F.min_by("lemma", "candidate").alias("_l"))
    gap = vocabulary.join(hit, "token", "left_anti").join(first, "token", "left").select("token", canonical_lemma(F.coalesce("_l", "token")).alias("lemma")).filter(F.length("lemma") >= least)
    gap = gap.join(gaps.select("lemma", F.col("term_id").cast("bigint").alias("term_id"), F.col("sense_id").cast("bigint").alias("gap_sense")), "lemma")
    known = hit.select("token", F.lit(1).alias("stage"), F.col("term_id").cast("bigint"), F.lit(None).cast("bigint").alias("gap_sense"))
    known = computed_once(known.union(gap.select("token", F.lit(2), "term_id", "gap_sense")))
    met = tokens.join(F.broadcast(known) if known.count() <= MOST_KNOWN else known, "token")
    if suppressed is not None:
        away = suppressed.select("segment_id", F.lower("token").alias("token"), F.lit(1).alias("stage"))
        met = met.join(away, ["segment_id", "token", "stage"], "left_anti")
    staged = spans.select("segment_id", F.col("phrase_id").alias("term_id"), F.lit(0).alias("stage"), F.lit(None).cast("bigint").alias("gap_sense"))
    staged = staged.union(met.select("segment_id", "term_id", "stage", "gap_sense"))
    found = staged.groupBy("segment_id", "term_id").agg(F.min_by(F.struct("stage", "gap_sense"), F.struct("stage", "gap_sense")).alias("s")).select("segment_id", "term_id", "s.*")
    size = senses.groupBy("term_id").agg(F.count("*").alias("n"))
    voted = vote(found.filter("stage < 2").select("segment_id", "term_id"), senses, signals, strong).join(size, "term_id")
    method = F.when(F.col("n") == 1, SINGLE).when(F.col("confidence") == "auto", VOTED).otherwise(FLAGGED)
    has = lambda c: F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))
    context = texts.select("segment_id", F.when(has("czech"), "czech_derived").when(has("english"), "english_derived").otherwise("model_proposed").alias("method"))
    guessed = found.filter("stage = 2").join(context, "segment_id").select("segment_id", "term_id", F.col("gap_sense").alias("sense_id"), "method", F.lit("needs_review").alias("confidence"))
    return voted.select("segment_id", "term_id", F.col("sense_id").cast("bigint").alias("sense_id"), method.alias("method"), "confidence").union(guessed)


def valid_labels(labels: DataFrame, clusters: DataFrame, required: list[str]) -> DataFrame:
    """Labels (term_id, lemma, ...) with all required fields filled whose lemma is among the mined clusters."""
    filled = F.lit(True)
    for c in required:
        filled = filled & F.coalesce(F.length(F.col(c).cast("string")) > 0, F.lit(False))
    return labels.filter(filled).join(clusters.select("term_id", "lemma").distinct(), ["term_id", "lemma"], "left_semi")


def shared_records(prior: DataFrame, current: DataFrame, key: str, column: str) -> DataFrame:
    """key, prior, current of keys that both runs have."""
    return prior.select(key, F.col(column).alias("prior")).join(current.select(key, F.col(column).alias("current")), key)
