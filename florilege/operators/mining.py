"""Document frequencies, lift of renderings, cues and gap lemmas: all terms at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florilege.functions.text import ascii_tokens, canonical_lemma, letter_tokens
from florilege.store import computed_once

#: Words that share their lemma with another and go to the tasks whole; beyond that, they are joined by shuffles.
MOST_SHARED = 200_000


def lemma_lists(texts: DataFrame, key: str, text: str, least: int = 1) -> DataFrame:
    """key, lemmas, opens: distinct lower-case words of ``least`` letters or more, in one list for a text.

    Only ids that several rows have are shuffled with their words, so that each
    word stands in one list of an id.  ``opens`` holds for one row of each id
    that has words.
    """
    lemmas = F.transform(letter_tokens(F.coalesce(F.col(text), F.lit(""))), F.lower)
    own = texts.select(key, F.filter(F.array_distinct(lemmas), lambda w: F.length(w) >= least).alias("lemmas"))
    single = own.withColumn("opens", F.size("lemmas") > 0)
    repeated = computed_once(texts.groupBy(key).agg(F.count("*").alias("_m")).filter("_m > 1").select(F.col(key).alias("_id")))
    if repeated.isEmpty():
        return single
    met = F.col(key).eqNullSafe(F.col("_id"))
    pairs = own.join(repeated, met, "left_semi").select(key, F.explode("lemmas").alias("lemma")).distinct()
    return single.join(repeated, met, "left_anti").unionByName(_lists(pairs, key))


def _lists(pairs: DataFrame, key: str) -> DataFrame:
    """Distinct (key, lemma) as lists of one, and an empty one that opens each id."""
    opening = pairs.select(key).distinct().select(key, F.array().cast("array<string>").alias("lemmas"), F.lit(True).alias("opens"))
    return pairs.select(key, F.array("lemma").alias("lemmas"), F.lit(False).alias("opens")).unionByName(opening)


def lemma_sets(texts: DataFrame, key: str, text: str, least: int = 1) -> DataFrame:
    """Distinct (key, lemma); lemmas are lower-case words of ``least`` letters or more."""
    return lemma_lists(texts, key, text, least).select(key, F.explode("lemmas").alias("lemma"))


def document_frequency(sets: DataFrame) -> DataFrame:
    return sets.groupBy("lemma").agg(F.count("*").alias("df"))


def renderings(term_segments: DataFrame, sets: DataFrame, least_df: int = 3, least_rate: float = 0.05, least_lift: float = 8.0, top: int = 6, floor: float = 0.5) -> DataFrame:
    """term_id, lemma, df, rate, lift, score, rank.

    ``sets``: segment_id with a ``lemma`` each, or with ``lemmas`` in a
    list (see ``lemma_lists``).  The corpus rate leaves out the term's own
    segments and counts ``floor`` documents at least; score = rate * ln(lift).
    """
    own = term_segments.select("term_id", "segment_id").distinct()
    n_term = own.groupBy("term_id").agg(F.count("*").alias("n_term"))
    lists = sets if "lemmas" in sets.columns else _lists(sets, "segment_id")
    terms = own.groupBy("segment_id").agg(F.collect_list("term_id").alias("terms"))
    # a segment's lemmas, and null for the segment itself, meet its terms, or null if it has none; the first one counts for the corpus
    told = F.when(F.col("opens") & F.col("segment_id").isNotNull(), F.concat("lemmas", F.array(F.lit(None).cast("string")))).otherwise(F.col("lemmas"))
    rows = lists.join(terms, "segment_id", "left").select(told.alias("lemmas"), F.posexplode_outer("terms").alias("at", "term_id"))
    rows = rows.select(F.explode("lemmas").alias("lemma"), "term_id", (F.coalesce("at", F.lit(0)) == 0).cast("bigint").alias("first"))
    counts = computed_once(rows.groupBy("lemma", "term_id").agg(F.count("*").alias("df"), F.sum("first").alias("first")))
    total = counts.filter("lemma IS NULL").agg(F.sum("first").alias("n_all"))
    df_all = counts.filter("lemma IS NOT NULL").groupBy("lemma").agg(F.sum("first").alias("df_all")).filter(F.col("df_all") >= least_df)
    k = counts.filter((F.col("df") >= least_df) & F.col("term_id").isNotNull()).drop("first")
    scored = k.join(n_term, "term_id").join(df_all, "lemma").crossJoin(F.broadcast(total))  # one row
    rate = F.col("df") / F.col("n_term")
    rest = F.col("n_all") - F.col("n_term")
    corpus = F.greatest(F.col("df_all") - F.col("df"), F.lit(floor)) / F.greatest(rest, F.lit(1))
    scored = scored.withColumn("rate", rate).withColumn("lift", rate / corpus).withColumn("score", F.col("rate") * F.ln("lift"))
    kept = scored.filter((F.col("df") >= least_df) & (F.col("rate") >= least_rate) & (F.col("lift") >= least_lift))
    w = Window.partitionBy("term_id").orderBy(F.col("score").desc(), "lemma")
    return kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select("term_id", "lemma", "df", "rate", "lift", "score", "rank")


def polysemous(found: DataFrame) -> DataFrame:
    """Terms with two clusters of renderings or more."""
    return found.groupBy("term_id").agg(F.count("*").alias("clusters")).filter("clusters >= 2")


def top_cues(texts: DataFrame, stop: list[str], n: int) -> DataFrame:
    """Most frequent words of three letters or more, once per text, ties by word."""
    sets = lemma_sets(texts, "segment_id", "content", 3).filter(~F.col("lemma").isin(stop))
    return document_frequency(sets).orderBy(F.col("df").desc(), "lemma").limit(n)


def gap_lemmas(texts: DataFrame, lemmas: DataFrame, known: DataFrame, ignored: DataFrame | None = None, floor: int = 3, ceiling: float = 0.40, least: int = 4, context: int = 300) -> DataFrame:
    """lemma, df, content, czech, english of lemmas that no term covers, between a floor and a share of all segments (empty ones counted).

    ``texts``: segment_id, content, czech, english.  ``lemmas``: surface,
    candidate (0, 1, ...), lemma; a word without a candidate stands for itself.
    A word any of whose candidates is known, whatever the case, is covered;
    another counts for its first candidate, once a segment.  The contexts are
    those of the first segment that has one.  Distinct words are looked up
    once, and only the texts that are shown are read again.

    Words are counted where they stand, so that only the vocabulary is shuffled.
    A segment counts once for a lemma: words that share their lemma with another
    word are counted by segment in a second reading, and what an id that several
    rows have counts too much is taken off.
    """
    columns, n = ("content", "czech", "english"), F.col("segment_id")
    # a projection of its own: above the explode, flags would be told anew for each word
    flagged = texts.select("segment_id", "content", *(F.coalesce(F.col(c) != "", F.lit(False)).alias(f"_{c}") for c in columns[1:]))
    tokens = flagged.select("segment_id", "_czech", "_english", F.explode(F.array_distinct(F.transform(ascii_tokens(F.coalesce("content", F.lit(""))), F.lower))).alias("token"))
    each = computed_once(tokens.groupBy("token").agg(F.count("*").alias("n"), F.min(n).alias("at_content"), F.min(F.when(F.col("_czech"), n)).alias("at_czech"), F.min(F.when(F.col("_english"), n)).alias("at_english")))
    covered = known.select(F.lower("lemma").alias("lemma")).distinct()
    looked = each.select("token").join(lemmas.select(F.lower("surface").alias("token"), "candidate", F.col("lemma").alias("_l")), "token", "left")
    looked = looked.select("token", F.coalesce("candidate", F.lit(0)).alias("candidate"), F.coalesce("_l", "token").alias("_l"))
    hit = looked.select("token", F.lower("_l").alias("lemma")).join(covered, "lemma", "left_semi").select("token").distinct()
    first = looked.groupBy("token").agg(canonical_lemma(F.min_by("_l", "candidate")).alias("lemma")).join(hit, "token", "left_anti")
    first = first.filter(F.length("lemma") >= least).join(covered, "lemma", "left_anti")
    if ignored is not None:
        first = first.join(ignored.select("lemma").distinct(), "lemma", "left_anti")
    repeated = computed_once(texts.groupBy("segment_id").agg(F.count("*").alias("_m")).filter("_m > 1").select(n.alias("_id")))
    if not repeated.isEmpty():
        twice = tokens.join(repeated, n.eqNullSafe(F.col("_id")), "left_semi").groupBy("token", "segment_id").agg((F.count("*") - 1).alias("_m"))
        each = each.join(twice.groupBy("token").agg(F.sum("_m").alias("_m")), "token", "left").withColumn("n", F.col("n") - F.coalesce("_m", F.lit(0)))
    named = computed_once(first.join(each, "token"))
    counts = named.groupBy("lemma").agg(F.count("*").alias("_words"), F.sum("n").alias("df"), *(F.min(f"at_{c}").alias(f"at_{c}") for c in columns))
    shared = computed_once(named.join(counts.filter((F.col("_words") > 1) & (F.col("df") >= floor)).select("lemma"), "lemma", "left_semi").select("token", "lemma"))
    if (n_shared := shared.count()) > 0:
        own = F.broadcast(shared) if n_shared <= MOST_SHARED else shared
        seen = tokens.select("segment_id", "token").join(own, "token").select("segment_id", "lemma").distinct()
        counts = counts.join(seen.groupBy("lemma").agg(F.count("*").alias("_df")), "lemma", "left").withColumn("df", F.coalesce("_df", "df"))
    counts = counts.select("lemma", "df", *(f"at_{c}" for c in columns))
    total = texts.agg(F.count("*").alias("n_all"))
    found = computed_once(counts.join(F.broadcast(total), (F.col("df") >= floor) & (F.col("df") <= F.floor(F.col("n_all") * ceiling))).drop("n_all"))  # one row
    asked = found.select(F.explode(F.array(*(f"at_{c}" for c in columns))).alias("segment_id")).filter("segment_id IS NOT NULL").distinct()
    cut = texts.select("segment_id", *(F.substring(c, 1, context).alias(c) for c in columns))  # before the join, so that whole texts stay where they are
    heads = computed_once(cut.join(asked, "segment_id", "left_semi").groupBy("segment_id").agg(*(F.first(c).alias(c) for c in columns)))
    for c in columns:
        found = found.join(heads.select(F.col("segment_id").alias(f"at_{c}"), c), f"at_{c}", "left")
    return found.select("lemma", "df", *columns)


def sample_contexts(members: DataFrame, kept: int = 12, used: int = 3) -> DataFrame:
    """First ids of each cluster: ``kept`` are held, ``used`` shown."""
    w = Window.partitionBy("term_id", "lemma").orderBy("segment_id")
    return members.withColumn("at", F.row_number().over(w)).filter(F.col("at") <= min(kept, used)).drop("at")


def drop_known(proposed: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """First proposal of each key, compared without case, that is not known yet."""
    own = proposed
    for k in keys:
        own = own.withColumn(f"_{k}", F.lower(k))
    for k in keys:
        own = own.join(known.select(F.lower(k).alias(f"_{k}")).distinct(), f"_{k}", "left_anti")
        own = own.withColumn("_at", F.row_number().over(Window.partitionBy(f"_{k}").orderBy("position"))).filter("_at = 1").drop("_at")
    return own.drop(*(f"_{k}" for k in keys))
