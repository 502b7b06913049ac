"""Choice among phrases' places, dictionary look-up, evidence votes, overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.functions.text import ascii_tokens, letter_tokens
from florilege.store import computed_once


def leftmost_longest(spans: DataFrame, key: str = "segment_id") -> DataFrame:
    """Greedy choice without overlap: by start, then longest; a fold over the spans of one text."""
    own = F.array_sort(F.collect_set(F.struct("start", (-F.col("length")).alias("minus"), "phrase_id")))
    begin = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,minus:int,phrase_id:bigint>>").alias("kept"))

    def add(acc: Column, x: Column) -> Column:
        return F.when(x["start"] >= acc["end"], F.struct((x["start"] - x["minus"]).alias("end"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc)

    typed = spans.select(key, F.col("start").cast("int"), F.col("length").cast("int"), F.col("phrase_id").cast("bigint"))
    chosen = typed.groupBy(key).agg(own.alias("s")).select(key, F.explode(F.aggregate("s", begin, add)["kept"]).alias("x"))
    return chosen.select(key, "x.phrase_id", "x.start", (-F.col("x.minus")).alias("length"))


def lemma_matches(texts: DataFrame, lemmas: DataFrame, terms: DataFrame, key: str = "segment_id", text: str = "content") -> DataFrame:
    """key, token, term_id: of a token's candidate lemmas the first that is a term; tokens without lemma stand for themselves.

    ``lemmas``: surface, candidate (0, 1, ...), lemma.  Distinct tokens are looked up once.
    """
    tokens = texts.select(key, F.explode(F.array_distinct(F.transform(ascii_tokens(F.col(text)), F.lower))).alias("token"))
    return tokens.join(token_terms(tokens.select("token").distinct(), lemmas, terms), "token").select(key, "token", "term_id")


def token_terms(words: DataFrame, lemmas: DataFrame, terms: DataFrame) -> DataFrame:
    """token, term_id of those of the distinct ``words`` (token) that are a term by one of their candidate lemmas, the first such one."""
    looked = words.join(lemmas.withColumnRenamed("surface", "token"), "token", "left")
    looked = looked.select("token", F.coalesce("candidate", F.lit(0)).alias("candidate"), F.lower(F.coalesce("lemma", "token")).alias("lemma"))
    return looked.join(terms.select("term_id", F.lower("lemma").alias("lemma")), "lemma").groupBy("token").agg(F.min_by("term_id", F.struct("candidate", "term_id")).alias("term_id"))


def vote(candidates: DataFrame, senses: DataFrame, signals: DataFrame, strong: int = 20) -> DataFrame:
    """segment_id, term_id, sense_id, confidence.

    ``candidates``: segment_id, term_id.  ``signals``: segment_id, sense_id, rank.
    Decided (auto) if one sense alone has signals, one of them of rank
    ``strong`` or better, or if the term has one sense; else the primary sense
    (no label, else the first) is taken for review.
    """
    own = senses.groupBy("term_id").agg(F.count("*").alias("n"), F.min_by("sense_id", F.struct(F.col("label").isNotNull(), F.col("sense_id"))).alias("primary"))
    heard = signals.join(senses.select("sense_id", "term_id"), "sense_id").groupBy("segment_id", "term_id").agg(
        F.count_distinct("sense_id").alias("heard"), F.min("rank").alias("rank"), F.min("sense_id").alias("only")
    )
    joined = candidates.join(own, "term_id").join(heard, ["segment_id", "term_id"], "left")
    decided = (F.col("heard") == 1) & (F.col("rank") <= strong)
    sense = F.when((F.col("n") > 1) & F.coalesce(decided, F.lit(False)), F.col("only")).otherwise(F.col("primary"))
    return joined.select("segment_id", "term_id", sense.alias("sense_id"), F.when((F.col("n") == 1) | F.coalesce(decided, F.lit(False)), "auto").otherwise("needs_review").alias("confidence"))


def trigrams(text: Column) -> Column:
    """Distinct runs of three signs of a text, lower case, in one pass."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(.{3}))"), F.lit(1)))


def cue_signals(candidates: DataFrame, cues: DataFrame, texts: DataFrame, rank: int) -> DataFrame:
    """segment_id, sense_id, rank of cues (term_id, sense_id, cue) that the text of a segment holds for which their term is a candidate; case doesn't count.

    An inverted index of trigrams: a cue stands under the one of its trigrams
    that the fewest texts have, so that a frequent word doesn't bring all texts
    along; a text meets the cues that stand under its trigrams, and only then is
    looked at whole.  Cues of one or two signs are looked for in the texts of
    their candidates; empty ones are nowhere.  All this is done once for a cue,
    however many senses share it: senses come in where a text holds their cue.
    """
    own = cues.filter(F.length("cue") > 0).select("term_id", "sense_id", F.lower("cue").alias("cue")).distinct()
    words = computed_once(own.select("term_id", "cue").distinct())
    wanted = candidates.select("segment_id", "term_id").distinct()
    each = words.filter(F.length("cue") >= 3).select("cue").distinct().select("cue", F.explode(trigrams(F.col("cue"))).alias("gram"))
    asked = texts.join(candidates.select("segment_id").distinct(), "segment_id", "left_semi").select("segment_id", F.lower("content").alias("content"))
    grams = each.select("gram").distinct()
    placed = asked.select("segment_id", F.explode(trigrams(F.col("content"))).alias("gram")).join(grams, "gram", "left_semi")
    spread = placed.groupBy("gram").agg(F.count("*").alias("n"))
    key = each.join(spread, "gram", "left").groupBy("cue").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    met = placed.join(key, "gram").join(words, "cue").join(wanted, ["segment_id", "term_id"])
    short = words.filter(F.length("cue") < 3).join(wanted, "term_id")
    pairs = met.select("segment_id", "term_id", "cue").union(short.select("segment_id", "term_id", "cue"))
    held = pairs.join(asked, "segment_id").filter(F.contains("content", F.col("cue"))).select("segment_id", "term_id", "cue")
    return held.join(own, ["term_id", "cue"]).select("segment_id", "sense_id", F.lit(rank).alias("rank")).distinct()


def resolve(phrases: DataFrame, tokens: DataFrame, gaps: DataFrame) -> DataFrame:
    """One resolution per segment and term: phrase hits before token hits before gap terms."""
    staged = [x.select("segment_id", "term_id", F.lit(k).alias("stage")) for k, x in enumerate((phrases, tokens, gaps))]
    return staged[0].union(staged[1]).union(staged[2]).groupBy("segment_id", "term_id").agg(F.min("stage").alias("stage"))


def construction_suppressed(texts: DataFrame, verbs: list[str], forms: list[str], key: str = "segment_id", text: str = "content") -> DataFrame:
    """key, token of verbs that stand beside one of ``forms`` at all their places in a text."""
    words = F.transform(letter_tokens(F.col(text)), F.lower)
    placed = texts.select(key, words.alias("w")).select(key, "w", F.posexplode("w").alias("at", "token")).filter(F.col("token").isin(verbs))
    beside = F.coalesce(F.get("w", F.col("at") + 1).isin(forms), F.lit(False)) | F.coalesce(F.get("w", F.col("at") - 1).isin(forms), F.lit(False))
    return placed.groupBy(key, "token").agg(F.count_if(beside).alias("c"), F.count("*").alias("n")).filter("c >= n").select(key, "token")


def link_replies(rows: DataFrame, group: str, kind: str, number: str, key: str) -> DataFrame:
    """reply_to of each reply: the objection of its group with its number; 0 and unmatched numbers link to nothing."""
    arg = rows.filter(F.col(kind) == "arg").select(group, number, F.col(key).alias("reply_to"))
    replies = rows.filter(F.col(kind) == "reply")
    return replies.join(arg.filter(F.col(number) != 0), [group, number], "left")


def overlay(elements: DataFrame, base: DataFrame, key: str, on_missing: str = "log") -> tuple[DataFrame, DataFrame]:
    """Elements with their base row, and those without one; ``fail`` makes a miss an error, ``skip`` forgets it."""
    missing = elements.join(base.select(key), key, "left_anti")
    if on_missing == "fail" and not missing.isEmpty():
        raise LookupError(f"no base row for {missing.first()[key]!r}")
    return elements.join(base, key), missing.limit(0) if on_missing == "skip" else missing
