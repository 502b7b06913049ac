"""Text expressions: normalisation, tokens, stems, counts, matching, records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Plain letters and the letters with marks that they stand for; what is in none (æ, œ, ø, ß) is dropped.
MARKED = {
    "a": "áäàâãå", "c": "čç", "d": "ď", "e": "éěèêë", "i": "íîïì", "l": "ĺľ", "n": "ňñ", "o": "óôöőòõ", "r": "řŕ", "s": "š", "t": "ť", "u": "úůüűùû", "y": "ýÿ", "z": "ž",
    "A": "ÁÄÀÂ", "C": "ČÇ", "D": "Ď", "E": "ÉĚÈÊË", "I": "ÍÎÏ", "L": "ĹĽ", "N": "ŇÑ", "O": "ÓÔÖŐ", "R": "ŘŔ", "S": "Š", "T": "Ť", "U": "ÚŮÜŰÙÛ", "Y": "Ý", "Z": "Ž",
}


def normal_space(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def canonical_lemma(x: Column) -> Column:
    """Lower case, without the number that tells homonyms apart."""
    return F.lower(F.regexp_replace(x, r"\d+$", ""))


#: Lower-case signs whose folded form is another, and that form, by Unicode's own tables.
_FOLDED = {c.lower(): c.casefold() for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)]) if c.casefold() != c.lower() and len(c.lower()) == 1}
_SINGLE = {c: f for c, f in _FOLDED.items() if len(f) == 1}
_LONGER = {c: f for c, f in _FOLDED.items() if len(f) > 1}


def casefold(x: Column) -> Column:
    """Case folded for comparison: as ``lower``, but a sharp s is two, a final sigma is a sigma, ligatures are their letters.

    Signs that fold to one are translated at once; texts with one of the few
    that fold to several are put together sign by sign.
    """
    table = F.create_map(*(F.lit(v) for pair in _LONGER.items() for v in pair))
    single = F.translate(F.lower(x), "".join(_SINGLE), "".join(_SINGLE.values()))
    longer = F.array_join(F.transform(F.split(single, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")
    return F.when(single.rlike("[" + "".join(_LONGER) + "]"), longer).otherwise(single)


def ascii_tokens(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit("[a-zA-Z]+"), F.lit(0))


def letter_tokens(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"[\p{L}]+"), F.lit(0))


def word_tokens(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"(?U)\w+"), F.lit(0))


def strip_marks(x: Column) -> Column:
    """Lower case, marks off, what is still not ASCII dropped."""
    plain = F.translate(x, "".join(MARKED.values()), "".join(p * len(marked) for p, marked in MARKED.items()))
    return F.lower(F.regexp_replace(plain, r"[^\x00-\x7F]", ""))


def escaped(x: Column) -> Column:
    """A column's text as a literal within a pattern."""
    return F.concat(F.lit("\\Q"), F.replace(x, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def holds_phrase(text: Column, phrase: Column) -> Column:
    """The phrase between word boundaries, both plain and normalised, its closing signs off."""
    own = F.regexp_replace(normal_space(strip_marks(phrase)), r"[.,;:!?]+$", "")
    return F.rlike(normal_space(strip_marks(text)), F.concat(F.lit("\\b"), escaped(own), F.lit("\\b")))


def stem(x: Column) -> Column:
    """-us or -en off words of five letters and more, else closing vowels; the word itself if under three letters are left."""
    cut = F.when((F.length(x) >= 5) & x.rlike("(us|en)$"), F.substring(x, F.lit(1), F.length(x) - 2)).otherwise(F.regexp_replace(x, "[aeiouy]+$", ""))
    return F.when(F.length(cut) < 3, x).otherwise(cut)


def sentences(x: Column) -> Column:
    return F.greatest(F.size(F.regexp_extract_all(x, F.lit(r"[.!?]+(\s|$)"), F.lit(0))), F.lit(1))


def rounded(x: Column, places: int) -> Column:
    """Rounded as SQL engines do a double: the scaled value itself goes to the next whole number, not the number that its shortest digits show."""
    return F.round(x * F.lit(10.0**places), 0) / F.lit(10.0**places)


def length_ratio(after: Column, before: Column) -> Column:
    return F.when(F.length(before) == 0, F.lit(1.0)).otherwise(rounded(F.try_divide(F.length(after), F.length(before)), 4))


def upper_share(x: Column) -> Column:
    """Upper-case share of a text's letters; null without letters."""
    return F.try_divide(F.length(F.regexp_replace(x, r"[^\p{Lu}]", "")), F.length(F.regexp_replace(x, r"[^\p{L}]", "")))


def percentage(part: Column, whole: Column) -> Column:
    """Of 100, to one place: multiplied before it is divided, so that 63.75 is not 63.7499...; 0 without a whole."""
    return F.coalesce(rounded(F.try_divide(F.lit(100.0) * part, whole), 1), F.lit(0.0))


def outside_parentheses(x: Column) -> Column:
    """Split at commas that stand outside parentheses; every other sign is kept, parts are trimmed.

    A fold over the signs counts how deep they stand: an unclosed parenthesis
    reaches to the end, one that closes nothing is a sign like any other.
    """
    begin = F.struct(F.lit(0).alias("depth"), F.array(F.lit("")).alias("parts"))
    last = lambda acc: F.element_at(acc["parts"], -1)

    def add(acc: Column, sign: Column) -> Column:
        depth = acc["depth"] + F.when(sign == "(", 1).when((sign == ")") & (acc["depth"] > 0), -1).otherwise(0)
        cut = (sign == ",") & (acc["depth"] == 0)
        longer = F.concat(F.slice(acc["parts"], F.lit(1), F.size(acc["parts"]) - 1), F.array(F.concat(last(acc), sign)))
        return F.struct(depth.alias("depth"), F.when(cut, F.concat(acc["parts"], F.array(F.lit("")))).otherwise(longer).alias("parts"))

    # what holds neither commas nor parentheses goes on as a whole: the fold's steps are runs, not signs
    runs = F.regexp_extract_all(x, F.lit(r"[(),]|[^(),]+"), F.lit(0))
    return F.transform(F.aggregate(runs, begin, add)["parts"], lambda p: F.trim(p))


def unfence(x: Column) -> Column:
    """Content of a code fence, or the text itself."""
    return F.regexp_replace(F.regexp_replace(F.trim(x), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", "")


#: Categories that a model may name.
CATEGORIES = ("term", "name", "formula", "prose")


def model_entries(x: Column, asked: Column, text: str = "slovak") -> Column:
    """Map of lemma to (category, content) of a model's JSON answer, fenced or not; null for what is no object.

    An entry is an object with ``text`` and perhaps a category, or the text
    alone.  Lemmas that weren't ``asked`` (an array), entries without text and
    other categories than ``CATEGORIES`` go.
    """
    bare = F.trim(F.replace(F.regexp_replace(x, r"```(?:json)?\s*", ""), F.lit("```"), F.lit("")))
    given = F.map_filter(F.from_json(bare, "map<string,string>"), lambda k, v: F.array_contains(asked, k) & v.isNotNull())

    def entry(v: Column) -> Column:
        inner = v.startswith("{")
        category = F.lower(F.trim(F.get_json_object(v, "$.category")))
        content = F.trim(F.when(inner, F.get_json_object(v, f"$.{text}")).otherwise(v))
        return F.struct(F.when(inner & category.isin(*CATEGORIES), category).alias("category"), content.alias("content"))

    return F.map_filter(F.transform_values(given, lambda _, v: entry(v)), lambda _, e: F.coalesce(e["content"] != "", F.lit(False)))


def verdict(x: Column) -> Column:
    """Upper-case verdict: of the tag if there is one, else of the last line that names one."""
    tag = F.upper(F.trim(F.regexp_extract(x, r"(?is)<verdict>(.*?)</verdict>", 1)))
    lines = F.filter(F.transform(F.split(x, "\n"), lambda s: F.upper(F.regexp_extract(s, r"(?i)\b(pass|revise|fail)\b", 1))), lambda s: s != "")
    return F.when(tag != "", tag).otherwise(F.try_element_at(lines, F.lit(-1)))


def json_field(x: Column, field: str) -> Column:
    """A field of a JSON object as text; null for anything else."""
    return F.get_json_object(x, f"$.{field}")
