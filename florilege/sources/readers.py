"""Readers of text sources: records, sheets, logs, glossaries, marked-up texts."""

from __future__ import annotations

import html.parser
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from florilege.functions.text import outside_parentheses, upper_share

#: What a sheet holds where a row is approved, after trimming.
TRUE_WORDS = ("TRUE", "True", "true", "1", "YES", "yes")
#: Parts, and the abbreviations of titles and of lines before a translated element.
PARTS = ("I-II", "II-II", "III", "I")
TITLE_WORDS = {"question": "q.", "article": "a.", "preamble": "pr.", "arg": "arg.", "sed_contra": "s. c.", "respondeo": "co.", "reply": "ad"}
LINE_WORDS = {"question": "ot.", "article": "čl.", "preamble": "pr.", "arg": "arg.", "sed_contra": "protiarg.", "respondeo": "odp.", "reply": "k"}
KINDS = ("preamble", "arg", "sed_contra", "respondeo", "reply")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder, its local timestamps read as UTC instants."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"})


def jsonl(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Last record of each key; blank lines are skipped, a line that is no object is an error that names its file and line.

    Files follow each other by path, lines as they stand, however files are cut
    and dealt to tasks: a line's number is its place in its block behind the
    lines of the blocks before it, which are counted.
    """
    meta = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", meta.alias("at"))
    record = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE"})
    parsed = lines.select("at", (F.trim("value") == "").alias("blank"), record.alias("r"))
    bad = ~F.col("blank") & (F.col("r").isNull() | F.col("r._corrupt_record").isNotNull())
    names = [f.name for f in parsed.schema["r"].dataType if f.name != "_corrupt_record"]
    good = parsed.filter(~F.col("blank") & ~bad).select("at", F.struct(*(F.col(f"r.{c}").alias(c) for c in names)).alias("r"))
    latest = good.groupBy(*(F.col(f"r.{k}").alias(k) for k in keys)).agg(F.max_by("r", "at").alias("r")).select("r.*")

    blocks = parsed.groupBy("at.file", "at.block").agg(F.count("*").alias("n"), F.min("at.line").alias("first"), F.min(F.when(bad, F.col("at.line"))).alias("bad"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block of a file
    number = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("bad") - F.col("first") + 1
    told = blocks.withColumn("number", number).filter("bad IS NOT NULL")
    broken = told.agg(F.min(F.struct("file", "number")).alias("b")).filter("b IS NOT NULL")
    error = F.raise_error(F.format_string("%s, line %d: no JSON object", F.col("b.file"), F.col("b.number")))
    return latest.unionByName(broken.select(*(error.cast(latest.schema[c].dataType).alias(c) for c in latest.columns)))


def sample_ids(spark: SparkSession, path: str) -> DataFrame:
    """segment_id of ``{"segments": [{"segment_id": n}, ...]}``."""
    schema = "segments array<struct<segment_id:bigint>>"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("segments.segment_id").alias("segment_id"))


def approvals(rows: DataFrame) -> DataFrame:
    """Approved rows of a sheet, as ``imports.import_approvals`` takes them.

    ``rows``: texts of place, approved, category, lemma, surface, label,
    content, sense_id, version.  A row without sense id is a new term's; with
    neither id nor lemma, or with an id that is no number, it goes.  A version
    that is no number is null.
    """
    cell = {c: F.trim(F.coalesce(c, F.lit(""))) for c in ("approved", "category", "lemma", "surface", "label", "content", "sense_id", "version")}
    own = rows.select("place", *(x.alias(c) for c, x in cell.items())).filter(F.col("approved").isin(*TRUE_WORDS)).drop("approved")
    number = F.col("sense_id").try_cast("long")
    kept = own.filter(F.when(F.col("sense_id") == "", F.col("lemma") != "").otherwise(number.isNotNull()))
    return kept.withColumn("sense_id", number).withColumn("version", F.col("version").try_cast("long"))


def count_lines(spark: SparkSession, path: str, prefix: str = "[ANOMALY]") -> int:
    return spark.read.text(path).filter(F.col("value").startswith(prefix)).count()


def _address(text: Column, words: dict[str, str], whole: bool) -> Column:
    """Struct of part, question, article, kind and number of an address made of ``words``; null for other texts.

    One pattern finds the pieces; which of them go together is said of each
    kind: a preamble has no article, all else has one; an objection and a reply
    have a number (a reply to all has the word for objections in its place).
    """
    said = lambda w: r"\s*".join(w.replace(".", r"\.").split()) + (r"\s*" if w.endswith(".") else r"\s+")
    kinds = "|".join(f"({said(words[k])})" for k in KINDS)
    pattern = rf"^\s*({'|'.join(PARTS)})\s+{said(words['question'])}(\d+)\s+(?:{said(words['article'])}(\d+)\s+)?(?:{kinds})(\d+|{said(words['arg'])})?" + (r"\s*$" if whole else "")
    # behind a kind that may end the text its white space may be missing
    group = lambda k: F.regexp_extract(F.concat(text, F.lit(" ")), pattern, k)
    part, question, article, rest = F.replace(group(1), F.lit("-"), F.lit("_")), group(2), group(3), group(4 + len(KINDS))
    kind = F.coalesce(*(F.when(group(4 + k) != "", F.lit(name)) for k, name in enumerate(KINDS)))
    number = F.when(rest.rlike(r"^\d+$"), rest)
    fits = (kind == "preamble") == (article == "")
    if whole:
        fits &= F.when(kind.isin("preamble", "respondeo"), rest == "").when(kind == "arg", number.isNotNull()).when(kind == "sed_contra", (rest == "") | number.isNotNull()).otherwise(rest != "")
        number = F.when((kind == "reply") & (rest != "") & number.isNull(), F.lit("0")).otherwise(number)
    else:
        fits &= F.when(kind.isin("arg", "reply"), number.isNotNull()).otherwise(True)
    numbered = F.when(kind.isin("arg", "reply"), number)
    return F.when((part != "") & fits, F.struct(part.alias("part"), question.alias("question"), article.alias("article"), kind.alias("kind"), numbered.alias("number")))


def _element_path(a: Column) -> Column:
    article = F.when(a["article"] != "", F.concat(F.lit(".a"), a["article"])).otherwise(F.lit(""))
    return F.concat(a["part"], F.lit(".q"), a["question"], article, F.lit("."), a["kind"], F.coalesce(a["number"], F.lit("")))


def parse_locator(title: Column) -> Column:
    """Struct of path and element type of a title; null for titles that are none.

    A preamble stands below its question, all else below an article.  Several
    ``s. c.`` of an article share one path; ``ad arg.``, the reply to all
    objections, has number 0.
    """
    a = _address(title, TITLE_WORDS, True)
    return F.when(a.isNotNull(), F.struct(_element_path(a).alias("path"), a["kind"].alias("element_type")))


def parse_coordinate(line: Column) -> Column:
    """Path of a line that begins with a coordinate; null for other lines."""
    return _element_path(_address(line, LINE_WORDS, False))


def preferred_source(wanted: DataFrame, files: DataFrame, keys: list[str], listed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """For each key the file of the best source that has one, and the gaps.

    ``files``: keys, source, rank (best first).  A gap is a key without a file
    (``none``), or one that is ``listed`` for the best source and had to fall
    back (``fallback``).
    """
    best = files.groupBy(*keys).agg(F.min_by(F.struct("source", "rank"), F.struct("rank", "source")).alias("b")).select(*keys, "b.source", "b.rank")
    found = wanted.select(*keys).distinct().join(best, keys, "left")
    gaps = found.filter("source is null").select(*keys, F.lit("none").alias("gap"))
    if listed is not None:
        first = files.agg(F.min("rank").alias("first"))
        back = found.filter("source is not null").join(listed.select(*keys).distinct(), keys, "left_semi").join(F.broadcast(first), F.col("rank") > F.col("first"), "left_semi")
        gaps = gaps.union(back.select(*keys, F.lit("fallback").alias("gap")))
    return found.filter("source is not null").select(*keys, "source"), gaps


def json_or(spark: SparkSession, path: str, schema: str, default: tuple) -> DataFrame:
    """The one record of a JSON file, or the default where there is no file."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    if own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own):
        return spark.read.schema(schema).json(path, multiLine=True)
    return spark.createDataFrame([default], schema)


def carry_forward(lines: DataFrame, file: str, at: str, tag: str, text: str) -> DataFrame:
    """Text of each tag: lines belong to the last tag before them, a tag that comes again wins with its last run."""
    w = Window.partitionBy(file).orderBy(at)
    own = lines.withColumn("run", F.count(tag).over(w)).withColumn("own", F.last(tag, True).over(w)).filter("own is not null")
    runs = own.filter(F.col(tag).isNull() & (F.trim(text) != "")).groupBy(file, "run", "own").agg(F.array_sort(F.collect_list(F.struct(at, text))).alias("parts"))
    runs = runs.select(file, "run", F.col("own").alias(tag), F.array_join(F.transform("parts", lambda p: F.trim(p[text])), " ").alias(text))
    return runs.groupBy(file, tag).agg(F.max_by(text, "run").alias(text))


def headings(lines: DataFrame, text: str, least: float = 0.8) -> DataFrame:
    return lines.filter(upper_share(F.col(text)) >= least)


def glossary(lines: DataFrame, at: str = "at", text: str = "value") -> DataFrame:
    """at, lemma, senses of ``lemma, lemma – senses`` lines; a lemma that comes again takes its later senses at its first place."""
    parts = F.split(F.col(text), r"\s+[–—-]\s+", 2)
    own = lines.filter(F.size(parts) == 2).select(F.col(at), F.explode(F.split(F.get(parts, F.lit(0)), r"\s*,\s*")).alias("lemma"), F.trim(F.get(parts, F.lit(1))).alias("senses"), F.col(at).alias("_o"))
    own = own.withColumn("lemma", F.trim("lemma")).filter("lemma <> ''")
    return own.groupBy("lemma").agg(F.min(at).alias(at), F.max_by("senses", "_o").alias("senses"))


def senses(df: DataFrame, text: str = "senses") -> DataFrame:
    """position, context, content of each sense: comma-separated, ``(context: other)`` a sense of its own."""
    each = df.select(*(c for c in df.columns if c != text), F.posexplode(outside_parentheses(F.col(text))).alias("position", "s")).filter("s <> ''")
    context = F.regexp_extract("s", r"\(([^:)]*):\s*([^)]*)\)", 1)
    return each.withColumn("context", F.when(context != "", F.trim(context))).withColumn("content", F.trim(F.regexp_replace("s", r"\s*\([^)]*\)", ""))).drop("s")


class _Elements(html.parser.HTMLParser):
    """Text of titled paragraphs; reference spans are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list[str]] = []
        self.open = self.hidden = 0

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag == "p":
            self.open = 0
            if own.get("title"):
                self.found.append([own["title"], ""])
                self.open = 1
        elif tag == "span" and (self.hidden or "ref" in (own.get("class") or "").split()):
            self.hidden += 1

    def handle_endtag(self, tag):
        if tag == "p":
            self.open = 0
        elif tag == "span" and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if self.open and not self.hidden:
            self.found[-1][1] += data


def titled_paragraphs(pages: DataFrame, key: str, page: str) -> DataFrame:
    """key, at, title, text of titled paragraphs; pages without any are left out before they reach Python."""
    kind = pages.schema[key].dataType.simpleString()

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, text in zip(frame[key], frame[page]):
                own = _Elements()
                own.feed(text)
                own.close()
                rows += [(k, at, title, " ".join(said.split())) for at, (title, said) in enumerate(own.found)]
            yield pd.DataFrame(rows, columns=["key", "at", "title", "text"])

    held = pages.select(key, page).filter(F.col(page).isNotNull() & F.contains(F.lower(page), F.lit("title=")))
    return held.mapInPandas(parse, f"key {kind}, at int, title string, text string").withColumnRenamed("key", key)


def elements(pages: DataFrame, key: str, page: str) -> DataFrame:
    """key, path, element_type, text; an element that comes again is joined in document order."""
    own = titled_paragraphs(pages, key, page).withColumn("l", parse_locator(F.col("title"))).filter("l is not null")
    own = own.groupBy(key, "l.path", "l.element_type").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("t"))
    return own.select(key, "path", "element_type", F.array_join(F.transform("t", lambda x: x["text"]), " ").alias("text"))


def page_blocks(pages: DataFrame, key: str, page: str) -> DataFrame:
    """key, at, level, text of headings (level 1 to 6) and paragraphs (level null) of pages, in document order.

    A block reaches to the next tag of its kinds, closed or not; tags within it
    go, white space is one space, character references stay.  Blocks without text
    are left out.
    """
    found = F.regexp_extract_all(F.regexp_replace(page, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1>", ""), F.lit(r"(?is)<(?:h[1-6]|p)\b[^>]*>(?:(?!</?(?:h[1-6]|p)\b).)*"), F.lit(0))
    each = pages.filter(F.col(page).isNotNull()).select(key, F.posexplode(found).alias("at", "b"))
    level = F.regexp_extract("b", r"(?i)^<h([1-6])", 1)
    text = F.trim(F.regexp_replace(F.regexp_replace("b", r"(?s)<[^>]*>", " "), r"\s+", " "))
    return each.select(key, "at", F.when(level != "", level.cast("int")).alias("level"), text.alias("text")).filter("text <> ''")


def marked_elements(pages: DataFrame, key: str, page: str, level: int = 1) -> DataFrame:
    """key, heading (its place), kind, number, text of elements that markers open under headings of ``level`` or above.

    A heading's range ends at the next one; a paragraph falls into the last
    range opened before it, and into the last element opened in that range.
    What stands before the first heading or marker belongs to none.
    """
    blocks = page_blocks(pages, key, page)
    order = Window.partitionBy(key).orderBy("at")
    opens = F.col("level").isNotNull() & (F.col("level") <= level)
    ranged = blocks.withColumn("heading", F.last(F.when(opens, F.col("at")), True).over(order)).filter(F.col("heading").isNotNull() & F.col("level").isNull())
    within = Window.partitionBy(key, "heading").orderBy("at")
    marked = ranged.withColumn("m", marker_type(F.col("text"))).withColumn("first", F.last(F.when(F.col("m").isNotNull(), F.col("at")), True).over(within)).filter("first IS NOT NULL")
    own = marked.groupBy(key, "heading", "first").agg(F.min_by("m", "at").alias("m"), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("t"))
    return own.select(key, "heading", F.col("first").alias("at"), "m.kind", "m.number", F.array_join(F.transform("t", lambda x: x["text"]), " ").alias("text"))


def marker_type(text: Column) -> Column:
    """Kind and number of a paragraph by the words that it begins with."""
    objection, reply = F.regexp_extract(text, r"^Objection (\d+)\.", 1), F.regexp_extract(text, r"^Reply to Objection (\d+)\.", 1)
    kind = F.when(reply != "", "reply").when(objection != "", "arg").when(text.startswith("On the contrary,"), "sed_contra").when(text.startswith("I answer that,"), "respondeo")
    return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), F.coalesce(F.nullif(reply, F.lit("")), F.nullif(objection, F.lit(""))).cast("int").alias("number")))
