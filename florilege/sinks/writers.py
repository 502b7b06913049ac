"""Writers: sheets, exchange files, records, reports, digests."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.operators.navigation import numbered


def csv_sheet(df: DataFrame, path: str, columns: list[str]) -> None:
    """One CSV with a fixed header: arrays are joined with ``|``, nulls are empty; no rows give the header alone."""
    kinds = dict(df.dtypes)
    shown = [F.coalesce(F.array_join(c, "|") if kinds[c].startswith("array") else F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    df.select(*shown).coalesce(1).write.mode("overwrite").csv(path, header=True, emptyValue="")


def _xml(c) -> F.Column:
    return F.replace(F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def exchange_lines(df: DataFrame, source: str, target: str) -> DataFrame:
    """pars, path, line: the lines of an exchange document per part, in order of path: a head (path null), the units, an end (path after all).

    Rows: pars, path, source, target, note (may be null).  No part is ever one
    row: a unit is a line, and a document is its part's lines.
    """
    unit_id = F.replace("path", F.lit("."), F.lit("_"))
    note = F.when(F.col("note").isNotNull(), F.concat(F.lit("<notes><note>"), _xml(F.col("note")), F.lit("</note></notes>"))).otherwise(F.lit(""))
    unit = F.concat(F.lit('<unit id="'), unit_id, F.lit('">'), note, F.lit("<segment><source>"), _xml(F.col("source")), F.lit("</source><target>"), _xml(F.col("target")), F.lit("</target></segment></unit>"))
    head = f'<xliff xmlns="urn:oasis:names:tc:xliff:document:2.0" version="2.0" srcLang="{source}" trgLang="{target}"><file id="'
    edge = F.explode(F.array(F.struct(F.lit(None).cast("string").alias("path"), F.concat(F.lit(head), "pars", F.lit('">')).alias("line")), F.struct(F.lit(AFTER_ALL).alias("path"), F.lit("</file></xliff>").alias("line"))))
    edges = df.select("pars").distinct().select("pars", edge.alias("e")).select("pars", "e.*")
    return df.select("pars", "path", unit.alias("line")).union(edges)


def exchange_documents(df: DataFrame, source: str, target: str) -> DataFrame:
    """The lines of ``exchange_lines`` in their documents: ``at``, a line's place (0: the head), and ``units`` of its document.

    Lines are numbered in ranges of the order of all documents; no window sees
    a document whole, and one row per document tells where it begins.
    """
    lines = numbered(exchange_lines(df, source, target), ["pars", "path"], "_n")
    each = lines.groupBy("pars").agg(F.min("_n").alias("_first"), (F.count("*") - 2).alias("units"))
    return lines.join(F.broadcast(each), "pars").select("pars", "path", (F.col("_n") - F.col("_first")).alias("at"), "units", "line")


#: Behind every path: paths are of letters, digits, points and underscores.
AFTER_ALL = "\uffff"


def write_exchange(df: DataFrame, folder: str, source: str, target: str) -> None:
    """``folder/pars=...`` holds the document of a part: its files in order of name, each line in its place."""
    lines = exchange_lines(df, source, target)
    lines.repartitionByRange("pars", "path").sortWithinPartitions("pars", "path").select("pars", "line").write.partitionBy("pars").text(folder)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file, in whatever store the path is in."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = own.getFileSystem(spark._jsc.hadoopConfiguration()).create(own, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def report(title: str, metrics: Iterable[DataFrame], most: int = 200) -> str:
    """Text of small metric tables, at most ``most`` lines of each: a report, not a result."""
    out = [f"# {title}"]
    for df in metrics:
        rows = df.limit(most + 1).collect()
        out.append(" | ".join(df.columns))
        out += [" | ".join("" if v is None else str(v) for v in r) for r in rows[:most]]
        out += [f"... more than {most} lines"] if len(rows) > most else []
    return "\n".join(out) + "\n"


def send_digests(digests: DataFrame, send: Callable[[str, list[str]], bool]) -> list[str]:
    """Users whose digest went out; only they may be marked as notified.  Users come one by one from an iterator."""
    sent, user, lines = [], None, []
    for r in digests.orderBy("user", "segment_id").toLocalIterator():
        if r.user != user and user is not None and send(user, lines):
            sent.append(user)
        if r.user != user:
            user, lines = r.user, []
        lines.append(f"{r.segment_id}: {r.n}")
    if user is not None and send(user, lines):
        sent.append(user)
    return sent
