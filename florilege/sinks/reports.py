"""Reports of runs as text, from small metric tables; and their records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.operators import rollup
from florilege.sinks.writers import report


def _share(part: int, whole: int) -> str:
    return f"{part}/{whole} ({100 * part / whole if whole else 0.0:.1f}%)"


def coverage_report(segments: DataFrame, texts: DataFrame, languages: list[str], usage: DataFrame, shown: int = 20) -> str:
    """Coverage of each language with the first missing ids, usages by confidence, characters by language."""
    lines = ["# coverage"]
    for lang in languages:
        r = rollup.coverage(segments, texts, lang).first()
        first = [x.segment_id for x in rollup.uncovered(segments, texts, lang).orderBy("segment_id").limit(shown).collect()]
        lines.append(f"- {lang}: {_share(r['with'], r['total'])}; first missing: {', '.join(map(str, first)) or 'none'}")
    by = usage.groupBy("confidence").agg(F.count("*").alias("n")).orderBy("confidence")
    return "\n".join(lines) + "\n" + report("usages by confidence", [by]) + report("characters by language", [rollup.text_volume(texts).orderBy("lang")])


def production_report(rows: DataFrame, cost_usd: float) -> str:
    """Segments of a run by status, average iterations, cost in total and per segment."""
    r = rows.agg(F.count("*").alias("n"), F.round(F.avg("iterations"), 3).alias("iterations")).first()
    each = cost_usd / r.n if r.n else 0.0
    by = rows.groupBy("status").agg(F.count("*").alias("n")).orderBy("status")
    return report("production", [by]) + f"- segments: {r.n}\n- average iterations: {r.iterations or 0.0}\n- cost: ${cost_usd:.4f} (${each:.6f} a segment)\n"


def triage_report(notes: DataFrame, most: int = 200) -> str:
    """What people must look at: path, iteration, feedback, in order of path."""
    return report("needs a person", [notes.select("path", "iteration", "feedback").orderBy("path", "iteration")], most)


def pilot_report(rows: DataFrame, corpus_chars: int, cost_usd: float) -> str:
    """Rates of a pilot by element type, and what the corpus would cost at its price per character."""
    r = rows.agg(F.count("*").alias("n"), F.count_if(F.col("status") == "needs_human").alias("human"), F.sum("chars").alias("chars")).first()
    by = rows.groupBy("element_type").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "needs_human").alias("needs_human"), F.round(F.avg("iterations"), 3).alias("iterations")).orderBy("element_type")
    price = cost_usd / r.chars if r.chars else 0.0
    return report("pilot", [by]) + f"- needs a person: {_share(r.human, r.n)}\n- corpus at this price: ${price * corpus_chars:.2f}\n"


def polish_report(rows: DataFrame) -> str:
    """Polished texts by outcome of the guards (ok), and the words that were lost most often."""
    r = rows.agg(F.count("*").alias("n"), F.count_if("ok").alias("ok")).first()
    lost = rows.select(F.explode("lost").alias("word")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "word")
    return f"# polish\n- guards passed: {_share(r.ok, r.n)}\n" + report("lost words", [lost], 20)


def comparison_report(rows: DataFrame, a: int, b: int) -> str:
    """Two runs side by side: summaries, changes of status, segments whose status flipped."""
    summary = rollup.run_summary(rows.select("run_id").distinct().filter(F.col("run_id").isin(a, b)), rows).orderBy("run_id")
    counts = rows.groupBy("run_id", "status").agg(F.count("*").alias("n"))
    deltas = rollup.compare_runs(counts, "status", a, b).orderBy("status")
    return report(f"run {a} and run {b}", [summary, deltas]) + report("flips", [rollup.flips(rows, a, b).orderBy("segment_id")])


def save_record(spark: SparkSession, record: dict, schema: str, path: str) -> None:
    """One JSON record, in place of an older one."""
    names = [f.split()[0] for f in schema.split(", ")]
    spark.createDataFrame([tuple(record.get(n) for n in names)], schema).coalesce(1).write.mode("overwrite").json(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Rows of a run into the table of all runs: one write, all or nothing."""
    df.write.mode("append").parquet(path)
