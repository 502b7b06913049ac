"""Stratified sample with quotas per category and part, one per question first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


MOST_PARTS = 10_000


def categories(rows: DataFrame) -> DataFrame:
    """``category`` by counts of formulas and approved hits; rows in between have none and go."""
    category = F.when(F.col("formulas") >= 8, "formula").when(F.col("approved") >= 5, "rich").when(F.col("approved") <= 2, "plain")
    return rows.withColumn("category", category).filter("category is not null")


def quotas(total: int, shares: dict[str, float], parts: list[str]) -> list[tuple[str, str, int]]:
    """Rows per category and part; the last category takes the rounding, first parts the remainders."""
    names, left, out = list(shares), total, []
    for k, name in enumerate(names):
        n = left if k == len(names) - 1 else int(total * shares[name])
        left -= n
        base, more = divmod(n, max(1, len(parts)))
        out += [(name, p, base + (i < more)) for i, p in enumerate(parts)]
    return out


def stratified(rows: DataFrame, total: int, shares: dict[str, float], seed: int, excluded: list[str] = ()) -> DataFrame:
    """A sample of ``rows`` (segment_id, pars, question_path, category).

    The order is that of a seeded hash.  Within a quota, first rows of a
    question come before any second; what a quota lacks is filled from its
    category.  Quotas are few; rows are never gathered.
    """
    pool = rows.filter(~F.col("question_path").isin(list(excluded))) if excluded else rows
    pool = pool.withColumn("rnd", F.xxhash64(F.lit(seed), "segment_id"))
    parts = [r.pars for r in pool.select("pars").distinct().orderBy("pars").limit(MOST_PARTS + 1).collect()]
    if len(parts) > MOST_PARTS:
        raise ValueError(f"more than {MOST_PARTS} parts: quotas are held by the driver")
    wanted = F.broadcast(rows.sparkSession.createDataFrame(quotas(total, shares, parts), "category string, pars string, quota int"))
    # of a part no more than its quota and the whole sample can be needed: ranks are cut at that before any shuffle
    most = total + max(q for _, _, q in quotas(total, shares, parts)) if parts else 0
    columns = ["segment_id", "pars", "question_path", "category", "rnd"]
    first = pool.groupBy("category", "question_path").agg(F.min(F.struct("rnd", "segment_id", "pars")).alias("f")).select("f.segment_id", "f.pars", "question_path", "category", "f.rnd")
    per_part = Window.partitionBy("category", "pars").orderBy("rnd", "segment_id")
    cut = lambda d, n, later: d.select(*columns, F.lit(later).alias("later"), F.row_number().over(per_part).alias("at")).filter(F.col("at") <= n).drop("at")
    # the first rows of questions are among all rows too: twice as many of these leave enough others
    few = cut(first, most, False).union(cut(pool, 2 * most, True)).groupBy(*columns).agg(F.min("later").alias("later"))
    order = ["later", "rnd", "segment_id"]
    pool = few.withColumn("at", F.row_number().over(Window.partitionBy("category", "pars").orderBy(*order))).join(wanted, ["category", "pars"])
    pool = pool.withColumn("in_quota", F.col("at") <= F.col("quota"))
    whole = wanted.groupBy("category").agg(F.sum("quota").alias("whole"))
    pool = pool.withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy(~F.col("in_quota"), *order)))
    return pool.join(F.broadcast(whole), "category").filter("place <= whole").select("segment_id", "pars", "question_path", "category")
