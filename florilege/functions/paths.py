"""Dotted hierarchy paths (``part.question.article.segment``) as expressions.

A path is a string; all predicates are equalities or prefixes on it, so that
they reach the scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labels(path: Column) -> Column:
    return F.split(path, "[.]")


def nlevel(path: Column) -> Column:
    return F.size(labels(path))


def subpath(path: Column, offset: int, length: int) -> Column:
    """``length`` labels from ``offset`` (0-based); shorter where the path ends."""
    return F.array_join(F.slice(labels(path), offset + 1, length), ".")


def under(path: Column, root: str) -> Column:
    """The root itself and all below it; ``I.q10`` is not under ``I.q1``."""
    return (path == root) | path.startswith(root + ".")


def under_range(path: Column, root: str) -> Column:
    """The same as a range, for labels of letters, digits and underscores: ``/`` follows ``.``, so row groups can be skipped."""
    return (path == root) | ((path > root + ".") & (path < root + "/"))


def article_filter(path: Column, root: str) -> Column:
    """From depth three on the whole subtree, above it the same depth only."""
    depth = root.count(".") + 1
    return under(path, root) if depth >= 3 else under(path, root) & (nlevel(path) == depth)


def group_prefix(path: Column, depth: int = 3) -> Column:
    return F.when(nlevel(path) >= depth, subpath(path, 0, depth)).otherwise(path)


def tail_number(path: Column) -> Column:
    """Number at the end of a path; null where there is none."""
    return F.regexp_extract(path, r"(\d+)$", 1).try_cast("int")


def label_number(path: Column, at: int) -> Column:
    return F.regexp_extract(F.get(labels(path), F.lit(at)), r"(\d+)$", 1).try_cast("int")


def child(path: Column, label: str) -> Column:
    return F.concat(path, F.lit("." + label))


def clean_label(label: Column) -> Column:
    """Hyphens are no label characters."""
    return F.replace(label, F.lit("-"), F.lit("_"))


def to_locator(path: Column) -> Column:
    """``I.q3.a1`` as the upper-case locator of a link, ``~ST.I.Q3.A1``."""
    return F.concat(F.lit("~ST."), F.upper(F.replace(path, F.lit("_"), F.lit("-"))))


def from_locator(locator: Column) -> Column:
    """Back to a path: the first label keeps its case, the others are lower-case."""
    parts = labels(clean_label(F.regexp_replace(locator, r"^~?ST\.", "")))
    return F.array_join(F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.lower)), ".")


def parent(path: Column) -> Column:
    return F.when(nlevel(path) > 1, F.array_join(F.slice(labels(path), F.lit(1), nlevel(path) - 1), "."))


def with_path_columns(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds what subtree work groups and sorts by."""
    p = F.col(path)
    return df.withColumns(
        {"nlevel": nlevel(p), "pars": subpath(p, 0, 1), "question_path": subpath(p, 0, 2), "article_path": subpath(p, 0, 3), "q_num": label_number(p, 1), "a_num": label_number(p, 2), "tail_num": tail_number(p)}
    )
