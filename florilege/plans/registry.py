"""All queries of the library, with the SQL that gives the same rows."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import florilege.plans.catalogue as catalogue


def _modules():
    return [importlib.import_module(f"{catalogue.__name__}.{m.name}") for m in pkgutil.iter_modules(catalogue.__path__)]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _modules() for k, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for m in _modules() for k, (_, sql) in m.QUERIES.items() if sql}
