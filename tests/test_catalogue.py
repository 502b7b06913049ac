"""Every query with SQL gives DuckDB's rows on the same files."""

import math
from pathlib import Path

import duckdb
import pytest

from florilege.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.oracle_sql():
        assert got
        return
    found = duck.execute(registry.oracle_sql()[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def test_entry_works_without_llm(spark):
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
