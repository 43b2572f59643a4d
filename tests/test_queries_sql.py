"""Every registered query against its SQL in another engine."""

import math

import duckdb
import pytest

from tempograin import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    if hasattr(v, "as_tuple"):
        return float(v)
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, sf_dir, sql, name):
    df = registry.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    result = sql.execute(registry.oracle_sql()[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == names
    want = sorted(([plain(r[order.index(c)]) for c in names] for r in result.fetchall()), key=repr)
    assert sorted(([plain(r[c]) for c in names] for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf_dir, name):
    rows = registry.queries()[name](spark, sf_dir)
    assert rows.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
