"""Every query with an oracle gives the same rows in Spark and in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__
from telemark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, duck, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    result = duck.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    ours = sorted([plain(r[c]) for c in order] for r in df.collect())
    theirs = sorted([plain(r[columns.index(c)]) for c in order] for r in result.fetchall())
    assert ours == theirs


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["date", "drives", "failures"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
