"""Registered queries against their SQL."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 3)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, data, db, name):
    df = __spark_entry__.queries()[name](spark, data)
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = Counter(tuple(value(row[names.index(c)]) for c in sorted(names)) for row in result.fetchall())
    assert Counter(tuple(value(r[c]) for c in sorted(names)) for r in df.collect()) == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_the_rest_runs(spark, data):
    for name in ("agg_count_distinctish", "geo_hash"):
        assert __spark_entry__.queries()[name](spark, data).count() > 0
