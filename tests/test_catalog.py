"""Each query with SQL gives the rows that DuckDB gives."""

import math
import os

import duckdb
import pytest

from tallyframe.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if v is None or isinstance(v, (int, bool, str)) else str(v)


def same_rows(spark, query, sql, data_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data_dir}/{t}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    df = query(spark, data_dir)
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    theirs = sorted(repr([plain(r[names.index(n)]) for n in order]) for r in found.fetchall())
    assert sorted(repr([plain(r[n]) for n in order]) for r in df.collect()) == theirs


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, data_dir, name):
    if not os.path.isdir(data_dir):
        pytest.skip("no tables")
    same_rows(spark, catalog.QUERIES[name], catalog.ORACLES[name], data_dir)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
