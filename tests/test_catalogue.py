from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from factloom import catalogue, catalogue_filed, oracles, oracles_filed

QUERIES, SQL = catalogue.QUERIES | catalogue_filed.QUERIES, oracles.ORACLE_SQL | oracles_filed.ORACLE_SQL

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def plain(value):
    return repr(value) if isinstance(value, float) and not math.isnan(value) else value


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert not set(catalogue.QUERIES) & set(catalogue_filed.QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    assert sorted(names) == columns
    rows = found.fetchall()
    assert got == sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in rows)
    for column, kind in df.dtypes:
        assert TYPES[kind] == kinds[column] or kinds[column] in ("STRING", '"NULL"')


def test_panel_reads_only_what_it_needs(spark, sf_dir):
    plan = catalogue.QUERIES["panel"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "p_name" not in plan and "Python" not in plan
