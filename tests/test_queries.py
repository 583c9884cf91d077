"""Every registered query against its SQL, and the entry point."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from docloom.plans.oracle import SQL
from docloom.plans.queries import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(names, values):
    order = sorted(names)
    at = [list(names).index(n) for n in order]
    return order, sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in at) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SF)
    found = con.execute(SQL[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in found.description], found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
