"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_points
from asksift.registry.oracles import oracles
from asksift.registry.queries import registered

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(registered()) == set(oracles())
    assert set(registered()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert set(entry_points.entry(spark).columns) == {"lang", "Rules", "n_rows", "n_texts"}


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_sql(spark, duck, name):
    got = registered()[name](spark, SF)
    columns = sorted(got.columns)
    relation = duck.sql(oracles()[name])
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {picked} FROM relation").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert rows and sorted(map(repr, rows)) == sorted(map(repr, expected))
