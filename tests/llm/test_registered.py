"""The registered queries of the subpackage on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_points
from asksift.llm.oracles import SQL
from asksift.llm.queries import QUERIES
from asksift.llm.substrings import brute_force

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_all_are_registered():
    names = set(entry_points.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {picked} FROM relation").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert rows and sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_substrings_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op8_substrings"](spark, SF).collect()}
    assert got == brute_force(rows)


def test_quality_on_held_out_labels(spark):
    larger = SF.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_quality"](spark, larger).collect() if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.9 * len(rows)


def test_licence_lines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    marks = {"MIT License": "mit", "Apache License": "apache-2.0", "version 3": "gpl-3.0", "CC BY-NC": "cc-by-nc", "rights reserved": "proprietary"}
    expected = {
        (d.doc_id, n, family)
        for d in docs for n, line in enumerate(d.text.split("\n")) for mark, family in marks.items() if mark in line
    }
    found = QUERIES["op5_licences"](spark, SF).where("family <> 'unknown'").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in found} == expected


def test_pages_and_fingerprints_are_whole(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = QUERIES["op3_extraction"](spark, SF).collect()
    assert len(found) == pages.count() and all(r.n_chars == len(r.text) > 0 for r in found)
    assert not any("<" in r.text or "track(" in r.text or "©" in r.text for r in found)
    prints = QUERIES["op2_fingerprints"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(prints) == len(docs) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in prints)
    by_text = {}
    lengths = {d.doc_id: d.text for d in docs}
    for r in prints:
        assert by_text.setdefault(lengths[r.doc_id], r.fingerprint) == r.fingerprint
