"""Every registered query against DuckDB on the same tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Beyond SQL, or too slow in it on whole tables: tests/llm holds these against plain versions.
WITHOUT_SQL = {
    "op2_line_dedup",
    "op3_secret_scan",
    "op6_quality_rules",
    "op7_packing",
    "op9_html_extraction",
    "op10_token_counts",
    "op12_periodic_runs",
    "op13_toxicity",
    "pipeline",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    queries = set(contract.queries())
    assert queries - set(contract.oracle_sql()) == WITHOUT_SQL & queries
    assert set(contract.oracle_sql()) <= queries


@pytest.mark.parametrize("query", sorted(contract.oracle_sql()))
def test_same_as_duckdb(spark, duck, query):
    df = contract.queries()[query](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[query])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted_rows(columns, result.fetchall())
    actual = sorted_rows(df.columns, df.collect())
    assert expected
    assert len(actual) == len(expected)
    assert actual == expected


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
