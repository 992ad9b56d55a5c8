import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from turnloom.catalog import QUERIES
from turnloom.oracles import ORACLES


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_duckdb(spark, sf_dir, database, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    cursor = database.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    picked = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in picked) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    assert got == expected
    assert got


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["conv_id", "n_messages", "text"]
    assert frame.count() > 0
