"""Every registered query against its SQL counterpart on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from revlens.queries import QUERIES

FOLDERS = [f"/root/testdata/{sf}" for sf in os.environ.get("ORACLE_SF", "sf0.001,sf0.01").split(",")]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# The SQL type of each Spark type that queries return.
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.fixture(scope="module", params=FOLDERS)
def folder(request):
    if not os.path.isdir(request.param):
        pytest.skip("tables not present")
    return request.param


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def rows(names, tuples):
    """Rows with columns in name order, as sortable texts."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in tuples)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, folder, name):
    got = contract.queries()[name](spark, folder)
    expected = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    kinds = [str(column[1]) for column in expected.description]
    assert {c: KINDS[t] for c, t in got.dtypes} == dict(zip(names, kinds))
    got_rows = rows(got.columns, got.collect())
    assert got_rows
    assert got_rows == rows(names, expected.fetchall())


def test_entry(spark):
    connection = duckdb.connect()
    for name in ("lineitem", "orders", "part"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{contract.SMALL_TABLES}/{name}.parquet'")
    expected = connection.execute(contract.oracle_sql()["product_delta"]).fetchall()
    assert contract.entry(spark).count() == len(expected) > 0
