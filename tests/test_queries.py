"""Every registered query against its SQL on the smallest data set."""

from functools import cache

import duckdb
import pytest

from cardweave.plans import catalog
from cardweave.plans.catalog import QUERIES
from cardweave.plans.oracle_sql import ORACLES

TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def one_flow(spark, folder):
    """The queries over the flow share its stored results."""
    run = catalog._flow
    by_time = cache(lambda own: run(spark, folder, catalog.F.col("transaction_date_time") if own else None))
    catalog._flow = lambda s, f, processed_at=None: by_time(processed_at is not None)
    yield
    catalog._flow = run


def ordered(rows, columns):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in places) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    frame = QUERIES[name](spark, folder)
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    rows = ordered(frame.collect(), frame.columns)
    assert rows and rows == ordered(result.fetchall(), columns)
