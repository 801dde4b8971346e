"""Every query on ticks against its SQL counterpart on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import differences  # noqa: E402
from tickflow.plans.catalog import QUERIES  # noqa: E402
from tickflow.plans.oracles import ORACLES  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    actual = QUERIES[name](spark, TABLES).toPandas()
    assert differences(actual, database.execute(ORACLES[name]).df()) == ""
