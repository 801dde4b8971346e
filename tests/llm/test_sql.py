"""The text queries that SQL can express against it."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import differences  # noqa: E402
from tickflow.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name, size):
    connection = duckdb.connect()
    for table in Path(f"/root/testdata/{size}").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    actual = QUERIES[name](spark, f"/root/testdata/{size}").toPandas()
    assert differences(actual, connection.execute(ORACLES[name]).df()) == ""
