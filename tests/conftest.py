import sys
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from helpers import START  # noqa: E402
from tickflow.functions.records import TICK  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_ticks(spark):
    """Ticks from (seconds after START, price) or (seconds, price, symbol)."""

    def make(*rows):
        data = []
        for row in rows:
            seconds, price, symbol = (*row, "S")[:3]
            at = None if seconds is None else START + timedelta(seconds=seconds)
            data.append((symbol, price, at))
        return spark.createDataFrame(data, TICK)

    return make
