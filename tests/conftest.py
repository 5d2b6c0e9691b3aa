import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("marketspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_bars(spark):
    """Bars from closes per ticker; other prices and the volume follow from the close unless given."""

    def make(closes: dict, start=datetime(2024, 1, 1), **overrides):
        rows = []
        for ticker, series in closes.items():
            for place, close in enumerate(series):
                row = {
                    "ticker": ticker, "date": start + timedelta(days=place), "open": close,
                    "high": close * 1.01, "low": close * 0.99, "close": close, "volume": 100.0 + place,
                }
                for name, values in overrides.items():
                    row[name] = values[place]
                rows.append(tuple(row.values()))
        schema = "ticker string, date timestamp_ntz, open double, high double, low double, close double, volume double"
        return spark.createDataFrame(rows, schema)

    return make


def rows_of(df, *order):
    return [row.asDict() for row in (df.orderBy(*order) if order else df).collect()]
