import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted list of plain tuples, for comparing frames regardless of order.

    Fractions are rounded: statistics depend on the order in which parts are merged.
    """

    def plain(row):
        return tuple(round(v, 9) if isinstance(v, float) else v for v in row)

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((plain(r) for r in chosen.collect()), key=repr)

    return collect
