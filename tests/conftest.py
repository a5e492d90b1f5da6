from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("leaseload-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def export(spark):
    """Rows of text cells as an export frame with its row order."""

    def make(columns: list[str], rows: list[tuple], partitions: int | None = None):
        schema = ", ".join(f"`{c}` string" for c in columns) + ", _row_ord bigint"
        frame = spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], schema)
        return frame.repartition(partitions) if partitions else frame

    return make


@pytest.fixture
def values(spark):
    """Results of column expressions over single cells."""

    def evaluate(expression, *cells):
        rows = [(n, c) for n, c in enumerate(cells)]
        frame = spark.createDataFrame(rows, "n int, x string").select("n", expression.alias("y"))
        return [r.y for r in sorted(frame.collect(), key=lambda r: r.n)]

    return evaluate
