import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tickframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of one column expression over literal rows, in the order of the rows."""

    def run(rows, schema, column):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
        return [row.v for row in frame.select("_i", column.alias("v")).orderBy("_i").select(F.col("v")).collect()]

    return run
