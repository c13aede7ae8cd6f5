import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from letbook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def apply(spark):
    """Values of a column expression over single-column rows."""

    def run(values, expression, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        out = rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
        return [row.r for row in out]

    return run
