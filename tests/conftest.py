import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("checkpoints").as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Values of a column function of x for some values of x."""

    def run(column, values, kind="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        rows = frame.select("i", (column(frame.x) if callable(column) else column).alias("y")).collect()
        return [r.y for r in sorted(rows, key=lambda r: r.i)]

    return run
