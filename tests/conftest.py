import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


def pytest_configure(config):
    """One session for all tests, there before test modules make columns."""
    from pyspark.sql import SparkSession

    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    config.spark = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.local.dir", work).config("spark.sql.warehouse.dir", f"{work}/warehouse").config("spark.checkpoint.dir", f"{work}/shared").getOrCreate()
    )
    config.spark.sparkContext.setLogLevel("OFF")


@pytest.fixture(scope="session")
def spark(pytestconfig):
    return pytestconfig.spark


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column expression over one row of named texts."""

    def run(column, **values):
        row = spark.range(1)
        from pyspark.sql import functions as F

        row = row.select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else row
        out = row.select(column.alias("x")).first()["x"]
        return out.asDict(recursive=True) if hasattr(out, "asDict") else out

    return run
