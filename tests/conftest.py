import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("corpusflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not Path(path).is_dir():
        pytest.skip(f"no test tables at {path}")
    return path


@pytest.fixture(scope="session")
def golden():
    """Folder of published inputs and results; see README, "Golden results"."""
    path = os.environ.get("GOLDEN_DIR", "")
    if not path or not Path(path).is_dir():
        pytest.skip("GOLDEN_DIR is not set")
    return path


@pytest.fixture
def settings(spark):
    """Set ``spark.corpusflow.*`` limits for one test."""
    changed = set()

    def change(**limits):
        for name, value in limits.items():
            spark.conf.set(f"spark.corpusflow.{name}", str(value))
            changed.add(name)

    yield change
    for name in changed:
        spark.conf.unset(f"spark.corpusflow.{name}")


def rows(df, *columns):
    """The rows of a small result as a sorted list of tuples."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
