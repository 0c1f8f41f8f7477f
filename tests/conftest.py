import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


def _session(**extra):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = _session(**{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    if not session.conf.get("spark.checkpoint.dir", None):
        session.stop()
        session = _session(**{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def rows():
    """Collect as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
