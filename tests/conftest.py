import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def local_dir(tmp_path_factory):
    """Folder of the executor's own files, such as shuffle files."""
    return tmp_path_factory.mktemp("local")


@pytest.fixture(scope="session")
def spark(tmp_path_factory, local_dir):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", str(local_dir))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """DataFrame of the given texts, one per row."""

    def make(*rows):
        return spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "doc_id BIGINT, text STRING")

    return make
