import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def sample_corpus(spark):
    return spark.createDataFrame(
        [
            (0, "Seven green boats drift past the quiet harbour wall"),
            (1, "Seven green lamps burn until dawn"),
            (2, "The quiet owl waits on a wall"),
        ],
        "doc_id long, text string",
    )
