import json

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_kept():
    """Tables that a module keeps in memory do not reach the tests of the next one."""
    yield
    if session := SparkSession.getActiveSession():
        session.catalog.clearCache()


@pytest.fixture
def documents(spark):
    """Documents from Python dicts or JSON texts, numbered in the given order."""

    def build(items):
        rows = [(i, item if isinstance(item, str) else json.dumps(item)) for i, item in enumerate(items)]
        return spark.createDataFrame(rows, "pos long, text string").select("pos", F.try_parse_json("text").alias("doc"))

    return build
