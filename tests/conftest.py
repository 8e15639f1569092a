from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
# Python workers take their path from the environment.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH")]))

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before: dict[str, str | None] = {}

    def set_(name: str, value: object) -> None:
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, str(value))

    yield set_
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def make_ratings(spark):
    """Ratings from tuples of item, user, rating and ISO date."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "MOVIE_ID int, CUST_ID int, RATING int, DATE string")
        return df.withColumn("DATE", F.to_date("DATE"))

    return make
