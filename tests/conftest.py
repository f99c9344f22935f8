from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

# Collected timestamps come back in the machine's zone: keep it the session's.
ZONE = "Europe/Amsterdam"
os.environ["TZ"] = ZONE
time.tzset()

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", ZONE)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test and put the old ones back."""
    before = {}

    def set_option(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "data")


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(row) for row in frame.collect()), key=repr)
