from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "3g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


def compare(got, want) -> None:
    """Same columns, same rows in any order."""
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = lambda frame: sorted(map(repr, frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()))
    assert rows(got) == rows(want)


def duck(folder: str):
    import duckdb

    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for name in os.listdir(folder):
        db.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return db
