import os
import tempfile

import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tierline-warehouse-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tierline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def place(tmp_path):
    """A fresh directory, as a function from a relative name to a full path."""

    def path(name: str) -> str:
        full = tmp_path / name
        os.makedirs(full.parent, exist_ok=True)
        return str(full)

    return path


@pytest.fixture()
def put(place):
    """Write a text file under the fresh directory and return its path."""

    def write(name: str, text: str, encoding: str = "utf-8") -> str:
        target = place(name)
        with open(target, "w", encoding=encoding, newline="") as handle:
            handle.write(text)
        return target

    return write


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
