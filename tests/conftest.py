from __future__ import annotations

import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.checkpoint.dir", str(shared / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / f"t-{uuid.uuid4().hex[:8]}")


@pytest.fixture
def frame(spark):
    """Rows of literals without a Python worker."""
    from keytide.sources.local import local_rows
    from pyspark.sql import types as T

    def make(rows, ddl):
        schema = T.StructType.fromDDL(ddl)
        return local_rows(spark, [dict(zip(schema.fieldNames(), r)) for r in rows], schema)

    return make


@pytest.fixture
def rows():
    def make(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

    return make
