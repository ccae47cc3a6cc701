from __future__ import annotations

import glob
import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import SparkSession

from stakescore.schemas import PANEL_SCHEMA

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def duck_at():
    """A DuckDB connection with the tables of a scale as views."""
    known = {}

    def connect(sf):
        if sf not in known:
            known[sf] = duckdb.connect()
            for path in glob.glob(f"{TESTDATA}/{sf}/*.parquet"):
                known[sf].sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
        return known[sf]

    return connect


@pytest.fixture(scope="session")
def duck(duck_at):
    return duck_at("sf0.001")


@pytest.fixture(scope="session")
def panel_of(spark):
    """Panel from dicts; unnamed columns take plain values."""
    defaults = {
        "tokens": 100, "delegator_shares": 100, "self_bonded": 10, "commission_rate": 5e16,
        "jailed": False, "vote": True, "propose": False, "status": "BOND_STATUS_BONDED",
    }

    def build(rows):
        filled = []
        for row in rows:
            row = defaults | row
            for name in ("tokens", "delegator_shares", "self_bonded"):
                row[name] = None if row[name] is None else Decimal(row[name])
            filled.append(tuple(row[f.name] for f in PANEL_SCHEMA))
        return spark.createDataFrame(filled, PANEL_SCHEMA)

    return build


def rows_of(df, *columns):
    """Sorted tuples, for order-free comparison."""
    columns = columns or tuple(sorted(df.columns))
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
