import os

import pytest
from pyspark.sql import functions as F

from stakescore import schemas, staging
from stakescore.catalog.panels import weekly_panel
from stakescore.sources import files, jdbc


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_scan_is_pushed_to_parquet(spark, sf_dir, tmp_path):
    path = str(tmp_path / "panel")
    weekly_panel(spark, sf_dir).withColumn("commission_rate", F.col("commission_rate").cast("float")).write.parquet(path)
    panel = files.read_panel(spark, path)
    assert panel.schema.fieldNames() == schemas.PANEL_SCHEMA.fieldNames()
    ranged = files.range_scan(panel, 180, 300).select("tokens")
    assert ranged.count() == 991
    plan = plan_of(ranged)
    assert "GreaterThanOrEqual(block_height,180), LessThanOrEqual(block_height,300)" in plan
    assert "ReadSchema: struct<block_height:int,tokens:decimal(38,0)>" in plan


def test_heights_csv(spark, tmp_path):
    df = spark.createDataFrame([(3,), (3,), (9,)], "block_height int")
    path = str(tmp_path / "heights")
    files.write_heights(df, path)
    back = files.read_heights(spark, path)
    assert back.schema == files.HEIGHT_SCHEMA
    assert sorted(r[0] for r in back.collect()) == [3, 9]


def test_sink_projection_types(spark):
    source = spark.createDataFrame([(1, "a")], "block_height bigint, operator_address string")
    wide = source.selectExpr("*", *[
        f"cast(1.25 AS decimal(38,10)) AS {f.name}" for f in schemas.BLOCK_LABEL_SCHEMA
        if f.name not in ("block_height", "operator_address")
    ])
    projected = schemas.project(wide, schemas.BLOCK_LABEL_SCHEMA)
    assert [(f.name, f.dataType) for f in projected.schema] == [
        (f.name, f.dataType) for f in schemas.BLOCK_LABEL_SCHEMA
    ]


def test_parallel_scan_options():
    options = jdbc.scan_options(
        jdbc.postgres_url("db", 5432, "chain"), "validator_block", "u", "p", lower=10, upper=90, partitions=8,
        custom_schema=jdbc.AMOUNT_TYPES, fetchsize=5000,
    )
    assert options == {
        "url": "jdbc:postgresql://db:5432/chain", "dbtable": "validator_block", "driver": jdbc.POSTGRES_DRIVER,
        "user": "u", "password": "p", "customSchema": jdbc.AMOUNT_TYPES, "partitionColumn": "block_height",
        "lowerBound": "10", "upperBound": "90", "numPartitions": "8", "fetchsize": "5000",
    }
    with pytest.raises(ValueError):
        jdbc.scan_options("u", "t", lower=4)


def test_scans_are_parallel_and_keep_derived_types_by_default():
    options = jdbc.scan_options("u", "block_label", lower=1, upper=9)
    assert options["numPartitions"] == str(jdbc.PARTITIONS) and "customSchema" not in options


def test_range_scan_query_reads_a_declared_source(spark, sf_dir):
    from stakescore.catalog.queries import QUERIES

    rows = QUERIES["range_scan"](spark, sf_dir)
    plan = plan_of(rows)
    assert "GreaterThanOrEqual(block_height,180)" in plan and "LessThanOrEqual(block_height,300)" in plan
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.PANEL_SCHEMA]


def test_sink_options_have_a_batch_size():
    options = jdbc.sink_options("u", "t")
    assert options == {"url": "u", "dbtable": "t", "driver": jdbc.POSTGRES_DRIVER, "batchsize": "1000"}


def test_staging_uses_the_configured_folder(spark):
    root = staging.staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    table = staging.written(spark.range(5), "numbers")
    assert table.count() == 5
    assert all(root.removeprefix("file:") in name for name in table.inputFiles())


def test_staged_frames_can_be_dropped(spark):
    table = staging.written(spark.range(5), "numbers")
    path = table.inputFiles()[0].removeprefix("file://")
    staging.discard(table)
    assert not os.path.exists(path)


def test_only_staged_frames_can_be_dropped(spark, sf_dir):
    with pytest.raises(ValueError):
        staging.discard(spark.read.parquet(f"{sf_dir}/nation.parquet"))
