"""Heavy keys are split; the result is that of a plain join."""

import pytest
from pyspark.sql import functions as F

from stakescore.operators import labeling
from stakescore.operators.skew import attach_by_key, heavy_keys
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def hot(spark):
    """Key 0 holds a third of the rows, key 1 is heavy too, key 9 has no value."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 1 + (F.col("id") / 300).cast("int"))
        .otherwise(F.col("id")).cast("int").alias("k"),
        F.concat(F.lit("v"), F.col("id")).alias("v"),
    )


def values_of(df):
    return df.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("low")).filter("k <> 2")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("size", [1, 50, 5000])
def test_equals_plain_join(hot, how, size):
    values = values_of(hot)
    got = attach_by_key(hot, values, ["k"], "n", ["v"], how, rows_per_part=size)
    want = hot.join(values.drop("n"), "k", how)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("size", [1, 50, 900, 5000])
def test_all_heavy_keys_are_listed(hot, size):
    values = rows_of(values_of(hot), "k", "n")
    listed = rows_of(heavy_keys(values_of(hot), ["k"], "n", size), "k", "_parts")
    assert listed == sorted(((k, -(-n // size)) for k, n in values if n > size), key=repr)
    assert len(listed) <= sum(n for _, n in values) / size


def test_hot_key_runs_in_many_tasks(spark, hot):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach_by_key(hot, values_of(hot), ["k"], "n", ["v"], rows_per_part=50)
        tasks = joined.filter("k = 0").groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert max(r["count"] for r in tasks) < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_large_top_set_is_not_broadcast(spark, monkeypatch):
    df = spark.range(400).selectExpr(
        "concat('v', id % 7) AS operator_address", "cast(id AS int) AS block_height", "cast(id % 7 AS double) AS score"
    )
    small = labeling.validator_filter(df, 0, 399, 3)
    monkeypatch.setattr(labeling, "BROADCAST_TOP", 2)
    large = labeling.validator_filter(df, 0, 399, 3)
    assert rows_of(small) == rows_of(large)
    assert {r[0] for r in large.select("operator_address").distinct().collect()} == {"v4", "v5", "v6"}
