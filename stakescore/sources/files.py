"""Parquet and CSV sources and sinks with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from stakescore.schemas import HEIGHT, PANEL_SCHEMA

HEIGHT_SCHEMA = StructType([StructField(HEIGHT, IntegerType())])


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet panel under the declared schema."""
    return spark.read.schema(PANEL_SCHEMA).parquet(path)


def range_scan(df: DataFrame, from_block: int, to_block: int) -> DataFrame:
    """The rows of an inclusive height range; the predicate reaches Parquet and JDBC scans."""
    return df.filter(F.col(HEIGHT).between(from_block, to_block))


def write_heights(df: DataFrame, path: str) -> None:
    """The distinct heights as CSV with a header."""
    df.select(HEIGHT).distinct().write.option("header", True).csv(path)


def read_heights(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEIGHT_SCHEMA).csv(path, header=True)
