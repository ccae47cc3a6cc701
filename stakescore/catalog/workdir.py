"""The shared folder of registered queries."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def give_folder(spark: SparkSession) -> None:
    """Give a session on one machine a checkpoint folder if it has none; a cluster must name its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stakescore-"))
