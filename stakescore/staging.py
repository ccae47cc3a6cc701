"""Writing an intermediate frame once instead of computing it for each of its uses.

The files are in the shared folder named by ``spark.checkpoint.dir``, so they outlive lost executors.
All files of an application are below one folder with its id, to be cleared when it has ended.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame, str], DataFrame]


def staging_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or that of the context; without either an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A path not used before."""
    return f"{staging_root(spark)}/stakescore-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet and read it back, so that later uses prune columns and push filters."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lazy(df: DataFrame, name: str) -> DataFrame:
    """Stage nothing: every use computes the frame again."""
    return df


def discard(df: DataFrame) -> None:
    """Delete the files of a frame made by :func:`written`, once nothing reads it any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if f"/stakescore-{spark.sparkContext.applicationId}/" not in folder:
            raise ValueError(f"not a staged frame: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
