"""What a session needs for these operators: a shared folder, and this package on its Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import stakescore
from stakescore.catalog.workdir import give_folder

_ready: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Once a session on one machine: put the package's source on the path of the Python workers.

    On a cluster the package is installed on the workers, or sent with ``--py-files``.
    """
    give_folder(spark)
    context = spark.sparkContext
    if context.applicationId in _ready or not context.master.startswith("local["):
        return
    root = Path(stakescore.__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="stakescore-"), "stakescore.zip")
    with zipfile.ZipFile(archive, "w") as package:
        for source in sorted(root.rglob("*.py")):
            package.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    _ready.add(context.applicationId)
