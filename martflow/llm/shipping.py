"""Make this package importable for the Python workers of a local session."""

from __future__ import annotations

import os
import shutil
from pathlib import Path

from pyspark.sql import SparkSession

from martflow.sources.tables import new_folder

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package to local workers, whose path may lack its folder.

    On a cluster, give it to ``spark-submit --py-files`` or install it there.
    """
    root = Path(__file__).resolve().parents[2]
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    context = spark.sparkContext
    local = context.master.startswith("local") and "cluster" not in context.master
    if not local or str(root) in known or context.applicationId in _shipped:
        return
    folder = Path(new_folder(spark, "package").removeprefix("file:"))
    folder.mkdir(parents=True)
    archive = shutil.make_archive(str(folder / "martflow"), "zip", root, "martflow")
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
