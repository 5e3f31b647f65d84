"""The package, given to the executors' Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add this package's archive to the application, once; Spark then copies it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="courier-package-"), "courier")
    context.addPyFile(shutil.make_archive(archive, "zip", _ROOT, "courier"))
    _shipped.add(context.applicationId)
