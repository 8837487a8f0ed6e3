"""The package on the Python workers of a cluster."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    The archive is made on the driver, handed to Spark, and removed when the driver ends.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.TemporaryDirectory(prefix="tidewright-code-")
    archive = shutil.make_archive(
        os.path.join(folder.name, "tidewright"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    context.addPyFile(archive)
    _KEPT.append(folder)
    _SHIPPED.add(context.applicationId)


# Spark serves the archive from this folder while the driver runs.
_KEPT: list[tempfile.TemporaryDirectory] = []
