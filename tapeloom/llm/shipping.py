"""This package sent to the executors, for sessions that were not started with it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import tapeloom

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let tasks import this package. Spark itself carries the archive to every executor."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(tapeloom.__file__).parent
    folder = tempfile.mkdtemp()  # of the driver, which serves the archive from here until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name))
    _SHIPPED.add(context.applicationId)
