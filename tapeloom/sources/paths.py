"""Listing and removing directories on whatever file system a path names."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def is_file(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return bool(found) and len(found) == 1 and found[0].isFile()


def make_dir(spark: SparkSession, directory: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def remove(spark: SparkSession, directory: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in `spark.checkpoint.dir`.

    Only a session in one process, `local` or `local[n]`, may do without that setting; its
    folder is removed when the process ends. What is written to a named folder stays there
    for whoever named it to remove, as results may still be read from it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_dir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _own_dir() -> str:
    folder = tempfile.mkdtemp(prefix="tapeloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
