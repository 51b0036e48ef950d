"""Sends this package to the executors, for sessions that were not started with it on their path."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; Spark itself hands the archive on to every executor."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    _sent.add(context.applicationId)
    package = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as folder:
        clean = shutil.copytree(package, Path(folder, "tree", package.name), ignore=shutil.ignore_patterns("__pycache__"))
        place = tempfile.mkdtemp()
        atexit.register(shutil.rmtree, place, ignore_errors=True)  # Spark reads it as long as executors may come
        archive = shutil.make_archive(str(Path(place, package.name)), "zip", clean.parent, package.name)
    context.addPyFile(archive)
