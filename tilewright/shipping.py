"""Sending the package to the executors, so that they need no copy of their own."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's modules to the application's Python files, once."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="tilewright-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "tilewright.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, str(Path(package.name) / file.relative_to(package)))
    spark.sparkContext.addPyFile(archive)
    _sent.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package sent to the executors before it."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
