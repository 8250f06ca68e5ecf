"""Makes this package importable on the executors, wherever the session was started from."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Send the package to the executors through Spark, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='pricewright-')}/pricewright", "zip",
                                      package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
    return spark
