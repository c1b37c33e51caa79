"""Python workers need this package: executors get it from the driver."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once in each application. Call it before an operator that runs Python there."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(), "tickloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent).as_posix())
    spark.sparkContext.addPyFile(path)
    _sent.add(app)
