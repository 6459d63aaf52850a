"""Sending this library to the executors, whose Python workers need not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the library to the session's Python files, once per application. Spark serves it to every executor, also
    to those that join later. Worker processes keep what they import, and with it the caches of the operators."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="viaduct-")) / "viaduct_library.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _sent.add(context.applicationId)
