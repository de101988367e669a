"""Sends this package to the executors, whose Python workers need not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application; Spark's own file server carries the archive."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="rosterlake-")) / "rosterlake_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
