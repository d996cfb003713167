"""Send the package to the Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's sources to the application once, so that workers on other machines can import them."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        top = Path(__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(prefix="voxstar-"), "voxstar.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(top.rglob("*.py")):
                out.write(path, str(path.relative_to(top.parent)))
        context.addPyFile(archive)
        _sent.add(context.applicationId)
    return spark
