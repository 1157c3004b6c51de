"""Sends this package to the Python workers, wherever the driver imported it from."""

from __future__ import annotations

import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession


@cache
def _archive() -> str:
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="tideglass-code-")) / "tideglass.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Once a context; executors fetch the archive from the driver."""
    sc = spark.sparkContext
    if not getattr(sc, "_tideglass_shipped", False):
        sc.addPyFile(_archive())
        sc._tideglass_shipped = True
