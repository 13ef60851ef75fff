"""Makes this package importable in the executors' Python."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once for each context: Spark's own file server hands the package to every executor."""
    sc = spark.sparkContext
    if getattr(sc, "_siftwright_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():
        target = Path(tempfile.mkdtemp()) / "siftwright_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(target))
    sc._siftwright_shipped = True
