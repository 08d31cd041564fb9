"""Making the package importable in Python workers, wherever they run."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    tmp = tempfile.mkdtemp(prefix="clipfold-ship-")  # the driver serves the archive from here as long as it runs
    atexit.register(shutil.rmtree, tmp, ignore_errors=True)
    shutil.copytree(root, Path(tmp, "src", root.name), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(tmp, "clipfold_src"), "zip", os.path.join(tmp, "src")))
    _shipped.add(sc.applicationId)
