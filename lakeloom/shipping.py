"""Makes this package importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once, unless PYTHONPATH already has it.

    A cluster that installs the package, or names it in ``PYTHONPATH`` or ``--py-files``, needs
    nothing else.
    """
    package = Path(__file__).resolve().parent
    context = spark.sparkContext
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_lakeloom_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="lakeloom-py-"), "lakeloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    context._lakeloom_shipped = True
