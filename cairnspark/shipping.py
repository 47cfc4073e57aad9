"""The package's own code on the executors, however the session was started."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Give this package to the executors as a zip file; once per context."""
    context = spark.sparkContext
    if getattr(context, "_cairnspark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cairnspark-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/cairnspark.zip", "w") as z:
        for top, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(top, name)
                z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(f"{folder}/cairnspark.zip")
    context._cairnspark_shipped = True
