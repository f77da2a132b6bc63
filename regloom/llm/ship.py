"""Makes this package importable in Python workers that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import regloom


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the executors, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_regloom_sent", False):
        return
    root = os.path.dirname(os.path.abspath(regloom.__file__))
    archive = os.path.join(tempfile.mkdtemp(), "regloom_source.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._regloom_sent = True
