"""Sends the package to the workers, so that functions run there need no installed copy."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Add the zipped package to the session's Python files, once per Spark application.

    Python workers of a ``local[n]`` session start with the driver's search path but not with
    changes made to it later, so they get the package too."""
    context = spark.sparkContext
    if getattr(context, "_tagwright_shipped", None) == context.applicationId:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tagwright-"), "tagwright.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(PACKAGE)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    context.addPyFile(path)
    context._tagwright_shipped = context.applicationId
