"""Make the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import stockflow

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package's source to the executors, once per application.

    The archive is made on the driver and sent by Spark; nothing reads the driver's
    folder. An installed copy on the executors does no harm.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(stockflow.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="stockflow-code-"), "stockflow_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("stockflow", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
