"""Hand the package to Python workers that do not find it on their own path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import lru_cache

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application, once."""
    _add(spark.sparkContext.applicationId, spark.sparkContext)


@lru_cache
def _add(application: str, context) -> None:
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(top):
        return  # imported from an archive, which the workers have already
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "tagloom-sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
