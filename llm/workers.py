"""Makes this repository importable in Spark's Python workers."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> None:
    """Name the repository in the workers' search path, wherever the driver was started.

    This serves clusters where the repository is at the same path on all machines; elsewhere ship it (--py-files).
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
