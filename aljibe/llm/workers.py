"""Python workers find the package where the driver found it."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Add the folder of the package to the workers' path. Where the package is installed on the cluster this changes nothing."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def with_package(query: Callable) -> Callable:
    """``query``, whose first argument is the session, after ``find_package``."""
    @wraps(query)
    def run(spark: SparkSession, *rest):
        find_package(spark)
        return query(spark, *rest)

    return run
