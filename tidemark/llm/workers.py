"""Lets Python workers import the package from a checkout that is not installed."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> SparkSession:
    """Add the checkout's folder to the module path of workers that start from now on.

    Where the package is installed, or the folder is not there, this changes nothing.
    """
    environment = spark.sparkContext.environment
    have = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in have:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *have])
    return spark


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
