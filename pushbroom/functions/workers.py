"""Lets Python workers import this package where it is not installed, as when a driver runs from a checkout."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    env, home = spark.sparkContext.environment, str(Path(__file__).parents[2])
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), home)))
