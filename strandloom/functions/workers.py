"""What Python workers need: the folder of this package on their path, wherever the session was started."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where the driver did, where that path exists for them."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
