"""Session with the settings the operators are tested under."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[1])


def ship(spark: SparkSession | None = None) -> None:
    """Let Python workers import this package from where the driver has it; on a cluster pass it with ``--py-files``."""
    env = (spark or SparkSession.getActiveSession()).sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])


def session(name: str = "fieldglass", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides anything."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    return builder.config(map=settings | conf).getOrCreate()
