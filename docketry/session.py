"""Session construction shared by tests, the bench and command line use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "docketry", **conf: str) -> SparkSession:
    """A session with the settings that the library's results rely on.

    Only the time zone changes results; adaptive execution sizes shuffles from what was measured, so
    nothing here depends on the size of the data. Further settings are passed as keywords, dots as
    double underscores: ``spark__sql__shuffle__partitions="64"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Adds this package's folder to the Python path of workers started from now on.

    Workers import the package by name. Where it is installed, or shipped with ``--py-files``, this changes nothing; a session that was made from
    another folder, on one machine or with the folder mounted, needs it.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
