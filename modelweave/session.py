"""A session for tests and the bench; on a cluster the session comes from outside."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", name: str = "modelweave", shared: str = "") -> SparkSession:
    """``shared`` is the folder of stored frames; without one the session gets a new one of its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="modelweave-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
