"""Session settings the package relies on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# AQE sizes and splits shuffle partitions at run time; the skew settings let it
# break up a partition that one key fills.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a task that writes to few folders keeps a file open for each, instead of sorting its rows by folder
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: tasks that run Python import it."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='rankloom-')}/rankloom", "zip", root_dir=root.parent, base_dir=root.name
        )
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(application)


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL settings on a session somebody else created, and ship the package."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    ship_package(spark)
    return spark


def local_session(cores: str = "8", app: str = "rankloom", memory: str = "12g") -> SparkSession:
    """Session for tests and local benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)
