"""Session defaults used by the bench, the tests and the examples."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once for each application, so that functions that
    run there can be imported wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="parcelwright-")
        name = shutil.make_archive(os.path.join(folder, "parcelwright"), "zip", os.path.dirname(here), os.path.basename(here))
        spark.sparkContext.addPyFile(name)
        _shipped.add(app)


def local_session(cores: str = "8", app: str = "parcelwright") -> SparkSession:
    """A session for one machine. On a cluster the submitter's own settings hold instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
