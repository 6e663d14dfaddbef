"""Session defaults. On a cluster the settings of the session that is handed in stay as they are."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for one machine: tests and the benchmark."""
    parallel = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sleevework")
        .config("spark.sql.shuffle.partitions", parallel)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.minPartitionNum", parallel)
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no stack walk per column call
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, named by ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not folder and master.startswith("local") and not master.startswith("local-cluster"):
        folder = tempfile.mkdtemp(prefix="sleevework-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder
