"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# the folder of each local application that has none set
_OWN: dict[str, str] = {}


def local_session(app: str = "hazardlens", cores: str = "*") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where driver and tasks share one disk, falls back to a
    folder of its own; on a cluster an unset folder is an error, because a
    machine-local path would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = _OWN.get(sc.applicationId)
    if not folder:
        folder = _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="hazardlens-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder
