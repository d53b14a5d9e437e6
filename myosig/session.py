"""Session helpers: a local session for tests/bench and the checkpoint folder rule.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a shared
file system).  Only when it is unset -- local tests -- do we pick a fresh folder.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "myosig") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MYOSIG_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not re.fullmatch(r"local(\[[^,]*(,[^,]*)?\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # Unset on a local master: tests.
    scratch = tempfile.mkdtemp(prefix="myosig-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a session whose workers do not have it installed
    (operators run functions of the package inside tasks)."""
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="myosig-pkg-")  # read by the driver only; Spark serves the file
    path = shutil.make_archive(os.path.join(folder, "myosig"), "zip", root_dir=os.path.dirname(root), base_dir=os.path.basename(root))
    spark.sparkContext.addPyFile(path)
