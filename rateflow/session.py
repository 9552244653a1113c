"""Session helpers: a local session for tests and a shared scratch folder.

Library functions never build a session themselves; callers pass one in.
``shared_dir`` resolves scratch space from ``spark.checkpoint.dir`` so that
files written by one executor can be read by another on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rateflow") -> SparkSession:
    """Local session with the settings used by tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. A fresh local folder is made only if none is set and
    the master is local (tests); on a cluster an unset folder is an error."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rateflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder path below the shared checkpoint root (created by the writer)."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/rateflow/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark can reach; nothing if it is not there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(f.getPath().getName() for f in files.listStatus(at) if f.isDirectory())
